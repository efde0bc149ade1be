from datetime import datetime, timedelta

from pyspark.sql import functions as F

from folioforge.streaming import ingest

SCHEMA = "url string, ts timestamp, kind string"
T0 = datetime(2024, 1, 1)


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_ingest_equals_batch(spark, tmp_path):
    folder, at = f"{tmp_path}/in", f"{tmp_path}/cp"
    rows = [(f"u{n % 7}", T0 + timedelta(minutes=n), "a" if n % 2 else "b") for n in range(20)]
    arrive(spark, folder, rows[:12])
    got: list = []
    keep = lambda df, _: got.extend(r.url for r in df.collect())
    stream = lambda: ingest.first_by_key(ingest.new_files(spark, folder, SCHEMA), F.col("url"), "ts", "1 day")
    ingest.run_once(stream(), at, keep)
    arrive(spark, folder, rows[12:])
    ingest.run_once(stream(), at, keep)
    assert sorted(got) == sorted({r[0] for r in rows})


def test_windows_and_late_rows(spark, tmp_path):
    folder = f"{tmp_path}/in"
    arrive(spark, folder, [("a", T0 + timedelta(minutes=m), "k") for m in (0, 3, 12, 50)])
    q = ingest.window_counts(ingest.new_files(spark, folder, SCHEMA), "ts", "10 minutes", "5 minutes", ["kind"])
    ingest.run_once(q, f"{tmp_path}/cp", table="w_counts")
    assert {r.window_start: r.n for r in spark.table("w_counts").collect()} == {T0: 2, T0 + timedelta(minutes=10): 1}
    arrive(spark, folder, [("late", T0 + timedelta(minutes=1), "k"), ("b", T0 + timedelta(minutes=90), "k")])
    q = ingest.session_counts(ingest.new_files(spark, folder, SCHEMA), "ts", "10 minutes", "5 minutes", ["kind"])
    ingest.run_once(q, f"{tmp_path}/cp2", table="s_counts")
    assert spark.table("s_counts").agg(F.sum("n")).first()[0] >= 4


def test_refresh(spark):
    stale = spark.createDataFrame([("p", ["a", "b"]), ("q", ["c"])], "post string, unmapped array<string>")
    batch = spark.createDataFrame([("b",), ("b",)], "url string")
    assert [r.post for r in ingest.refresh(batch, stale, "post", "unmapped", "url").collect()] == ["p"]


def test_written_tables_are_removed_on_request(spark):
    from folioforge.session import clean_stored, stored

    clean_stored(spark)
    df = stored(spark.range(5))
    assert df.count() == 5 and clean_stored(spark) == 1 and clean_stored(spark) == 0
