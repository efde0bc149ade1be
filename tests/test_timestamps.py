from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.operators.timestamps import with_instant


def ms(text: str) -> int:
    d = datetime.fromisoformat(text)
    return int(d.timestamp()) * 1000 + d.microsecond // 1000


SEOUL, LA, BERLIN = "Asia/Seoul", "America/Los_Angeles", "Europe/Berlin"
CASES = [
    ("2024-02-28T24:00:00Z", SEOUL, "ymd", ms("2024-02-29T00:00:00+00:00")),
    ("2024-12-31 24:00", SEOUL, "ymd", ms("2025-01-01T00:00:00+09:00")),
    ("2016-12-31T23:59:60Z", SEOUL, "ymd", ms("2017-01-01T00:00:00+00:00")),
    ("2024-02-28T24:00:01Z", SEOUL, "ymd", None),
    ("2024-02-28T25:00:00Z", SEOUL, "ymd", None),
    ("2024-02-28T10:30:60Z", SEOUL, "ymd", None),
    ("2024-10-31T03:57:39+05:45", SEOUL, "ymd", ms("2024-10-31T03:57:39+05:45")),
    ("2020-01-19T21:18:00Z", BERLIN, "dmy", ms("2020-01-19T21:18:00+00:00")),
    ("27 Oct 2020", LA, "mdy", ms("2020-10-27T00:00:00-07:00")),
    ("1633786059000", SEOUL, "ymd", 1633786059000),
    ("1726533805", SEOUL, "ymd", 1726533805000),
    ("1617791216000999", SEOUL, "ymd", 1617791216000),
    ("1674710690452468216", SEOUL, "ymd", 1674710690452),
    ("12/02/2020", LA, "mdy", ms("2020-12-02T00:00:00-08:00")),
    ("12/02/2020", BERLIN, "dmy", ms("2020-02-12T00:00:00+01:00")),
    ("25/03/2020 10h53", "Europe/Paris", "dmy", ms("2020-03-25T10:53:00+01:00")),
    ("2022/1/19", SEOUL, "ymd", ms("2022-01-19T00:00:00+09:00")),
    ("20200516T190600Z", SEOUL, "ymd", ms("2020-05-16T19:06:00+00:00")),
    ("20201226T134118.123+0900", BERLIN, "dmy", ms("2020-12-26T13:41:18.123+09:00")),
    ("Sun, 23 Jan 2022 01:22:54 GMT", LA, "mdy", ms("2022-01-23T01:22:54+00:00")),
    ("２０２３/０５/２３ １８:２７:００", "Asia/Tokyo", "ymd", ms("2023-05-23T18:27:00+09:00")),
    ("2024. 7. 9. 오후 12:05", SEOUL, "ymd", ms("2024-07-09T12:05:00+09:00")),
    ("2024년 7월 9일 오전 12시 5분", SEOUL, "ymd", ms("2024-07-09T00:05:00+09:00")),
    ("2024年7月9日午後1時05分", "Asia/Tokyo", "ymd", ms("2024-07-09T13:05:00+09:00")),
    ("19. Oktober 2020", BERLIN, "dmy", ms("2020-10-19T00:00:00+02:00")),
    ("29 décembre 2021 à 20:15", "Europe/Paris", "dmy", ms("2021-12-29T20:15:00+01:00")),
    ("Aug 11, 2021 at 3:26 AM PDT", LA, "mdy", ms("2021-08-11T03:26:00-07:00")),
    ("2021-07-24T05:16:14+09:00[Asia/Tokyo]", LA, "mdy", ms("2021-07-24T05:16:14+09:00")),
    ("20230801183733", LA, "mdy", ms("2023-08-01T18:37:33-07:00")),
    ("202204011546", SEOUL, "ymd", ms("2022-04-01T15:46:00+09:00")),
    ("25.10.2020 02:30", BERLIN, "dmy", ms("2020-10-25T02:30:00+02:00")),  # twice: the first
    ("2020-03-29 02:30", BERLIN, "dmy", None),  # never
    ("2024-02-29", SEOUL, "ymd", ms("2024-02-29T00:00:00+09:00")),
    ("2023-02-29", SEOUL, "ymd", None),
    ("2023-13-05T10:00:00Z", SEOUL, "ymd", None),
    ("2022-06-31 25:10", SEOUL, "ymd", None),
    ("0000-00-00", SEOUL, "ymd", None),
    ("n/a", SEOUL, "ymd", None),
    ("", SEOUL, "ymd", None),
    (None, SEOUL, "ymd", None),
    ("2024-01-01 10:00", None, None, None),  # wall clock without zone
    ("2024-01-01 10:00Z", None, None, ms("2024-01-01T10:00:00+00:00")),
    ("13/02/2020", SEOUL, "ymd", ms("2020-02-13T00:00:00+09:00")),  # only one reading
    ("x" * 100_000, SEOUL, "ymd", None),
]


def test_formats_zones_and_clock_changes(spark):
    rows = [(n, v, tz, order) for n, (v, tz, order, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "n int, v string, tz string, o string")
    got = {r.n: r.utc for r in with_instant(df, F.col("v"), F.col("tz"), F.col("o"), "utc").collect()}
    assert {n: c[3] for n, c in enumerate(CASES)} == got


def test_columns_stay_whatever_their_names(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", 1, "a b")], "utc string, `__ts_x` int, `a.b` string")
    out = with_instant(df, F.col("utc"), F.lit("UTC"), F.lit("ymd"), "utc")
    assert out.columns == ["__ts_x", "a.b", "utc"] and out.first().utc == 1704067200000


def test_empty_table(spark):
    assert with_instant(spark.createDataFrame([], "v string"), F.col("v"), F.lit("UTC"), F.lit("ymd"), "u").count() == 0


def test_filter_on_result_does_not_repeat_the_calculation(spark):
    df = spark.createDataFrame([("2024-01-01",)], "v string")
    plan = with_instant(df, F.col("v"), F.lit("UTC"), F.lit("ymd"), "u").filter("u is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(trim") == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.datetimes(datetime(1905, 1, 1), datetime(2099, 12, 31)), min_size=1, max_size=40), st.sampled_from([SEOUL, LA, BERLIN, "UTC"]))
def test_wall_clock_as_the_standard_library_reads_it(spark, times, tz):
    from zoneinfo import ZoneInfo

    rows = [(n, t.strftime("%Y-%m-%d %H:%M:%S").zfill(19)) for n, t in enumerate(times)]
    got = {r.n: r.u for r in with_instant(spark.createDataFrame(rows, "n int, v string"), F.col("v"), F.lit(tz), F.lit("ymd"), "u").collect()}
    for n, t in enumerate(times):
        t = t.replace(microsecond=0, tzinfo=ZoneInfo(tz))
        utc = t.astimezone(timezone.utc)
        there = utc.astimezone(ZoneInfo(tz)).replace(tzinfo=None) == t.replace(tzinfo=None)
        assert got[n] == (int(utc.timestamp()) * 1000 if there else None), (t, tz)


@pytest.mark.parametrize("kind,value,want", [("bigint", 1602000000123, 1602000000123), ("bigint", 0, None), ("bigint", 20210808211900, ms("2021-08-08T21:19:00+09:00"))])
def test_numbers(spark, kind, value, want):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert with_instant(df, F.col("v"), F.lit(SEOUL), F.lit("ymd"), "u").first().u == want
