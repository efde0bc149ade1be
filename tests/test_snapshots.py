import random

from pyspark.sql import functions as F

from folioforge.operators.snapshots import snapshot_changes

SCHEMA = "s int, k string, loaded int, v bigint, change string"


def changes(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in snapshot_changes(df, "s", ["k"], ["loaded"], [F.col("v")]).collect())


def brute(rows):
    latest = {}
    for s, k, loaded, v, _ in rows:
        if s is None or k is None:
            continue
        rank = (loaded is not None, loaded or 0, v is not None, v or 0)
        if (s, k) not in latest or rank > latest[s, k][0]:
            latest[s, k] = (rank, v)
    snaps = sorted({r[0] for r in rows if r[0] is not None})
    out = []
    for a, b in zip(snaps, snaps[1:]):
        old, new = ({k: v for (s, k), (_, v) in latest.items() if s == x} for x in (a, b))
        out += [(b, k, "added") for k in new.keys() - old.keys()] + [(b, k, "removed") for k in old.keys() - new.keys()]
        out += [(b, k, "changed") for k in old.keys() & new.keys() if None not in (old[k], new[k]) and old[k] != new[k]]
    return sorted(out)


def test_added_removed_changed_and_skipped_numbers(spark):
    rows = [(1, "a", 1, 1, ""), (1, "b", 1, 1, ""), (1, "c", 1, None, ""), (3, "a", 1, 2, ""), (3, "c", 1, 5, ""), (3, "d", 1, 1, ""), (3, "a", 0, 1, "")]
    assert changes(spark, rows) == brute(rows) == [(3, "a", "changed"), (3, "b", "removed"), (3, "d", "added")]


def test_against_brute_force(spark):
    rng = random.Random(4)
    for _ in range(4):
        rows = []
        for s in (1, 2, 5):
            for k in "abcdefgh":
                seen = set()
                for _ in range(rng.choice([0, 1, 1, 2])):
                    loaded = rng.choice([None, 1, 2, 3])
                    if loaded not in seen:
                        seen.add(loaded)
                        rows.append((s, k, loaded, rng.choice([None, 1, 2]), ""))
        rows += rows[:3] + [(None, "a", 1, 1, ""), (1, None, 1, 1, "")]
        assert changes(spark, rows) == brute(rows)


def test_one_snapshot_and_none(spark):
    assert changes(spark, [(1, "a", 1, 1, "")]) == [] and changes(spark, []) == []


def test_no_step_sorts_all_rows(spark):
    df = spark.createDataFrame([(1, "a", 1, 1, "")], SCHEMA)
    plan = snapshot_changes(df, "s", ["k"], ["loaded"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_other_orders_are_compared_as_a_structure(spark):
    df = spark.createDataFrame([(1, "a", 1, 1, "x"), (2, "a", 1, 1, "x"), (2, "a", 1, 2, "y")], "s int, k string, loaded int, v bigint, by string")
    assert [r.change for r in snapshot_changes(df, "s", ["k"], ["loaded", "by"], [F.col("v")]).collect()] == ["changed"]
