import random
from datetime import datetime, timedelta

from folioforge.operators.orphans import orphan_keys, orphans_of_intervals, orphans_of_snapshots

T0 = datetime(2024, 1, 1, 12)


def intervals(spark, refs, kept, hot=20_000):
    r = spark.createDataFrame(refs, "id bigint, k string, t timestamp_ntz, reason string")
    d = spark.createDataFrame(kept, "k string, s timestamp_ntz, e timestamp_ntz, t int")
    return sorted((x.id, x.reason) for x in orphans_of_intervals(r, "k", "t", "id", d, "s", "e", hot).collect())


def brute(refs, kept):
    out = []
    for i, k, t, _ in refs:
        if not k:
            continue
        own = [(s, e) for kk, s, e, _ in kept if kk == k]
        if not own:
            out.append((i, "missing"))
        elif t is not None and not any(s is not None and s <= t and (e is None or e > t) for s, e in own):
            out.append((i, "late" if not any(s is not None and s <= t for s, _ in own) else "deleted"))
    return sorted(out)


def test_ties_nulls_and_order(spark):
    day = timedelta(days=1)
    kept = [("a", T0, T0 + day, 0), ("a", T0 + 3 * day, None, 0), ("b", T0, T0, 0), ("c", None, None, 0), ("", T0, None, 0)]
    times = [T0 - day, T0, T0 + day / 2, T0 + day, T0 + 2 * day, T0 + 3 * day, T0 + 90 * day, None]
    refs = [(n * 10 + m, k, t, "") for n, k in enumerate(["a", "b", "c", "x", None, ""]) for m, t in enumerate(times)]
    assert intervals(spark, refs, kept) == brute(refs, kept) == intervals(spark, refs, kept, 0)


def test_against_brute_force(spark):
    rng = random.Random(1)
    at = lambda: T0 + timedelta(hours=rng.randrange(200))
    refs = [(n, rng.choice("aaaaabcde"), at(), "") for n in range(400)]
    kept = []
    for _ in range(60):
        s = at()
        kept.append((rng.choice("aabcf"), s, rng.choice([None, s + timedelta(hours=rng.randrange(-3, 60))]), 0))
    assert intervals(spark, refs, kept) == brute(refs, kept) == intervals(spark, refs, kept, 30)
    assert intervals(spark, refs, []) == brute(refs, []) and intervals(spark, [], kept) == []


def test_changes_within_one_second_and_one_day_of_a_hot_key(spark):
    us = timedelta(microseconds=1)
    kept = [("a", T0 + n * 7 * us, T0 + (n * 7 + 3) * us, 0) for n in range(30)] + [("a", T0 + timedelta(hours=n), T0 + timedelta(hours=n, minutes=9), 0) for n in range(4)]
    refs = [(n, "a", T0 + n * us, "") for n in range(220)] + [(1000 + n, "a", T0 + timedelta(minutes=n), "") for n in range(200)]
    assert intervals(spark, refs, kept, 0) == brute(refs, kept)


def test_snapshots(spark):
    listed = spark.createDataFrame([(1, "2024-01-01", "en", "a"), (2, "2024-02-01", "en", "a"), (2, "2024-02-01", "en", "a"), (4, "2024-03-01", "en", "b"), (4, "2024-03-01", None, "b")], "snap int, day string, lang string, slug string")
    d = datetime
    refs = [(1, "a", d(2024, 1, 1)), (2, "a", d(2024, 2, 29, 23)), (3, "a", d(2024, 3, 1)), (4, "b", d(2024, 1, 5)), (5, "b", d(2024, 3, 5)), (6, "z", d(2024, 3, 5)), (7, "a", d(2023, 12, 31)), (8, "a", None), (9, "z", None), (10, None, d(2024, 1, 1))]
    df = spark.createDataFrame([(i, "en", s, t, "x") for i, s, t in refs], "id bigint, lang string, slug string, at timestamp_ntz, reason string")
    got = sorted((r.id, r.reason) for r in orphans_of_snapshots(df, "at", "id", ["lang", "slug"], listed, "snap", "day").collect())
    assert got == [(3, "deleted"), (4, "late"), (6, "missing"), (7, "late"), (9, "missing")]


def test_orphan_keys(spark):
    refs = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parents = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in orphan_keys(refs, parents, ["k"]).collect()] == ["b"]
