import random

from pyspark.sql import functions as F

from folioforge.operators import relations as rel


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_merge_keeps_the_first_place_and_the_last_date(spark):
    rows = [(0, "a", "2024-01-01", 0), (0, "b", "", 1), (0, "c", "2024-01-02", 2), (1, "d", "2024-01-02", 0), (1, "a", "2024-01-02", 1), (1, "e", None, 2)]
    lists = spark.createDataFrame(rows, "l int, url string, d string, o int")
    got = [r.url for r in rel.merge_lists(lists, "l", "url", "d", "o").orderBy("position").collect()]
    assert got == ["a", "c", "d", "b", "e"]


def test_ledgers(spark):
    ledger = spark.createDataFrame([("p", "x", "r"), ("p", "", "r"), ("q", None, "r")], "post string, item string, reason string")
    assert rel.ledger_add(ledger, ledger).count() == 3
    assert rows(rel.ledger_remove(ledger, spark.createDataFrame([("q", None)], "post string, item string"), ["post", "item"]), "post") == [("p",), ("p",)]
    assert {r.post: r["items"] for r in rel.failed_entries(ledger.union(spark.createDataFrame([("z", "b", ""), ("z", "a", "")], ledger.schema)), "post", "item").collect()} == {"p": None, "q": None, "z": ["a", "b"]}
    fixed = spark.createDataFrame([("p", "x"), ("p", "")], "post string, item string")
    assert rows(rel.still_failed(ledger.fillna(""), fixed, "post", "item"), "post", "item") == [("p", ""), ("q", "")]
    posts = spark.createDataFrame([("p",), ("z",), ("y",)], "post string")
    assert rows(rel.retry_scope(posts, [ledger, spark.createDataFrame([("y",)], "post string")], ["post"]), "post") == [("p",), ("y",)]
    assert rows(rel.pending(posts, ledger, ["post"]), "post") == [("y",), ("z",)]


def test_dedup_is_the_same_for_any_partitioning(spark):
    rng = random.Random(2)
    data = [(n, rng.choice("abc"), f"p{n}") for n in range(60)]
    df = spark.createDataFrame(data, "n int, c string, path string")
    results = [rows(rel.content_dedup(df.repartition(k), F.col("c"), ["n"], "path"), "n", "kept_path", "is_alias") for k in (1, 7)]
    first = {c: next(p for _, x, p in data if x == c) for c in "abc"}
    assert results[0] == results[1] == sorted((n, first[c], p != first[c]) for n, c, p in data)


def test_collision_names(spark):
    df = spark.createDataFrame([("f", "a", "h1", 2), ("f", "a", "h2", 1), ("f", "a", "h1", 5), ("g", "a", "h1", 1)], "f string, n string, h string, o int")
    assert rows(rel.collision_names(df, "f", "n", "h", ["o"]), "f", "h", "saved_name") == [("f", "h1", "a_2"), ("f", "h2", "a"), ("g", "h1", "a")]


def test_first_available(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    one = spark.createDataFrame([("a", "1"), ("b", None)], "k string, v string")
    two = spark.createDataFrame([("a", "0"), ("b", "2")], "k string, v string")
    assert rows(rel.first_available(df, [("one", one), ("two", two)], ["k"], "v").fillna(""), "k", "v", "how") == [("a", "1", "one"), ("b", "2", "two"), ("c", "", "none")]


def test_interval_join(spark):
    rng = random.Random(3)
    data = [(n, rng.choice("ab"), f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d}") for n in range(60)]
    df = spark.createDataFrame(data, "i int, k string, d string")
    got = rows(rel.interval_pairs(df.withColumnRenamed("i", "l"), df.withColumnRenamed("i", "r"), ["k"], "l", "r", "d", "d", 20), "l", "r", "days")
    from datetime import date

    far = lambda a, b: abs((date.fromisoformat(a) - date.fromisoformat(b)).days)
    want = sorted((a[0], b[0], far(a[2], b[2])) for a in data for b in data if a[1] == b[1] and far(a[2], b[2]) <= 20)
    assert got == want
    near = {r.l: (r.r, r.days) for r in rel.nearest(spark.createDataFrame([(1, 5, 2), (1, 4, 2), (1, 9, 3)], "l int, r int, days int"), "l", "r", "days").collect()}
    assert near == {1: (4, 2)}


def test_titles_sections_and_reach(spark):
    a = spark.createDataFrame([(1, "d", "Harbor festival"), (2, "d", "zzz"), (3, "e", "x")], "i long, d string, t string")
    b = spark.createDataFrame([(7, "d", "Harbour festival"), (8, "d", "Castle")], "j long, d string, u string")
    assert rows(rel.best_title(a, b, ["d"], "i", "t", "j", "u", 0.55), "i", "j") == [(1, 7)]
    ev = spark.createDataFrame([(n, 1, n, k) for n, k in enumerate("xhxxhx")], "id int, g int, o int, k string")
    assert [r.h for r in rel.previous_marked(ev, ["g"], ["o"], F.col("k") == "h", "id", "h").orderBy("id").collect()] == [None, None, 1, 1, 1, 4]
    assert [(r.section, r.pos, r.total) for r in rel.sections(ev, ["g"], ["o"], F.col("k") == "h").orderBy("id").collect()] == [(0, 0, 1), (1, 0, 3), (1, 1, 3), (1, 2, 3), (2, 0, 2), (2, 1, 2)]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("b", "a"), (None, "x")], "s string, t string")
    assert rows(rel.reachable(edges, "s", "t", spark.createDataFrame([("a",)], "n string"), "n"), "n", "hops") == [("a", 2), ("b", 1), ("c", 2)]


def test_sample(spark):
    df = spark.range(95).withColumnRenamed("id", "k")
    assert rel.sample(df, "k", 50).count() == 9 and rel.sample(df, "k", 3).count() == 3 and rel.sample(df.limit(4), "k", 3).count() == 1
    assert rows(rel.sample(df, "k", 5, seed=1), "k") == rows(rel.sample(df.repartition(5), "k", 5, seed=1), "k")
