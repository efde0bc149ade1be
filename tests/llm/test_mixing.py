import os

import pytest

from folioforge.llm import mixing

pytestmark = pytest.mark.skipif(not os.path.exists(mixing.DEFAULT_VOCABULARY), reason="needs a vocabulary")


def make(spark, docs, targets, **options):
    d = spark.createDataFrame(docs, "doc_id bigint, source string, text string, copies int")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    return mixing.Mix(d, "doc_id", "source", "text", t, **options)


def documents(n, source, start=0):
    return [(start + k, source, f"word {k} " * (1 + k % 7), 9) for k in range(n)]


def test_shares_and_caps(spark):
    docs = documents(600, "Big") + documents(100, "small-one ", 1000) + documents(80, "other", 2000) + [(5000, None, "x", 1), (5001, "big", None, 1), (None, "big", "", 1)]
    targets = [("big", 0.4, 1), ("Small_One", 0.4, 4), ("gone", 0.2, 3)]
    mix = make(spark, docs, targets)
    shares = {r.source: r for r in mix.shares().collect()}
    assert abs(shares["big"].actual_share - 0.5) < 0.02 and abs(shares["small_one"].actual_share - 0.5) < 0.02 and shares["gone"].n_tokens == 0
    assert shares["big"].most_repeats <= 1 and shares["small_one"].most_repeats <= 4
    rows = mix.rows().collect()
    assert {r.source for r in rows} == {"big", "small_one"} and len({(r.doc_id, r.source, r.copy_no, r.text) for r in rows}) == len(rows)
    assert sum(s.n_copies for s in shares.values()) == len(rows)
    again = make(spark, docs, targets).rows().collect()
    assert sorted(map(str, again)) == sorted(map(str, rows)) and sorted(map(str, make(spark, docs, targets, seed=1).rows().collect())) != sorted(map(str, rows))


def test_fixed_total(spark):
    mix = make(spark, documents(400, "a") + documents(400, "b", 1000), [("a", 0.7, 3), ("b", 0.3, 3)], total=2000.0)
    by = {r.source: r for r in mix.shares().collect()}
    assert abs(by["a"].n_tokens - 1400) < 100 and abs(by["b"].n_tokens - 600) < 100


def test_poisson_inverse():
    import math

    for mean in (0.0, 0.3, 2.5):
        drawn = [mixing.copies_at((k + 0.5) / 20_000, mean, 50) for k in range(20_000)]
        for n in range(5):
            assert abs(drawn.count(n) / 20_000 - math.exp(-mean) * mean**n / math.factorial(n)) < 2e-3
    assert mixing.copies_at(0.999999, 3.0, 2) == 2


def test_large_means_and_caps():
    for mean in (900.0, 50_000.0):
        drawn = [mixing.copies_at((k + 0.5) / 2000, mean, 10**6) for k in range(2000)]
        assert abs(sum(drawn) / 2000 - mean) < 0.01 * mean and 0.8 < (sum((d - mean) ** 2 for d in drawn) / 2000) / mean < 1.2
        assert len(mixing.thresholds(mean, 10**6)[1]) < 30 * mean**0.5 + 100
    assert mixing.copies_at(0.5, 900.0, 7) == 7


def test_many_sources(spark):
    docs = [(n, f"s{n % 300}", f"word {n}", 1) for n in range(900)]
    shares = make(spark, docs, [(f"s{n}", 1 / 300, 1000) for n in range(300)], total=300_000.0).shares()
    rows = shares.collect()
    assert abs(sum(r.actual_share for r in rows) - 1) < 1e-6 and max(r.most_repeats for r in rows) <= 1000


def test_empty(spark):
    assert make(spark, [], [("a", 1.0, 1)]).rows().count() == 0 and make(spark, documents(3, "a"), []).rows().count() == 0
    assert make(spark, documents(3, "a"), [("a", None, None)]).rows().count() == 0
