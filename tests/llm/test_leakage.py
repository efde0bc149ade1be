import random
import unicodedata

from folioforge.llm import leakage
from folioforge.llm.leakage import build_index, leaked_items, plain, search, unit_of, words

rng = random.Random(3)
VOCABULARY = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(400)]
KANA = "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわをん山川田中"


def text(n: int) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


def changed(w: list[str], edits: int) -> list[str]:
    """w with edits spread evenly, each a change, a drop or an addition."""
    w = list(w)
    for k in range(edits, 0, -1):
        at = k * len(w) // (edits + 1)
        kind = rng.randrange(3)
        if kind == 0:
            w[at] = "zzzz"
        elif kind == 1:
            del w[at]
        else:
            w.insert(at, "yyyy")
    return w


def run(spark, docs, items):
    d = spark.createDataFrame([(n, t, "x") for n, t in docs], "doc_id bigint, text string, item_id string")
    i = spark.createDataFrame([(n, t, "x") for n, t in items], "item_id bigint, text string, doc_id string")
    return {(r.doc_id, r.item_id): r.n_tokens for r in leaked_items(d, "doc_id", "text", i, "item_id", "text").collect()}


def test_passages_edits_and_shorter_overlaps(spark):
    items = [(n, " ".join(text(60))) for n in range(5)]
    w = {n: t.split() for n, t in items}
    around = lambda part: " ".join(text(30) + part + text(30))
    docs = [
        (1, around(w[0])),
        (2, around(w[1][10:30])),  # just long enough
        (3, around(w[1][10:27])),  # too short
        (4, around(changed(w[2], 4))),
        (5, around(changed(w[3][5:45], 3))),
        (6, around(w[4][:10] + text(12) + w[4][10:20])),  # in two pieces
        (7, " ".join(text(100))),
        (8, None),
        (9, ""),
        (10, " ".join(w[0] + w[4])),
        (10, " ".join(w[0] + w[4])),
        (11, " ".join(text(60_000) + w[2])),
    ]
    got = run(spark, docs, items)
    assert set(got) == {(1, 0), (2, 1), (4, 2), (5, 3), (10, 0), (10, 4), (11, 2)}
    assert got[1, 0] == 60 and got[2, 1] == 20


def test_forms_do_not_matter(spark):
    w = text(30)
    w[3] = "café"
    item = " ".join(w)
    wide = "".join(chr(ord(c) + 0xFEE0) if c.isascii() and c.isalpha() else c for c in item)
    docs = [
        (1, item.upper().replace(" ", ",\n  ")),
        (2, wide),
        (3, unicodedata.normalize("NFD", item)),
        (4, " ".join(f"<b>{x}</b>" if n % 4 == 0 else f"**{x}**" if n % 4 == 1 else x[:2] + "\u200b" + x[2:] for n, x in enumerate(w))),
        (5, " ".join(f"[{x}](https://h/a)" for x in w)),
    ]
    assert {k[0] for k in run(spark, docs, [(1, item)])} == {1, 2, 3, 4, 5}


def test_japanese_counts_characters(spark):
    body = "".join(rng.choice(KANA) for _ in range(120))
    other = lambda n: "".join(rng.choice(KANA) for _ in range(n))
    docs = [(1, other(50) + body[20:90] + other(50)), (2, other(50) + body[20:70] + other(50)), (3, "、".join(body)), (4, body[:30] + "ン" + body[31:60] + "ン" + body[61:])]
    assert {k[0] for k in run(spark, docs, [(1, body)])} == {1, 3, 4}
    assert unit_of(body).name == "characters" and unit_of("hello there").name == "words"


def test_no_items_no_documents_equal_items(spark):
    t = " ".join(text(30))
    assert run(spark, [(1, t)], []) == {} and run(spark, [], [(1, t)]) == {} and run(spark, [(1, t)], [(1, None), (2, "short")]) == {}
    assert set(run(spark, [(1, t), (2, t)], [(1, t), (2, t)])) == {(1, 1), (1, 2), (2, 1), (2, 2)}


def test_plain():
    assert words(plain("Don’t <i>STOP</i>&amp;go ﬁne")) == ["dont", "stop", "go", "fine"]


def test_a_refrain_has_few_distinct_terms(spark):
    refrain = "hey ho the wind " * 6
    assert run(spark, [(1, " ".join(text(30)) + " " + refrain + " ".join(text(30))), (2, " ".join(text(60)))], [(7, refrain)]).keys() == {(1, 7)}


def test_scripts_without_spaces_count_characters(spark):
    han = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(90))
    thai = "".join(rng.choice("กขคงจฉชซญดตถทนบปผพฟมยรลวสหอ") + rng.choice(["", "ิ", "ี", "่", "้", "า"]) for _ in range(110))
    other = lambda n: "".join(chr(rng.randrange(0x9000, 0x9FA0)) for _ in range(n))
    docs = [(1, other(40) + han[10:74] + other(40)), (2, other(40) + han[10:60] + other(40)), (3, "ก" * 30 + thai + "ข" * 30), (4, thai[:40])]
    assert run(spark, docs, [(7, han), (8, thai)]).keys() == {(1, 7), (3, 8)}
    assert unit_of(han).name == unit_of(thai).name == "characters" and unit_of("हिन्दी में लिखा हुआ").name == "words"
    assert words("हिन्दी में") == ["हिन्दी", "में"]


def test_long_tags_and_links_are_no_words(spark):
    w = text(30)
    docs = [(1, " ".join(w[:15]) + f" <img src='data:image/png;base64,{'A' * 4000}'> " + " ".join(w[15:])), (2, " ".join(w[:15]) + f" [{w[15]}](https://h/{'b' * 3000}) " + " ".join(w[16:]))]
    got = run(spark, docs, [(1, " ".join(w))])
    assert got == {(1, 1): 30, (2, 1): 30}


def test_many_tokens_added_at_one_place(spark):
    w = text(400)
    docs = [(1, " ".join(w[:200] + text(15) + w[200:])), (2, " ".join(w[:200] + text(60) + w[200:]))]
    assert run(spark, docs, [(1, " ".join(w))]) == {(1, 1): 400, (2, 1): 200}


def test_an_index_serves_further_items_without_the_texts(spark, tmp_path):
    a, b = text(40), text(40)
    spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id bigint, text string").write.parquet(f"{tmp_path}/docs")
    index = build_index(spark.read.parquet(f"{tmp_path}/docs"), "doc_id", "text")
    (tmp_path / "docs").rename(tmp_path / "gone")
    for n, w in ((5, a), (6, b)):
        found = search(index, spark.createDataFrame([(n, " ".join(w))], "item_id bigint, text string"), "item_id", "text")
        assert [tuple(r) for r in found.collect()] == [(n - 4, n, 40)]


def test_sets_of_items_and_small_blocks_change_nothing(spark, monkeypatch):
    items = [(n, " ".join(text(50))) for n in range(8)]
    docs = [(n, " ".join(text(20) + items[n % 8][1].split()[5:45] + text(20))) for n in range(40)]
    whole = run(spark, docs, items)
    assert len(whole) >= 40
    monkeypatch.setattr(leakage, "ITEM_TOKENS", 120)
    monkeypatch.setattr(leakage, "BLOCK_TOKENS", 200)
    monkeypatch.setattr(leakage, "CHUNK", 50)
    assert run(spark, docs, items) == whole


def test_against_brute_force(spark):
    """All placements of edits that a passage may have: whatever the alignment finds on all diagonals, the index finds."""
    import numpy as np

    items = [" ".join(text(45)) for _ in range(4)]
    docs = []
    for n in range(60):
        w = items[n % 4].split()
        start = rng.randrange(20)
        docs.append((n, " ".join(text(10) + changed(w[start : start + rng.randrange(15, 26)], rng.randrange(3)) + text(10))))
    got = run(spark, docs, list(enumerate(items)))
    for n, d in docs:
        for i, item in enumerate(items):
            own, there = words(item), words(d)
            code = {t: k for k, t in enumerate(dict.fromkeys([*own, *there]))}
            least = leakage.longest_passage(np.array([code[t] for t in own]), np.array([code[t] for t in there]), set(range(-len(own), len(there))), leakage.WORDS)
            assert got.get((n, i), 0) == least
