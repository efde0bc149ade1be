from pyspark.sql import functions as F

from folioforge.operators import recovery as rec


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_donors(spark):
    sections = spark.createDataFrame(
        [("p", 1, "Harbor news", 0, 2, "b1"), ("p", 1, "Harbor news", 1, 2, "b2"), ("q", 1, "Harbor news!", 0, 2, "g1"), ("q", 1, "Harbor news!", 1, 2, "g2"), ("r", 1, "Harbor news", 0, 1, "h1"), ("s", 1, "Harbor news", 0, 2, "i1"), ("s", 1, "Harbor news", 1, 2, "i2")],
        "doc string, section int, heading string, pos int, total int, url string",
    )
    posts = spark.createDataFrame([("p", "N", "2024-03-01"), ("q", "N", "2024-03-10"), ("r", "N", "2024-03-02"), ("s", "N", "2024-09-01"), ("t", "E", "2024-03-01")], "doc string, category string, day string")
    broken = spark.createDataFrame([("p", "b2"), ("p", "gone")], "doc string, url string")
    assert rows(rec.donor_images(broken, sections, posts, 62, 0.9), "doc", "url", "donor", "donor_url", "days") == [("p", "b2", "q", "g2", 9)]


def test_archived_and_same_place(spark):
    items = spark.createDataFrame([("p", "https://h/a/size/w6/x.png"), ("p", "https://h/none.png")], "doc string, url string")
    archived = spark.createDataFrame([("p", 2, "https://web.archive.org/web/2020im_/http://H/a/x.png?2"), ("p", 1, "https://web.archive.org/web/2020im_/http://h/a/x.png?1")], "doc string, ord int, url string")
    assert rows(rec.archived_page_match(items, archived), "url", "archived_url") == [("https://h/a/size/w6/x.png", "https://web.archive.org/web/2020im_/http://h/a/x.png?1")]
    a = spark.createDataFrame([("p", 0, "a0"), ("p", 1, "a1"), ("q", 0, "b0")], "doc string, pos int, url string")
    b = spark.createDataFrame([("p", 0, "x0"), ("p", 1, "x1"), ("q", 0, "y0"), ("q", 1, "y1")], "doc string, pos int, url string")
    assert rows(rec.same_place(a, b, ["doc"]), "url", "other_url") == [("a0", "x0"), ("a1", "x1")]


def test_chain_and_sizes(spark):
    items = spark.createDataFrame([("p", "1"), ("p", "2"), ("p", "3")], "doc string, url string")
    found = lambda *r: spark.createDataFrame(list(r), "doc string, url string, found string, rank int")
    got = rec.language_chain(items, found(("p", "1", None, 1)), found(("p", "1", "y", 2), ("p", "1", "x", 1)), found(("p", "1", "z", 0), ("p", "2", "w", 1)))
    assert rows(got.fillna(""), "url", "found", "phase") == [("1", "x", "A2"), ("2", "w", "B"), ("3", "", "")]
    c = lambda *r: spark.createDataFrame(list(r), "k int, c binary")
    got = rec.larger_first(c((1, b"aa"), (2, b"a"), (3, b"aa"), (4, b"x")), c((1, b"bb"), (2, b"bb"), (3, b"aa"), (5, b"y")), ["k"], "c")
    assert [(r.k, bytes(r.c), r.source, r.alternative and bytes(r.alternative)) for r in got.orderBy("k").collect()] == [(1, b"aa", "a", b"bb"), (2, b"bb", "b", b"a"), (3, b"aa", "a", None), (4, b"x", "a", None), (5, b"y", "b", None)]


def test_channel_and_forum(spark):
    df = spark.createDataFrame([(1, False, ["a", "b"]), (2, False, ["a", "b"]), (3, False, ["a", "b"]), (1, True, ["a"]), (1, False, [])], "idx int, own boolean, urls array<string>")
    assert [r.channel_url for r in rec.channel_image(df, F.col("urls"), F.col("idx"), F.col("own")).collect()] == ["a", "b", None, "a", None]
    posts = spark.createDataFrame([("p", "My Title", "2020-05-10"), ("q", "My Title", ""), ("r", "My Title", "2024-01-01")], "doc string, title string, day string")
    pages = spark.createDataFrame([("https://f/x/My%2Dtitle-1", "2020-05-30", 5), ("https://f/my-title-2", "2020-06-05", 1), ("https://f/my-title-0", "2019-02-01", 9), ("https://f/else", "2020-05-10", 0)], "page string, day string, ord int")
    assert rows(rec.forum_page(posts, pages, 30, ("2019-01-01", "2021-12-31")), "doc", "page") == [("p", "https://f/my-title-2"), ("q", "https://f/my-title-2")]


def test_recovered_media(spark):
    page = "<article><p>A long enough piece of text stands here.</p><video src='/web/2020/https://h/a.mp4'><source src='b.webm'></video><p>short</p><audio src='c.mp3'></audio><video src='/web/2020/https://h/a.mp4'></video></article>"
    df = spark.createDataFrame([("p", "https://web.archive.org/web/2020/https://h/x/", page), ("q", "", None)], "url string, base string, html string")
    got = [(r.url, r.kind, r.anchor_type, r.anchor_text) for r in rec.recovered_media(df, "url", "base", "html").orderBy("ord").collect()]
    assert got == [
        ("https://h/a.mp4", "video_tag", "positioned", "A long enough piece of text stands here."),
        ("https://h/x/b.webm", "video_tag", "positioned", "A long enough piece of text stands here."),
        ("https://h/x/c.mp3", "audio_tag", "append", ""),
    ]
