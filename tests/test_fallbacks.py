import json

from pyspark.sql import functions as F

from folioforge.config import Config
from folioforge.operators import fallbacks as fb
from folioforge.operators import render
from folioforge.sources import ledgers, sinks

CONFIG = Config(blog_host="blog.h", image_hosts=("blog.h",), cdn_hosts=("cdn.h",))
ATTEMPT = "url string, payload string, final_url string, content_type string, size int"


def test_acceptance(spark):
    rows = [("image/png", "u", 1, True), ("image/png", "u", 0, False), ("text/plain", "https://h/a.PNG", 9, True), ("application/zip; x", "u", 9, True), ("text/html", "u", 9, False), (None, None, None, False), ("", "https://h/a.zip", 9, True)]
    df = spark.createDataFrame(rows, "t string, u string, n int, want boolean")
    got = df.select("want", fb.acceptable(F.col("t"), F.col("u"), F.col("n"), CONFIG, F.lit(True), F.lit(True)).alias("got")).collect()
    assert all(r.got == r.want for r in got)
    strict = df.select(fb.acceptable(F.col("t"), F.col("u"), F.col("n"), CONFIG, F.lit(False), F.lit(False)).alias("g")).collect()
    assert [r.g for r in strict] == [True] + [False] * 6


def test_each_kind_has_its_chain(spark):
    items = spark.createDataFrame([("d", "u1", "img"), ("d", "u2", "img"), ("d", "u3", "gdrive"), ("d", "u4", "linked_direct"), ("d", "https://cdn.h/u5", "linked_direct"), ("d", "u6", "linked_keyword"), ("d", "u7", "og_image"), ("d", "u7", "og_image")], "doc string, url string, kind string")
    direct = spark.createDataFrame([("u1", "p1", "u1", "image/png", 5), ("u1", "p0", "u1", "text/html", 5), ("u3", "p3", "u3", "image/png", 499), ("u6", "p6", "u6", "application/zip", 5)], ATTEMPT)
    archive = spark.createDataFrame([("u1", "a1", "x", "image/png", 5), ("u3", "a3", "x", "image/png", 1), ("u4", "a4", "x.png", "", 5), ("https://cdn.h/u5", "a5", "https://x/y.png", "", 5), ("u2", "a2", "x", "text/html", 5)], ATTEMPT)
    post = spark.createDataFrame([("d", "u2", "s2", "x", "image/gif", 5), ("d", "u4", "s4", "x", "image/gif", 5), ("e", "u7", "s7", "x", "image/gif", 5)], "doc string, " + ATTEMPT)
    got = sorted((r.url, r.how, r.payload) for r in fb.download_chain(items, direct, archive, post, CONFIG).collect() if r.how)
    assert got == [("https://cdn.h/u5", "archive", "a5"), ("u1", "direct", "p1"), ("u2", "archived_post", "s2"), ("u3", "archive", "a3"), ("u6", "direct", "p6")]
    assert fb.download_chain(items, direct, archive, post, CONFIG).count() == 8
    media = fb.media_chain(items, direct.filter("url = 'u1'"), archive.filter("url = 'u2'"), archive.filter("url = 'u3'"))
    assert sorted((r.url, r.how) for r in media.collect() if r.how) == [("u1", "direct"), ("u3", "forum")]


def test_overrides_and_remote_rewrites(spark):
    items = spark.createDataFrame([("d", "https://h/a.png?ref=x"), ("d", "https://h/b.png"), ("d", "https://h/c.png")], "doc string, url string")
    overrides = spark.createDataFrame([("https://h/a.png", "https://h/t.png"), ("https://h/b.png", "https://h/u.png")], "url string, target string")
    known = spark.createDataFrame([("https://h/t.png", "images/t.png")], "clean_url string, relative_path string")
    got = {r.url: (r.target, r.relative_path) for r in fb.overridden(items, overrides, known).collect()}
    assert got == {"https://h/a.png?ref=x": ("https://h/t.png", "images/t.png"), "https://h/b.png": ("https://h/u.png", None)}
    media = spark.createDataFrame([("https://h/m.mp4", "media/m.mp4"), ("https://h/n.mp4", "media/n.mp4")], "media_url string, relative_path string")
    config = Config(remote_base="https://r/", remote_rewrites={"https://h/m.mp4": "/x.mp4"})
    assert {r.media_url: r.relative_path for r in fb.remote_first(media, config).collect()} == {"https://h/m.mp4": "https://r/x.mp4", "https://h/n.mp4": "media/n.mp4"}
    failed = spark.createDataFrame([("u", "img", "Notice"), ("v", "og_image", "Notice"), ("w", "img", "Event")], "url string, kind string, category string")
    assert [r.url for r in fb.by_heading(failed, "Notice", True).collect()] == ["u"] and fb.by_heading(failed, "Notice", False).count() == 0


def test_candidates_of_other_languages(spark):
    posts = spark.createDataFrame([("k1", "a", "2024-01-02", "Notice", "m1"), ("k2", "b", "", "Notice", "m1"), ("k3", "c", "2020-01-01", "Notice", "")], "doc string, slug string, day string, category string, lastmod string")
    others = spark.createDataFrame([("e1", "en", "a", "2024-01-02", "Notice-en", "m1"), ("e2", "en", "z", "2024-01-02", "Notice-en", ""), ("e3", "en", "y", "2024-01-02", "Event", "m1"), ("e3", "en", "y", "2024-01-02", "Event", "m1"), ("e4", "en", "x", "2024-01-02", "Event", ""), ("j", "ja", "c", "2020-01-01", "", ""), ("b", "en", "b", "", "", "")], "url string, lang string, slug string, day string, category string, lastmod string")
    expected = spark.createDataFrame([("Notice", "en", "Notice-en"), ("Notice", "ja", None)], "category string, lang string, expected string")
    got = sorted((r.doc, r.url, r.score, r["rank"]) for r in fb.language_candidates(posts, others, expected, {"ja": "2021-01-01"}).collect())
    assert got == [("k1", "e1", 6, 1), ("k1", "e2", 1, 2), ("k1", "e3", 1, 3), ("k2", "b", 4, 1)]
    tags = spark.createDataFrame([("u", "en", "New Hero"), ("v", "en", "Event"), ("w", "en", "")], "url string, lang string, tag string")
    aliases = spark.createDataFrame([("en", "New Hero", "Universe")], "lang string, tag string, category string")
    assert {r.url: r.category for r in fb.category_index(tags, aliases).collect()} == {"u": "Universe", "v": "Event"}


def test_published_index_and_validity(spark, tmp_path):
    posts = spark.createDataFrame([("u", "en", "2024-01-02T00:00"), ("v", "ja", "2024-01-02"), ("w", "ja", "")], "url string, lang string, published_time string")
    days = fb.date_index(posts)
    categories = spark.createDataFrame([("u", "Event")], "url string, category string")
    sinks.write_published_index(days, categories, f"{tmp_path}/index")
    old = tmp_path / "old.json"
    old.write_text(json.dumps({"2024-01-02": [["u", "en"], ["v", "ja"]], "_meta": {"n": "2"}, "_categories": {"u": "Event"}}))
    for path in (f"{tmp_path}/index", str(old)):
        d, c = ledgers.published_index(spark, path)
        assert sorted(map(tuple, d.collect())) == [("2024-01-02", "u", "en"), ("2024-01-02", "v", "ja")] and [tuple(r) for r in c.collect()] == [("u", "Event")]
    (tmp_path / "bad.json").write_text("{")
    assert ledgers.published_index(spark, str(tmp_path / "bad.json"))[0].count() == 0 and ledgers.published_index(spark, f"{tmp_path}/none")[1].count() == 0
    import os

    os.utime(old, (1, 1))
    assert ledgers.still_valid(spark, f"{tmp_path}/index", [str(old), f"{tmp_path}/none"]) and not ledgers.still_valid(spark, str(old), [f"{tmp_path}/index"]) and not ledgers.still_valid(spark, f"{tmp_path}/none", [])


def test_hash_lists_snapshots_and_sorted_ledgers(spark, tmp_path):
    (tmp_path / "h.csv").write_text("hash,relative_path,is_thumb\nab,p1,T\nab,p2,\ncd,p3,\n")
    got = {r.sha256: (r.relative_path, r.is_thumb) for r in ledgers.hashes(spark, str(tmp_path / "h.csv")).collect()}
    assert got == {"ab": ("p2", True), "cd": ("p3", False)}
    assert ledgers.line_count(spark, str(tmp_path / "h.csv")) == 4
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "a.png").write_bytes(b"x")
    sha = __import__("hashlib").sha256(b"x").hexdigest()
    (tmp_path / "old.txt").write_text(sha + "\n\n")
    assert [r.is_thumb for r in ledgers.file_hashes(spark, f"file://{tmp_path}/img", legacy=ledgers.legacy_thumbs(spark, str(tmp_path / "old.txt"))).collect()] == [True]
    rows = spark.createDataFrame([("k", n, str(n), "https://f/a" if n % 2 else "https://g/b", "404" if n < 3 else "200") for n in range(9)], "k string, pos int, timestamp string, original string, status string")
    assert [r.timestamp for r in ledgers.oldest_snapshots(rows, ["k"]).collect()] == ["3"] and ledgers.oldest_snapshots(rows, ["k"], 3).count() == 0
    assert [tuple(r) for r in ledgers.snapshots_below(rows, "https://f/", "4", "8", 10).collect()] == [("https://f/a", 5)]
    df = spark.createDataFrame([(f"k{n:03d}", n) for n in range(300)], "k string, v int").repartition(5)
    sinks.write_ledger(df, f"{tmp_path}/sorted", [F.col("k").desc()], mark=True)
    parts = sorted(p for p in (tmp_path / "sorted").iterdir() if p.suffix == ".csv")
    lines = [x for p in parts for x in p.read_text().splitlines()]
    assert all(p.read_text().startswith("﻿k,v") for p in parts) and [x for x in lines if x[0] == "k"] == [f"k{n:03d},{n}" for n in reversed(range(300))]


def test_styles_linked_data_logo_tags_and_spellings(spark):
    page = """<html><head><link rel="stylesheet" href="/s.css"><link rel="stylesheet" href="/none.css"><script type="application/ld+json">{"image":{"url":"https:\\/\\/blog.h\\/content\\/images\\/ld.png"}}</script></head>
<body><a class="site-nav-logo" href="https://blog.h">x</a><article><a href="/Other//?x=1#y">o</a><a href="/tag/news/">t</a><a href="/tag/else/">e</a></article></body></html>"""
    docs = spark.createDataFrame([("https://blog.h/p/", page, "News")], "url string, html string, category string")
    none = spark.createDataFrame([], "clean_url string, relative_path string")
    media = spark.createDataFrame([], "media_url string, relative_path string")
    pages = spark.createDataFrame([("https://blog.h/Other/", "News/other.html")], "page_url string, path string")
    recovered = spark.createDataFrame([], "post_url string, relative_path string, anchor_type string, anchor_text string")
    assets = spark.createDataFrame([("https://blog.h/s.css", "s_12.css")], "url string, file string")
    config = Config(blog_host="blog.h", tag_categories={"news": "Notice"})
    out = render.localised(docs, "url", "html", "category", none, media, pages, recovered, config, assets).first()
    for want in ('href="../../assets/s_12.css"', 'href="/none.css"', 'class="site-nav-logo" href="../index.html"', 'href="../News/other.html"', 'href="../Notice/index.html"', 'href="../else.html"'):
        assert want in out.html, want
    assert out.unmapped == ["https://blog.h/content/images/ld.png"]
    css = spark.createDataFrame([("a{background:url(../i.png)} b{src:url('data:x')}", "https://h/c/s.css")], "css string, base string")
    assert css.select(render.absolute_css("css", "base")).first()[0] == "a{background:url(https://h/i.png)} b{src:url('data:x')}"
    listing = '<html><link rel="next" href="x"><div class="post-feed"><p>old</p></div><nav class="pagination">1</nav></html>'
    assert render.listing_template(listing) == '<html><div class="post-feed">{posts}</div></html>' and render.listing_template("<p>x</p>") is None


def test_stages_take_overrides_the_archive_and_like_headings(spark):
    from folioforge.plans.pipeline import Stages

    config = Config(blog_host="blog.h", image_hosts=("blog.h",), image_overrides={"https://blog.h/content/images/c.png": "https://blog.h/content/images/t.png"}, heading_similarity=0.8)
    page = lambda body: f'<html><head><meta property="article:tag" content="Notice"></head><body><article><h1>T</h1><h2>Rewards of may</h2>{body}</article></body></html>'.encode()
    image = lambda n: f'<img src="/content/images/{n}.png">'
    posts = spark.createDataFrame([("https://blog.h/p/", "2024-05-02", ""), ("https://blog.h/q/", "2024-05-03", "")], "url string, lastmod string, published_time string")
    good = lambda url, kind, content: (url, 200, url, kind, "", content)
    fetches = spark.createDataFrame(
        [
            good("https://blog.h/p/", "text/html", page(image("a") + image("b") + image("c"))),
            good("https://blog.h/q/", "text/html", page(image("x") + image("y") + image("lost"))),
            good("https://blog.h/content/images/a.png", "image/png", b"a"),
            good("https://snap/b", "image/png", b"b"),
        ],
        "url string, status int, final_url string, content_type string, content_disposition string, content binary",
    )
    archive = spark.createDataFrame([("https://blog.h/content/images/b.png", "https://snap/b", "https://snap/b", "image/png", 1)], ATTEMPT)
    earlier = spark.createDataFrame([("https://blog.h/content/images/t.png", "images/t.png"), ("https://blog.h/content/images/c.png", "images/c-of-before.png")], "clean_url string, relative_path string")
    run = lambda retry: Stages(posts, fetches, config, archive=archive, earlier=earlier, retry=retry).run(("html", "images"))
    out = run(False)
    paths = {r.clean_url.rsplit("/", 1)[1]: r.relative_path for r in out["image_map"].collect()}
    assert set(paths) == {"a.png", "b.png", "c.png"} and paths["c.png"] == "images/t.png"
    assert sorted(r.img_url.rsplit("/", 1)[1] for r in out["failed_images"].collect()) == ["lost.png", "x.png", "y.png"]
    out = run(True)
    paths = {r.clean_url.rsplit("/", 1)[1]: r.relative_path for r in out["image_map"].collect()}
    assert paths["lost.png"] == "images/c-of-before.png" and "x.png" not in paths
    assert sorted(r.img_url.rsplit("/", 1)[1] for r in out["failed_images"].collect()) == ["x.png", "y.png"]
