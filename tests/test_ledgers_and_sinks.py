import json

from pyspark.sql import functions as F

from folioforge.config import Config, merged
from folioforge.sources import ledgers as L
from folioforge.sources import sinks


def write(tmp_path, name, text, bom=False):
    path = tmp_path / name
    path.write_bytes(("﻿" if bom else "").encode() + text.encode())
    return f"file://{path}"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_post_list(spark, tmp_path):
    path = write(tmp_path, "p.csv", 'url,lastmod,published_time\n# note\nhttps://h/a , 2024-01-01,x\n\nhttps://h/b\n"https://h/c,1","2,""3"""\nurl,lastmod,published_time\n', bom=True)
    assert rows(L.posts(spark, path), "url", "lastmod", "published_time") == [("https://h/a", "2024-01-01", "x"), ("https://h/b", "", ""), ("https://h/c,1", '2,"3"', "")]


def test_missing_file_is_empty(spark, tmp_path):
    none = f"file://{tmp_path}/none.csv"
    for read in (L.posts, L.image_map, L.done, L.failed, L.stale, L.seen, L.done_counts, L.media_map, L.hashes, L.sitemap):
        assert read(spark, none).count() == 0


def test_maps_and_ledgers(spark, tmp_path):
    m = write(tmp_path, "m.csv", "clean_url,relative_path\nu,a\nu,b\nv\nw,x,y\n")
    assert rows(L.image_map(spark, m), "clean_url", "relative_path") == [("u", "b")]
    d = write(tmp_path, "d.csv", "slug,post_url\ns,1\ns,2\nt,\n")
    assert rows(L.done(spark, d), "slug", "post_url") == [("s", "2")]
    f = write(tmp_path, "f.csv", "post_url,img_url,reason\np,i,r\np,i,r\n")
    assert rows(L.failed(spark, f, "img_url"), "post_url", "img_url", "reason") == [("p", "i", "r")]
    s = write(tmp_path, "s.csv", "post_url,unmapped_urls\np,a|b|a\n")
    assert rows(L.stale(spark, s), "post_url", "unmapped") == [("p", ["a", "b"])]
    k = write(tmp_path, "k.txt", "main:u\nthumb:u\nu\nhttps://h/x\n")
    assert rows(L.seen(spark, k), "scope", "url") == [("main", "https://h/x"), ("main", "u"), ("thumb", "u")]
    c = write(tmp_path, "c.csv", "post_url,image_count\np,3\np,x\nq,7\n")
    assert rows(L.done_counts(spark, c), "post_url", "n") == [("p", 0), ("q", 7)]
    mm = write(tmp_path, "mm.csv", "post_url,media_url,relative_path,anchor_type,anchor_text\np,u,1\np,u,2,append,t\np,v,3,positioned,ctx\n")
    assert rows(L.media_map(spark, mm), "media_url", "relative_path", "anchor_type", "anchor_text") == [("u", "1", "inline", ""), ("v", "3", "positioned", "ctx")]
    h = write(tmp_path, "h.csv", "sha256_hash,relative_path,is_thumbnail\nab,p1,T\nab,p2,\ncd,p3,\n")
    assert rows(L.hashes(spark, h), "sha256", "relative_path", "is_thumb") == [("ab", "p2", True), ("cd", "p3", False)]


def test_files(spark, tmp_path):
    (tmp_path / "x" / "thumbnails").mkdir(parents=True)
    (tmp_path / "x" / "a.html").write_text("A")
    (tmp_path / "x" / "thumbnails" / "b.html").write_text("A")
    assert [r.relative_path.endswith("x/a.html") for r in L.file_hashes(spark, f"file://{tmp_path}/x").collect()] == [True]
    done = spark.createDataFrame([("a", "https://h/a")], "slug string, post_url string")
    assert rows(L.html_files(spark, f"file://{tmp_path}/x", done), "post_url", "html") == [("https://h/a", "A")]


def test_sitemap(spark, tmp_path):
    xml = """<?xml version="1.0"?><s:urlset xmlns:s="x"><!-- <url><loc>no</loc></url> --><s:url><s:loc> https://h/a?x=1&amp;y=2 </s:loc><s:lastmod>2024-05-06T07:08:09Z</s:lastmod>
    <image:image><image:loc>https://h/i.png</image:loc></image:image></s:url><s:url><s:loc><![CDATA[https://h/b]]></s:loc></s:url><s:url><s:lastmod>2024-01-01</s:lastmod></s:url></s:urlset>"""
    assert rows(L.sitemap(spark, write(tmp_path, "s.xml", xml)), "position", "url", "lastmod") == [(1, "https://h/a?x=1&y=2", "2024-05-06"), (2, "https://h/b", "")]
    assert L.sitemap(spark, write(tmp_path, "bad.xml", "<urlset><url><loc>x")).count() == 0


def test_json_responses(spark):
    cdx = spark.createDataFrame([("u", json.dumps([["timestamp", "original", "statuscode"], ["2021", "o2", "200"], ["2020", "o1", "301"], ["2019", "o0", "404"]])), ("v", "[]"), ("w", "{")], "k string, body string")
    got = L.oldest_snapshots(L.cdx_rows(cdx, F.col("body"), ["k"]), ["k"])
    assert rows(got, "k", "timestamp", "original") == [("u", "2021", "o2")]
    page = {"items": [{"id": 1, "title": "t", "published_at": 5, "sort": "10", "media": [{"type": "image", "url": "a"}, {"type": "link", "images": [{"url": ""}, {"url": "b"}]}, {"type": "video"}]}, {"id": 2, "title": "u", "sort": "9"}]}
    items = L.channel_page_items(spark.createDataFrame([(json.dumps(page),), ("x",)], "body string"), F.col("body"))
    assert rows(items, "id", "media_urls", "sort") == [(1, ["a", "b"], 10), (2, [], 9)]
    cached = spark.createDataFrame([(2, "old", 1, ["z"], 9)], items.schema)
    assert rows(L.merge_channel(cached, items), "id", "title") == [(1, "t"), (2, "old")]


def test_csv_and_texts(spark, tmp_path):
    df = spark.createDataFrame([('a,"b', "", "c d")], "x string, y string, z string")
    assert df.select(sinks.csv_line(F.col("x"), F.col("y"), F.col("z")).alias("l")).first().l == '"a,""b",,c d'
    texts = spark.createDataFrame([("f", "n", "A", 1), ("f", "n", "B", 2), ("f", "n", "A", 3)], "f string, n string, t string, o int")
    assert rows(sinks.named_texts(texts, "f", "n", "t", ["o"]), "file", "t") == [("n", "A"), ("n_2", "B")]
    path = f"file://{tmp_path}/out"
    sinks.write_ledger(spark.createDataFrame([("b", 1), ("a", 2)], "k string, v int"), path, [F.col("k")])
    assert [r.value for r in spark.read.text(path).collect()] == ["k,v", "a,2", "b,1"]
    logs = spark.createDataFrame([("q", "x", "2"), ("p", "x", "1")], "post_url string, fallback_type string, saved_path string")
    assert [r.post_url for r in sinks.report([logs, logs.limit(0)]).collect()] == ["p", "q"]


def test_config(tmp_path):
    assert merged({"a": {"b": 1, "c": [1]}, "d": 1}, {"a": {"c": [2]}, "d": {"e": 1}}) == {"a": {"b": 1, "c": [2]}, "d": {"e": 1}}
    (tmp_path / "c.toml").write_text('blog_host = "b.h"\nremote_base = "https://r/"\n[remote_rewrites]\n"https://x" = "/y"\n')
    config = Config.read(str(tmp_path / "c.toml"))
    assert config.blog_host == "b.h" and config.remote_urls() == {"https://x": "https://r/y"}
    (tmp_path / "bad.toml").write_text('[remote_rewrites]\n"https://x" = "y"\n')
    try:
        Config.read(str(tmp_path / "bad.toml"))
        raise AssertionError
    except ValueError:
        pass
