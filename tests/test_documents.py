from folioforge.config import Config
from folioforge.functions.dom import elements, parse, text_of
from folioforge.operators import documents as docs

CONFIG = Config(blog_host="blog.h", image_hosts=("blog.h",), cdn_hosts=("cdn.h",))
PAGE = """<html><head><title>T</title><meta property="og:image" content="https://blog.h/content/images/a.png">
<meta property="article:tag" content="Event"><meta property="article:tag" content="Notice"><script>var t="</p><img src='/x.png'>"</script></head>
<body><nav><a href="/n">n</a></nav><article><h1>Head &amp; line</h1>
<img src="/content/images/size/w600/a.png"><img class="author-profile-image" src="/content/images/me.png">
<div class="author-card"><img src="/content/images/card.png"></div><img data-src="https://cdn.h/x/b.JPG"><img src="https://other/c.png">
<p>before <a href="https://drive.google.com/file/1">pic<p><a href="https://drive.google.com/spreadsheets/2">no</a>
<a href="/f.zip">zip</a><a href="https://forms.gle/x.zip">skip</a><a href="/w">1920 x 1080</a><a href="/v">Download it</a><a href="#top">x</a>
<h2>OST list</h2><p><a href="https://drive.google.com/file/3">track</a></p>
<video src="/m.mp4" poster="/p.png"><source src="/m.webm"></video><picture><source src="/no.webp"></picture><audio src="/s.mp3"></audio>
<a href="/clip.mov">clip</a><a href="https://youtu.be/x.mp4">tube</a>
<strong>Bold</strong><h3>Gallery</h3><div><img src="/content/images/g1.png"></div><img src="/content/images/g2.png"></article></body></html>"""


def nodes(spark, *pages):
    df = spark.createDataFrame([(f"https://blog.h/p{n}/", p, "x") for n, p in enumerate(pages)], "url string, html string, tag string")
    return docs.node_table(df, "url", "html")


def test_image_items(spark):
    got = [(r.url, r.kind) for r in docs.image_items(nodes(spark, PAGE), CONFIG).orderBy("idx").collect()]
    assert got == [
        ("https://blog.h/content/images/a.png", "og_image"),
        ("https://blog.h/content/images/a.png", "img"),
        ("https://cdn.h/x/b.JPG", "img"),
        ("https://blog.h/content/images/g1.png", "img"),
        ("https://blog.h/content/images/g2.png", "img"),
        ("https://drive.google.com/file/1", "gdrive"),
        ("https://blog.h/f.zip", "linked_direct"),
        ("https://blog.h/w", "linked_keyword"),
        ("https://blog.h/v", "linked_keyword"),
        ("https://drive.google.com/file/3", "gdrive"),
    ]


def test_sound_and_media(spark):
    n = nodes(spark, PAGE)
    assert [r.url for r in docs.non_image_urls(n, CONFIG).collect()] == ["https://drive.google.com/file/3"]
    got = [(r.url.removeprefix("https://blog.h"), r.kind) for r in docs.media_items(n, CONFIG).orderBy("idx").collect()]
    assert got == [("/m.mp4", "video_tag"), ("/p.png", "video_poster"), ("/m.webm", "video_tag"), ("/s.mp3", "audio_tag"), ("/clip.mov", "anchor_direct"), ("https://drive.google.com/file/3", "gdrive_audio")]


def test_meta_sections_links(spark):
    n = nodes(spark, PAGE, "", None, "plain")
    meta = docs.page_meta(n, CONFIG.categories).collect()
    assert [(m.title, m.category) for m in meta] == [("Head & line", "Event")]
    sec = [(r.heading, r.pos, r.total, r.url[-6:]) for r in docs.section_images(n).orderBy("section", "pos").collect()]
    assert ("Gallery", 0, 2, "g1.png") in sec and ("Gallery", 1, 2, "g2.png") in sec
    assert [r.text for r in docs.heading_texts(n).orderBy("ord").collect()] == ["Head & line", "OST list", "Bold", "Gallery"]
    assert docs.page_links(n).filter("url like '%#top'").count() == 0
    assert docs.has_forum_images(n, CONFIG).count() == 0


def test_tree_builder_repairs():
    root = parse("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>x<div>y</p></b>z</div><table><tr><td>1<td>2<tr><td>3</table>")
    lists = [n for n in elements(root, {"ul"})]
    assert [text_of(x) for x in lists[0].children if x.tag == "li"] == ["a", "bc", "d"]
    assert [[text_of(c) for c in r.children] for r in elements(root, {"tr"})] == [["1", "2"], ["3"]]
    assert text_of(parse("<script>if (a < b) '</p>'</script>t&amp;x<!-- c -->")) == "t&x"
    assert parse("<" * 50_000) and parse("<div>" * 900 + "x")
