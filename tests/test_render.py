from folioforge.config import Config
from folioforge.operators import render
from folioforge.plans.pipeline import Stages

CONFIG = Config(blog_host="blog.h", image_hosts=("blog.h",), cdn_hosts=("cdn.h",))
PAGE = """<html><head><link rel="icon" href="/i.ico"><meta property="og:image" content="/content/images/a.png"><meta property="og:image:width" content="1200">
<style>.x{background:url('/content/images/bg.png')}</style><script>alert(1)</script></head><body><article><h1>T</h1>
<img src="/content/images/a.png" srcset="x 2x" data-src="y"><img src="/content/images/none.png"><p style="background:url(data:abc)">Enough words here to be context.</p>
<video src="/m.mp4" poster="/p.png"></video><a href="/other/">o</a><a href="/tag/news/">t</a><a href="/rss/">r</a><a href="/">home</a><a href="/unknown/">u</a><a href="https://x/">x</a>
<iframe src="https://www.youtube.com/embed/1"></iframe></article></body></html>"""


def test_localised(spark):
    post = "https://blog.h/p/"
    docs = spark.createDataFrame([(post, PAGE, "News"), ("https://blog.h/e/", "", ""), ("https://blog.h/n/", None, None)], "url string, html string, category string")
    images = spark.createDataFrame([("https://blog.h/content/images/a.png", "images/a.png"), ("https://blog.h/content/images/bg.png", "images/bg.png")], "clean_url string, relative_path string")
    media = spark.createDataFrame([("https://blog.h/m.mp4", "media/m.mp4")], "media_url string, relative_path string")
    pages = spark.createDataFrame([("https://blog.h/other", "News/other.html")], "page_url string, path string")
    recovered = spark.createDataFrame([(post, "media/r.mp4", "positioned", "Enough   words here"), (post, "media/s.mp3", "append", "")], "post_url string, relative_path string, anchor_type string, anchor_text string")
    out = {r.url: r for r in render.localised(docs, "url", "html", "category", images, media, pages, recovered, CONFIG).collect()}
    h = out[post].html
    assert '<img src="../../images/a.png">' in h and 'content="../../images/a.png"' in h and "url('../../images/bg.png')" in h
    assert "<script" not in h and 'content="1200"' in h and "url(data:abc)" in h and "poster" not in h and 'src="../../media/m.mp4"' in h
    for want in ('href="../News/other.html"', 'href="../news.html"', 'href="https://blog.h/rss/"', 'href="../index.html"', 'href="https://blog.h/unknown/"', 'href="https://x/"', "aspect-ratio"):
        assert want in h, want
    assert h.index("context.</p><figure") and "<audio" in h[h.index("recovered-media-list") :]
    assert out[post].unmapped == ["https://blog.h/content/images/none.png", "https://blog.h/i.ico"]
    assert out["https://blog.h/e/"].html == "" and out["https://blog.h/n/"].html is None


def test_markdown(spark):
    page = '<article><h1>T</h1><h2>A &amp; b</h2><p>x <strong><strong>y</strong></strong> <a href="/l">l</a></p><ul><li>1<li>2</ul><blockquote>q</blockquote><table><tr><th>a<th>b<tr><td>1<td>2</table><img src="/i.png" alt="i"><nav>n</nav></article>'
    docs = spark.createDataFrame([("https://blog.h/p/", page, "T", "2024-01-02", "News")], "url string, html string, title string, date string, category string")
    images = spark.createDataFrame([("https://blog.h/i.png", "images/i.png")], "clean_url string, relative_path string")
    text = render.markdown(docs, "url", "html", "title", "date", "category", images).first().text
    assert text.startswith("# T\n\n- date: 2024-01-02\n- category: News\n- source: https://blog.h/p/\n\n---\n")
    for want in ("## A & b", "x **y** [l](https://blog.h/l)", "- 1\n- 2", "> q", "| a | b |\n| --- | --- |\n| 1 | 2 |", "![i](../images/i.png)"):
        assert want in text, want
    assert text.count("# T") == 1 and "\nn\n" not in text


def test_listing(spark):
    posts = spark.createDataFrame([("a<b", "l1", None, "2024-01-01", "N"), ("c", "l2", "i.png", "2024-02-01", "N"), ("d", "l3", None, "2024-03-01", "")], "title string, link string, image string, date string, category string")
    pages = {r.category: r.page for r in render.listing(posts, "{count}\n{posts}").collect()}
    assert pages[""].startswith("3\n") and pages["N"].index("l2") < pages["N"].index("l1") and "a&lt;b" in pages["N"]


def test_pipeline(spark):
    posts = spark.createDataFrame([("https://blog.h/p/", "2024-05-06", ""), ("https://blog.h/q/", "", ""), ("https://blog.h/r/", "", "")], "url string, lastmod string, published_time string")
    fetch = lambda u, c, t: (u, 200, u, t, "", c)
    fetches = spark.createDataFrame(
        [fetch("https://blog.h/p/", PAGE.encode(), "text/html"), fetch("https://blog.h/q/", b"x", "application/pdf"), fetch("https://blog.h/content/images/a.png", b"A", "image/png"), fetch("https://blog.h/content/images/none.png", b"A", "image/png"), fetch("https://blog.h/m.mp4", b"M", "video/mp4")],
        "url string, status int, final_url string, content_type string, content_disposition string, content binary",
    )
    t = Stages(posts, fetches, CONFIG).run()
    assert sorted((r.post_url, r.reason) for r in t["failed_html"].collect()) == [("https://blog.h/q/", "unexpected_content_type:application/pdf"), ("https://blog.h/r/", "fetch_failed")]
    assert {r.clean_url: r.relative_path for r in t["image_map"].collect()} == {"https://blog.h/content/images/a.png": "images/etc/2024/05/a.png", "https://blog.h/content/images/none.png": "images/etc/2024/05/a.png"}
    assert [r.relative_path for r in t["media_map"].collect()] == ["media/m.mp4"]
    assert "../images/etc/2024/05/a.png" in t["html_local"].first().html and "# T" in t["markdown"].first().text
    assert t["listings"].count() == 1 and t["image_metrics"].first().ok == 2
    done = spark.createDataFrame([("html", "https://blog.h/p/")], "stage string, post_url string")
    assert Stages(posts, fetches, CONFIG, done=done).run(("html",))["pages"].count() == 0
    assert Stages(posts, fetches, CONFIG, done=done, force=True).run(("html",))["pages"].count() == 1
