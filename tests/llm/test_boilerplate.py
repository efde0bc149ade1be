from folioforge.functions.dom import parse
from folioforge.llm.boilerplate import INSIDE, Lexicon, lexicon, lines_of, host_sizes, main_text, page_furniture, read_page, template
from folioforge.llm.rendering import content_block, layout, read

MENU = "Home | News | Search"
FOOT = "© 2024 Studio. All rights reserved."


def article(n: int, style: str) -> str:
    text = [f"Headline number {n} of the day", "2024-01-0%d" % (n % 9 + 1), f"This is sentence {n} of the story, and it goes on for a while.", "Thank you."]
    if style == "dump":
        return "\n".join(["Home", "  News", "", "Search", *text[:3], "- 1/2 item", "Continue in the app", text[3], "Share this post", f"Another headline {n + 1} of the week", FOOT])
    body = "\n".join([f"<h1>{text[0]}</h1>", f"<p>{text[1]}</p>", f'<div class="b">{text[2]}</div>', '<div class="f">Continue in the app</div>' if n % 2 else "<p>Continue in the app</p>", f"<p>{text[3]}</p>"])
    return f'<!DOCTYPE html>\n<html><head><title>x</title><script>var a="</p>";</script></head><body>\n<nav>\n<p>{MENU}</p>\n<li><a href="/a">Home</a><li><a>News</a></li>\n</nav>\n<article>\n{body}\n</article>\n<footer>\n<div class="f">Share this post</div>\n<p>{FOOT}</p>\n</footer></body></html>'


def corpus(spark):
    rows = [(n, article(n, "html"), f"This is sentence {n} of the story") for n in range(40)]
    rows += [(100, article(50, "dump"), "Home News Search This is it."), (101, article(51, "dump"), None), (102, None, ""), (103, "", "© 2024 Studio. All rights reserved."), (100, article(50, "dump"), "Share this post")]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, html string, excerpt string, line_no string")


def test_furniture_of_pages_dumps_and_excerpts(spark):
    df = corpus(spark)
    got: dict = {}
    for r in page_furniture(df, "page_id", "html", "excerpt").collect():
        got.setdefault(r.page_id, []).append(r.line_no)
    lines = article(1, "html").split("\n")
    found = [lines[n - 1] for n in sorted(got[1])]
    assert MENU in found[0] and any("Share" in x for x in found) and any("Continue" in x for x in found) and any("©" in x for x in found)
    assert not any(w in x for x in found for w in ("Headline", "2024-01", "sentence", "Thank")) and 0 not in got[1]
    dump = article(51, "dump").split("\n")
    assert [dump[n - 1].strip() for n in sorted(got[101])] == ["Home", "News", "Search", "Continue in the app", "Share this post", "Another headline 52 of the week", FOOT]
    assert sorted(got[100])[:2] == [0, 0] and got[103] == [0] and 102 not in got


def test_main_text(spark):
    texts = {r.page_id: r.main_text for r in main_text(corpus(spark), "page_id", "html").collect()}
    assert texts[2] == "Headline number 2 of the day\n\n2024-01-03\n\nThis is sentence 2 of the story, and it goes on for a while.\n\nThank you."
    assert texts[102] is None and texts[103] == "" and "Share" not in texts[101]


def test_empty_table(spark):
    assert page_furniture(corpus(spark).limit(0), "page_id", "html", "excerpt").count() == 0


def rendered(page: str, keep=None) -> str:
    return layout(read(parse(page), steps=True).steps, keep)


def test_rendering_of_lists_tables_and_hidden_parts():
    page = "<body><p>a<p>b <b>c</b><ul><li>1<li>2<ol><li>x<li>y</ol></ul><div style='display:none'>no</div><p hidden>no</p><table><tr><td>aa<td>b<tr><td>c<td>dd</table><pre>e\n  f</pre></body>"
    assert rendered(page) == "a\n\nb c\n\n- 1\n- 2\n  1. x\n  2. y\n\naa  b\nc   dd\n\ne\n  f"
    assert sorted(read(parse("<p>a\nb</p>\n<script>\nx\n</script>\n<i>c</i>")).lines) == [1, 2, 6]


def test_preformatted_text_spans_and_numbers():
    assert rendered("<pre>a  b\n c <b>d</b>\n\ne</pre>") == "a  b\n c d\n\ne"
    assert rendered("<table><tr><th colspan=2>ab<th>z<tr><td>aaa<td>bbb<td>c</table>") == "ab        z\naaa  bbb  c"
    assert rendered("<ol start=9><li>a<li>b</ol>") == "9. a\n10. b"
    assert rendered("<table><tr><td><p>one<p>two<td>three</table>") == "one\n\ntwo\n\nthree"
    assert rendered("<p>a\nb</p>\n<p>c</p>", {2}) == "b"


def test_any_depth_of_nesting():
    page = "<html><body><div>menu</div>" + "<div>" * 5000 + "<h1>t</h1>\n<p>text</p>" + "<ul><li>" * 2000 + "deep"
    got = read_page(page, steps=True)
    assert got.texts == ["menut", "textdeep"]
    assert layout(got.steps).startswith("menu\n\nt\n\ntext\n\n") and layout(got.steps).endswith("- deep")


def test_content_is_the_block_of_the_headline():
    page = read_page("<html><body><div><p>menu</p></div>\n<div><header><h1>t</h1></header>\n<p>text</p></div></body></html>")
    assert [bool(m & INSIDE) for m in page.marks] == [False, True, True] and page.parted
    assert content_block(parse("<p>x</p>")) is None
    assert template("Show all 1,234 comments (5)") == "Show all 0 comments (0)"


def of(names) -> Lexicon:
    return Lexicon([0] * len(names), list(names), [True] * len(names), [False] * len(names))


def test_excerpt_rules():
    words = of(["Home", "News", "Search", "Copy link", "We use cookies. By staying you agree.", "リンクをコピー"])
    assert words.in_excerpt("Home · News · Search") and words.in_excerpt("News Home The story") and words.in_excerpt("The story… Copy link") and words.in_excerpt("話がある。リンクをコピー")
    assert words.in_excerpt("We use cookies. By staying you agree. Last winter it") and not words.in_excerpt("Search the home menu for News") and not words.in_excerpt("") and not words.in_excerpt("Copy link", "Copy link of")
    assert not words.in_excerpt("We use cookies. By staying you agree. Last winter it", "We use cookies. By staying you agree.")


def site(host: int, n: int, kind: str):
    foot = f"Imprint of site {host} by its owner. " * 8
    page = article(n, "html").replace(FOOT, foot).replace(MENU, f"Site{chr(97 + host % 26)}{host} | News | Search")
    text = page if kind == "html" else "\n".join([f"Headline number {n} of the day", "2024-01-05", f"A sentence of page {n} that goes on for a while.", foot])
    return (host * 10 + n, text, None, f"https://site{host}.example/{n}/")


def test_small_sites_have_their_own_lexicon_whatever_their_number(spark):
    sites = 1000
    rows = [site(h, n, "html" if n < 4 else "dump") for h in range(sites) for n in range(5)]
    df = spark.createDataFrame(rows, "page_id bigint, html string, excerpt string, url string").repartition(4)
    got = page_furniture(df, "page_id", "html", "excerpt", "url").filter("page_id % 10 = 4").collect()
    assert sorted((r.page_id, r.line_no) for r in got) == [(h * 10 + 4, 4) for h in range(sites)]


def test_parts_of_a_host_agree_with_the_whole(spark, monkeypatch):
    from folioforge.llm import boilerplate

    df = corpus(spark)
    whole = sorted(map(tuple, page_furniture(df, "page_id", "html", "excerpt").collect()))
    monkeypatch.setattr(boilerplate, "PART_SIZE", 2_000)
    assert sorted(map(tuple, page_furniture(df, "page_id", "html", "excerpt").collect())) == whole
    read_ = lines_of(df, "page_id", None, "html", "excerpt")
    sizes = host_sizes(read_)
    assert sizes.collect()[0]["parts"] > 3 and lexicon(read_, sizes).filter("furniture and name is not null").count() > 3
