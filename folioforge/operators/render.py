"""Documents written anew: localised HTML, Markdown, listing pages.

The URLs that a document uses are looked up by joins; what a document needs
comes to it as one map per row, so no lookup table is shipped to workers. Each
document is then parsed, changed and written in one pass.
"""

from __future__ import annotations

import html
import re
import urllib.parse
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.config import Config
from folioforge.functions.dom import BLOCK, RAW, VOID, Node, ancestors, classes, elements, parse, text_of
from folioforge.functions.names import url_join
from folioforge.functions.url import clean_url, path_of, percent_decoded
from folioforge.operators.documents import HEADINGS, content_of
from folioforge.operators.relations import paged

_CSS_URL = re.compile(r"(url\(\s*['\"]?)([^'\")]+)(['\"]?\s*\))")
_JSON_URL = re.compile(r'"url"\s*:\s*"([^"]+)"')
_INLINE = frozenset("strong b em i u s code".split())
#: recovered media go after a block whose text ends so; shorter context is none
LEAST_CONTEXT, LONGEST_CONTEXT = 20, 120


def set_attributes(node: Node, values: dict[str, str]) -> None:
    node.attrs = "".join(f' {k}="{html.escape(v, quote=True)}"' for k, v in values.items())


def serialized(node: Node) -> str:
    """HTML of a tree of any depth."""
    out: list[str] = []
    stack: list = [(None, iter(node.children))]
    while stack:
        tag, children = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if tag is not None:
                out.append(f"</{tag}>")
        elif not isinstance(child, Node):
            out.append(child[1])
        else:
            out.append(f"<{child.tag}{child.attrs.rstrip('/').rstrip()}>")
            if child.tag not in VOID:
                stack.append((child.tag, iter(child.children)))
    return "".join(out)


def _linked_data(node: Node, attributes: dict[str, str]) -> list[str]:
    """Addresses in a block of JSON-LD."""
    if node.tag != "script" or attributes.get("type", "").lower() != "application/ld+json":
        return []
    return [html.unescape(u).replace("\\/", "/") for c in node.children if not isinstance(c, Node) for u in _JSON_URL.findall(c[1])]


def remove(node: Node) -> None:
    node.parent.children = [c for c in node.parent.children if c is not node]


def references(documents: DataFrame, url: str, html_column: str) -> DataFrame:
    """(doc, ref, key) of the URLs that documents show or link to; key is the canonical absolute URL."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = set()
            for doc, text in zip(b["doc"], b["html"]):
                for node in elements(parse(text)) if text else ():
                    a = node.attributes() if node.attrs else {}
                    refs = [a.get(k, "") for k in ("src", "data-src", "poster", "href")]
                    if node.tag == "meta" and "image" in (a.get("property", "") or a.get("name", "")).lower() and not re.search(r"image:(width|height|alt|type)$", a.get("property", "")):
                        refs.append(a.get("content", ""))
                    css = a.get("style", "") + "".join(c[1] for c in node.children if not isinstance(c, Node) and node.tag == "style")
                    refs += [m.group(2) for m in _CSS_URL.finditer(css)] + _linked_data(node, a)
                    rows.update((doc, r.strip()) for r in refs if r.strip() and not r.strip().lower().startswith(("data:", "#", "mailto:", "javascript:")))
            yield pd.DataFrame(sorted(rows), columns=["doc", "ref"])

    found = documents.select(F.col(url).alias("doc"), F.col(html_column).alias("html")).mapInPandas(find, "doc string, ref string")
    found = found.withColumn("key", clean_url(url_join(F.col("doc"), F.col("ref"))))
    return found.withColumn("slug", first_segment(F.col("key")))


def first_segment(url: Column) -> Column:
    """The first segment of a URL's path, percent-decoded; '' if there is none."""
    return percent_decoded(F.regexp_extract(path_of(url), r"^/*([^/?#]*)", 1))


def lookups(refs: DataFrame, tables: list[tuple[str, DataFrame, str, str, str]]) -> DataFrame:
    """doc and, per table (name, rows, column of the reference, key, value), a map from a document's own references to values; of several the least."""
    out = None
    for name, rows, by, key, value in tables:
        known = refs.join(rows.groupBy(F.col(key).alias(by)).agg(F.min(value).alias("value")).filter(f"value is not null and {by} <> ''"), by)
        per = known.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("ref", "value"))).alias(name))
        out = per if out is None else out.join(per, "doc", "full_outer")
    return out


def _first_segment(url: str) -> str:
    return next((s for s in urllib.parse.urlsplit(url).path.split("/") if s), "")


class Localiser:
    """Changes of one document, in a fixed order: styles, images, page images, backgrounds, media, links to files, recovered media, links to pages, players, scripts."""

    def __init__(self, document: str, url: str, category: str, config: Config, images: dict, media: dict, pages: dict, recovered: list, assets: dict | None = None):
        self.assets = assets or {}
        self.root, self.url, self.category, self.config = parse(document), url, category, config
        self.images, self.media, self.pages, self.recovered = images, media, pages, recovered
        self.up = "../../" if category else "../"
        self.unmapped: set[str] = set()

    def _image(self, ref: str) -> tuple[str, bool]:
        ref = ref.strip()
        if not ref or ref.startswith("data:"):
            return ref, False
        if ref in self.images:
            return self.up + self.images[ref], True
        absolute = urllib.parse.urljoin(self.url, ref)
        if absolute.startswith("http"):
            self.unmapped.add(absolute)
        return absolute, False

    def _file(self, path: str) -> str:
        return path if path.startswith(("http://", "https://")) else self.up + path

    def run(self) -> str:
        for node in list(elements(self.root)):
            a = node.attributes() if node.attrs else {}
            before = dict(a)
            if node.tag == "img":
                source = a.get("src") or a.get("data-src") or ""
                a["src"], mapped = self._image(source)
                a.pop("data-src", None)
                if mapped:
                    a.pop("srcset", None)
            elif node.tag == "meta" and a.get("content") and "image" in (a.get("property", "") or a.get("name", "")).lower() and not re.search(r"image:(width|height|alt|type)$", a.get("property", "")):
                new, mapped = self._image(a["content"])
                a["content"] = new if mapped else a["content"]
            elif node.tag == "link" and "stylesheet" in a.get("rel", "").lower().split():
                if a.get("href", "").strip() in self.assets:
                    a["href"] = f"{self.up}assets/{self.assets[a['href'].strip()]}"
            elif node.tag == "script":
                # the block goes with all scripts, but what it names and nothing has is told
                for ref in _linked_data(node, a):
                    self._image(ref)
            elif node.tag == "link" and a.get("rel") == "icon":
                new, mapped = self._image(a.get("href", ""))
                a["href"] = new if mapped else a.get("href", "")
            elif node.tag in ("video", "audio") or node.tag == "source" and any(x.tag in ("video", "audio") for x in ancestors(node)):
                if a.get("src", "").strip() in self.media:
                    a["src"] = self._file(self.media[a["src"].strip()])
                poster = a.get("poster", "").strip()
                if poster:
                    if poster in self.images:
                        a["poster"] = self.up + self.images[poster]
                    elif poster in self.media:
                        a["poster"] = self._file(self.media[poster])
                    else:
                        del a["poster"]
            elif node.tag == "a" and a.get("href"):
                logo = self.config.home_logo_class in a.get("class", "").split()
                a["href"] = ("../" if self.category else "") + "index.html" if logo else self._link(a["href"].strip())
            elif node.tag == "iframe" and re.search(r"youtube(-nocookie)?\.com/embed|player\.vimeo\.com", a.get("src", "")):
                a["style"] = "width:100%;aspect-ratio:16/9;height:auto"
            if "style" in a and node.tag != "iframe":
                a["style"] = self._css(a["style"])
            if node.tag == "style":
                node.children = [c if isinstance(c, Node) else (c[0], self._css(c[1])) for c in node.children]
            if a != before:
                set_attributes(node, a)
        self._insert_recovered()
        for node in list(elements(self.root, {"script"})):
            remove(node)
        return serialized(self.root)

    def _css(self, text: str) -> str:
        return _CSS_URL.sub(lambda m: m.group(0) if m.group(2).startswith("data:") else m.group(1) + self._image(m.group(2))[0] + m.group(3), text)

    def _link(self, href: str) -> str:
        if href in self.images:
            return self.up + self.images[href]
        if href in self.media:
            return self._file(self.media[href])
        if href.startswith(("#", "mailto:", "javascript:")):
            return href
        absolute = urllib.parse.urljoin(self.url, href)
        parts = urllib.parse.urlsplit(absolute)
        if (parts.hostname or "") != self.config.blog_host:
            return href
        first = _first_segment(absolute)
        home = "../" if self.category else ""
        if not first:
            return home + "index.html"
        if first == "tag":
            tags = [s for s in parts.path.split("/") if s]
            if len(tags) > 1 and tags[1] in self.config.tag_categories:
                return home + f"{self.config.tag_categories[tags[1]]}/index.html"
            return home + f"{tags[1]}.html" if len(tags) > 1 else absolute
        if first in self.config.excluded_paths:
            return absolute
        target = self.pages.get(href)
        return home + target if target else absolute

    def _insert_recovered(self) -> None:
        content = content_of(self.root)
        rest = []
        for path, anchor_type, anchor_text in self.recovered:
            tag = "audio" if path.lower().endswith(self.config.audio_exts) else "video"
            figure = Node("figure", ' class="recovered-media"', content, 0)
            player = Node(tag, "", figure, 0)
            set_attributes(player, {"src": self._file(path), "controls": ""})
            figure.children.append(player)
            block = None
            if anchor_type == "positioned" and anchor_text:
                wanted = normal_text(anchor_text)
                block = next((n for n in elements(content, BLOCK - {"div", "section", "article", "main", "ul", "ol", "table"}) if wanted in normal_text(text_of(n))), None)
            if block is None:
                rest.append(figure)
            else:
                at = next(i for i, c in enumerate(block.parent.children) if c is block)
                figure.parent = block.parent
                block.parent.children.insert(at + 1, figure)
        if rest:
            section = Node("section", ' class="recovered-media-list"', content, 0)
            section.children = rest
            content.children.append(section)


def normal_text(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def localised(documents: DataFrame, url: str, html_column: str, category: str, images: DataFrame, media: DataFrame, pages: DataFrame, recovered: DataFrame, config: Config, assets: DataFrame | None = None) -> DataFrame:
    """url, html as it reads offline, and unmapped: canonical URLs of images without a local path, sorted.

    images: clean_url, relative_path. media: media_url, relative_path. pages:
    page_url, path; a link is to a page if its first segment is the page's,
    however it is spelled otherwise. recovered: post_url, relative_path,
    anchor_type, anchor_text. assets: url, file of stylesheets. A null or empty document stays as it is.
    """
    refs = references(documents, url, html_column)
    if assets is None:
        assets = documents.sparkSession.createDataFrame([], "url string, file string")
    maps = lookups(
        refs,
        [
            ("images", images, "key", "clean_url", "relative_path"),
            ("media", media.withColumn("__k", clean_url(F.col("media_url"))), "key", "__k", "relative_path"),
            ("pages", pages.withColumn("__k", first_segment(F.col("page_url"))), "slug", "__k", "path"),
            ("assets", assets.withColumn("__k", clean_url(F.col("url"))), "key", "__k", "file"),
        ],
    )
    extra = recovered.groupBy(F.col("post_url").alias("doc")).agg(F.array_sort(F.collect_list(F.struct("relative_path", "anchor_type", "anchor_text"))).alias("recovered"))
    rows = documents.select(F.col(url).alias("doc"), F.col(html_column).alias("html"), F.coalesce(F.col(category), F.lit("")).alias("category"))
    rows = rows.join(maps, "doc", "left").join(extra, "doc", "left")

    def change(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        as_dict = lambda m: dict(m) if m is not None and not isinstance(m, float) else {}
        for b in batches:
            pages_out, missing = [], []
            for r in b.itertuples(index=False):
                if not r.html:
                    pages_out.append(r.html)
                    missing.append([])
                    continue
                found = [] if r.recovered is None or isinstance(r.recovered, float) else [(x["relative_path"], x["anchor_type"], x["anchor_text"]) for x in r.recovered]
                one = Localiser(r.html, r.doc, r.category, config, as_dict(r.images), as_dict(r.media), as_dict(r.pages), found, as_dict(r.assets))
                pages_out.append(one.run())
                missing.append(sorted(one.unmapped))
            yield pd.DataFrame({"doc": b["doc"], "html": pages_out, "unmapped": missing})

    out = rows.mapInPandas(change, "doc string, html string, unmapped array<string>")
    return out.select(F.col("doc").alias(url), F.col("html").alias(html_column), F.array_sort(F.array_distinct(F.transform("unmapped", clean_url))).alias("unmapped"))


def to_markdown(node: Node, base: str, images: dict[str, str], prefix: str) -> str:
    """Markdown of a tree: headings, lists, quotes, code, emphasis, links, images, tables."""

    def inline(at: Node, around: frozenset[str] = frozenset()) -> str:
        out = []
        for child in at.children:
            if not isinstance(child, Node):
                out.append(re.sub(r"\s+", " ", html.unescape(child[1])))
            elif child.tag == "br":
                out.append("  \n")
            elif child.tag == "img":
                a = child.attributes()
                source = a.get("src") or a.get("data-src") or ""
                out.append(f"![{a.get('alt', '')}]({prefix + images[source.strip()] if source.strip() in images else urllib.parse.urljoin(base, source)})" if source else "")
            elif child.tag == "a":
                href = child.attributes().get("href", "").strip()
                text = inline(child, around)
                target = prefix + images[href] if href in images else href if href.startswith(("#", "mailto:", "javascript:")) else urllib.parse.urljoin(base, href)
                out.append(f"[{text.strip()}]({target})" if href else text)
            elif child.tag in _INLINE and child.tag not in around:
                text = inline(child, around | {child.tag})
                mark = {"strong": "**", "b": "**", "em": "*", "i": "*", "code": "`", "s": "~~"}.get(child.tag, "")
                out.append(f"{mark}{text.strip()}{mark}" if text.strip() else text)
            elif child.tag not in RAW:
                out.append(inline(child, around))
        return "".join(out)

    blocks: list[str] = []

    def block(at: Node, indent: str = "") -> None:
        loose: list = []

        def flush() -> None:
            holder = Node("p", "", None, 0)
            holder.children = list(loose)
            loose.clear()
            text = inline(holder).strip()
            if text:
                blocks.append(indent + text)

        for child in at.children:
            if not isinstance(child, Node) or child.tag not in BLOCK:
                if not (isinstance(child, Node) and child.tag in RAW):
                    loose.append(child)
                continue
            flush()
            if child.tag in HEADINGS:
                text = inline(child).strip()
                if text:
                    blocks.append(f"{'#' * int(child.tag[1])} {text}")
            elif child.tag in ("ul", "ol"):
                items = [c for c in child.children if isinstance(c, Node) and c.tag == "li"]
                blocks.append("\n".join(f"{indent}{f'{n}.' if child.tag == 'ol' else '-'} {inline(c).strip()}" for n, c in enumerate(items, 1)))
            elif child.tag == "blockquote":
                blocks.append("\n".join(f"> {line}" for line in inline(child).strip().split("\n")))
            elif child.tag == "pre":
                blocks.append("```\n" + text_of(child) + "\n```")
            elif child.tag == "hr":
                blocks.append("---")
            elif child.tag == "table":
                rows = [[inline(c).strip() for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in elements(child, {"tr"})]
                if rows:
                    lines = ["| " + " | ".join(r) + " |" for r in rows]
                    blocks.append("\n".join([lines[0], "|" + " --- |" * len(rows[0]), *lines[1:]]))
            else:
                block(child, indent)
        flush()

    block(node)
    return "\n\n".join(b for b in blocks if b.strip())


def markdown(documents: DataFrame, url: str, html_column: str, title: str, date: str, category: str, images: DataFrame) -> DataFrame:
    """url, text: a head with title, date, category and source, and the content in Markdown, without author cards, share bars, navigation and comments."""
    refs = references(documents, url, html_column)
    maps = lookups(refs, [("images", images, "key", "clean_url", "relative_path")])
    rows = documents.select(F.col(url).alias("doc"), F.col(html_column).alias("html"), *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((title, "title"), (date, "date"), (category, "category"))]).join(maps, "doc", "left")

    def change(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = []
            for r in b.itertuples(index=False):
                root = parse(r.html or "")
                content = content_of(root)
                for node in list(elements(content)):
                    if {"author-card", "share", "comments", "post-share"} & set(classes(node)) or node.tag == "nav" or node.tag == "h1" and text_of(node) == r.title.strip():
                        remove(node)
                own = dict(r.images) if r.images is not None and not isinstance(r.images, float) else {}
                head = [f"# {r.title}", "", *[f"- {k}: {v}" for k, v in (("date", r.date), ("category", r.category), ("source", r.doc)) if v], "", "---", ""]
                texts.append("\n".join(head) + "\n" + to_markdown(content, r.doc, own, "../" if r.category else "") + "\n")
            yield pd.DataFrame({"doc": b["doc"], "text": texts})

    return rows.mapInPandas(change, "doc string, text string").withColumnRenamed("doc", url)


def post_card(title, link, image, date, category):  # noqa: ANN001, ANN201  columns in, column out
    """HTML of a post on a listing page."""
    safe = lambda c: F.replace(F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    picture = F.when(F.coalesce(image, F.lit("")) != "", F.concat(F.lit('<img src="'), safe(image), F.lit('" alt="">'))).otherwise("")
    return F.concat(F.lit('<article class="post-card"><a href="'), safe(link), F.lit('">'), picture, F.lit("<h2>"), safe(title), F.lit("</h2></a><time>"), safe(date), F.lit("</time><span>"), safe(category), F.lit("</span></article>"))


def listing(posts: DataFrame, template: str, per_page: int = 500) -> DataFrame:
    """category, page_no, page: pages of a category, and '' for all, with `per_page` posts, newest first, in place of {posts}, the category's number of posts for {count}.

    posts: title, link, image, date, category.
    """
    cards = posts.select("category", "date", "link", post_card(F.col("title"), F.col("link"), F.col("image"), F.col("date"), F.col("category")).alias("card"))
    both = cards.filter("category <> ''").unionByName(cards.withColumn("category", F.lit("")))
    placed = paged(both, "category", [F.desc("date"), F.col("link")], per_page)
    size = placed.groupBy("category").agg(F.count("*").cast("string").alias("n"))
    grouped = placed.groupBy("category", "page_no").agg(F.array_sort(F.collect_list(F.struct("place", "card"))).alias("c")).join(size, "category")
    page = F.replace(F.replace(F.lit(template), F.lit("{posts}"), F.array_join(F.transform("c", lambda x: x.card), "\n")), F.lit("{count}"), F.col("n"))
    return grouped.select("category", "page_no", page.alias("page"))


def listing_template(document: str) -> str | None:
    """A saved listing page as a template for `listing`: its feed emptied, links to further pages dropped; None without a feed."""
    root = parse(document)
    feed = next((n for n in elements(root, {"div"}) if "post-feed" in classes(n)), None)
    if feed is None:
        return None
    feed.children = [(0, "{posts}")]
    for node in list(elements(root, {"link", "nav"})):
        if node.attributes().get("rel") in ("next", "prev") or "pagination" in classes(node):
            remove(node)
    return serialized(root)


@F.pandas_udf(T.StringType())
def absolute_css(text: pd.Series, base: pd.Series) -> pd.Series:
    """Stylesheets with the references in url() made absolute; data and absolute ones stay."""

    def one(css: str, at: str) -> str:
        return _CSS_URL.sub(lambda m: m.group(0) if m.group(2).startswith(("data:", "http://", "https://", "#")) else m.group(1) + urllib.parse.urljoin(at, m.group(2)) + m.group(3), css)

    return pd.Series([None if c is None else one(c, a or "") for c, a in zip(text, base)])
