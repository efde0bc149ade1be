"""Tables from HTML documents.

One pass over each document in Arrow batches gives a node table: a row per
element that matters, with its order, attributes and the context that needs the
tree. Which of them are images, media, links or sections is then said in column
expressions, so rules stay in generated code and documents are parsed once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.config import Config
from folioforge.functions.dom import Node, ancestors, classes, elements, parse, text_of
from folioforge.functions.names import suffix, url_join
from folioforge.functions.url import clean_url, host_of, is_drive_host, path_of

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_WANTED = frozenset({"meta", "title", "img", "a", "video", "audio", "source", "iframe", "strong", *HEADINGS})
#: text of a sibling longer than this ends the look back
SIBLING_BARRIER = 200

NODES = "doc string, ord int, tag string, attrs map<string,string>, text string, inside boolean, card boolean, carrier string, carrier_ord int, before string, heading string, section int"


_CONTENT_CLASS = re.compile("post-content|article-body|gh-content", re.I)


def content_of(root: Node) -> Node:
    """Container of a document's content: a section or else a div by class, else article, main, body, or the document."""
    first: dict[str, Node] = {}
    for node in elements(root, {"section", "div", "article", "main", "body"}):
        if node.tag in ("section", "div"):
            if "class" in node.attrs and node.tag not in first and any(map(_CONTENT_CLASS.search, classes(node))):
                first[node.tag] = node
        else:
            first.setdefault(node.tag, node)
    return next((first[t] for t in ("section", "div", "article", "main", "body") if t in first), root)


def _before(node: Node) -> str:
    """Text of the siblings before a node, nearest first, up to and with the first long one."""
    pieces: list[str] = []
    siblings = node.parent.children
    at = next(i for i, c in enumerate(siblings) if c is node)
    for other in reversed(siblings[:at]):
        piece = (text_of(other) if isinstance(other, Node) else other[1].strip()).lower()
        pieces.append(piece)
        if len(piece) > SIBLING_BARRIER:
            break
    return "\n".join(pieces)


def _nodes(document: str):
    root = parse(document)
    content = content_of(root)
    inner = {id(n) for n in elements(content)} | {id(content)}
    section, heading = 0, ""
    orders: dict[int, int] = {}
    for ord_, node in enumerate(elements(root, _WANTED), 1):
        orders[id(node)] = ord_
        inside = id(node) in inner
        if node.tag in HEADINGS and inside:
            section += 1
            heading = text_of(node)
        around = list(ancestors(node))
        carrier = next((a for a in around if a.tag in ("video", "audio", "picture", *HEADINGS)), None)
        yield (
            ord_,
            node.tag,
            node.attributes(),
            text_of(node),
            inside,
            any(a.tag == "div" and "author-card" in classes(a) for a in around),
            carrier.tag if carrier is not None else None,
            orders.get(id(carrier)) if carrier is not None else None,
            _before(node) if node.tag == "a" else None,
            heading if inside else "",
            section if inside else 0,
        )


def node_table(documents: DataFrame, url: str, html: str) -> DataFrame:
    """Rows (doc, ord, tag, attrs, text, ...) of the elements of documents that matter.

    inside: within the content container. card: within an author card. carrier:
    nearest video, audio, picture or heading around. before: text before an
    anchor. heading, section: the heading that the element stands under and its
    number, in document order. Null and empty documents have no rows; repeated
    ones have theirs each. Elements without end tag, stray end tags and raw text
    in scripts are dealt with by the tree builder.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in NODES.split(", ")]
        for b in batches:
            rows = [(doc, *n) for doc, text in zip(b["doc"], b["html"]) if text for n in _nodes(text)]
            yield pd.DataFrame(rows, columns=names).astype({"carrier_ord": "Int32"})

    return documents.select(F.col(url).alias("doc"), F.col(html).alias("html")).mapInPandas(read, NODES)


def _attr(name: str) -> Column:
    return F.coalesce(F.col("attrs")[name], F.lit(""))


def _has_class(name: str) -> Column:
    return F.array_contains(F.split(_attr("class"), r"\s+"), name)


def _absolute(ref: Column) -> Column:
    return url_join(F.col("doc"), F.trim(ref))


def first_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The first row by `ord` of each key."""
    best = F.min_by(F.struct(*rows.columns), F.col("ord"))
    return rows.groupBy(*keys).agg(best.alias("__first")).select("__first.*")


def page_meta(nodes: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """A row per document: title, og_image, published, description and category, its first tag if that is a known one."""
    meta = lambda key: F.min_by(F.when((F.col("tag") == "meta") & (F.coalesce(F.nullif(_attr("property"), F.lit("")), _attr("name")) == key), F.trim(_attr("content"))), F.when((F.col("tag") == "meta") & (F.coalesce(F.nullif(_attr("property"), F.lit("")), _attr("name")) == key), F.col("ord")))
    first_text = lambda tag: F.min_by(F.when(F.col("tag") == tag, F.col("text")), F.when(F.col("tag") == tag, F.col("ord")))
    titled = (F.col("tag") == "h1") & F.contains(F.lower(_attr("class")), F.lit("post-title"))
    headline = F.min_by(F.when(titled, F.col("text")), F.when(titled, F.col("ord")))
    found = nodes.groupBy("doc").agg(
        meta("og:title").alias("og_title"), headline.alias("headline"), first_text("h1").alias("h1"), first_text("title").alias("html_title"), meta("og:image").alias("og_image"),
        meta("article:published_time").alias("published"), meta("og:description").alias("description"), meta("article:tag").alias("first_tag"),
    )
    named = lambda c: F.nullif(F.col(c), F.lit(""))
    return found.select("doc", F.coalesce(named("headline"), named("h1"), named("og_title"), named("html_title"), F.lit("")).alias("title"), "og_image", "published", "description", F.when(F.col("first_tag").isin(*categories), F.col("first_tag")).otherwise("").alias("category"))


def first_tags(nodes: DataFrame) -> DataFrame:
    """The first tag of each document that has one: (doc, tag)."""
    tags = nodes.filter((F.col("tag") == "meta") & (_attr("property") == "article:tag") & (F.trim(_attr("content")) != ""))
    return tags.groupBy("doc").agg(F.min_by(F.trim(_attr("content")), "ord").alias("tag"))


def image_items(nodes: DataFrame, config: Config) -> DataFrame:
    """Images that a document offers: (doc, idx, url, kind), the page's own image first, then shown images, then links.

    Shown images count by host and path; links by drive host, extension, and
    words or a resolution in their text. Of equal URLs the first counts, the
    page's own image apart. idx counts from 1 in that order.
    """
    own = nodes.filter((F.col("tag") == "meta") & (_attr("property") == "og:image") & (_attr("content") != ""))
    own = first_of(own, ["doc"]).select("doc", F.lit(0).alias("step"), "ord", _attr("content").alias("url"), F.lit("og_image").alias("kind"))
    content = nodes.filter(F.col("inside") & ~F.col("card"))
    shown = content.filter((F.col("tag") == "img") & ~_has_class("author-profile-image") & ~_has_class("kg-bookmark-icon"))
    shown = shown.select("doc", "ord", _absolute(F.coalesce(F.nullif(_attr("src"), F.lit("")), _attr("data-src"))).alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    kind = (
        F.when(is_drive_host(host, config.drive_hosts, config.drive_suffix), "gdrive")
        .when(F.contains(path, F.lit("/content/images/")) & host.isin(*config.image_hosts), "img")
        .when(host.isin(*config.cdn_hosts) & suffix(path).isin(*config.image_exts), "img")
    )
    shown = shown.select("doc", F.lit(1).alias("step"), "ord", "url", kind.alias("kind"))
    anchors = content.filter((F.col("tag") == "a") & (_attr("href") != "") & ~F.trim(_attr("href")).rlike(r"^(#|mailto:)")).select("doc", "ord", _absolute(_attr("href")).alias("url"), F.lower("text").alias("text"))
    drive = is_drive_host(host, config.drive_hosts, config.drive_suffix)
    worded = F.lit(False)
    for word in config.download_keywords:
        worded = worded | F.contains("text", F.lit(word))
    kind = (
        F.when(drive, F.when(~F.lower(path).rlike("/spreadsheets/|/forms/"), "gdrive"))
        .when(host.isin(*config.skip_link_hosts), None)
        .when(suffix(path).isin(*config.image_exts, *config.archive_exts), "linked_direct")
        .when(worded | F.col("text").rlike(r"\d+\s*[xX×]\s*\d+"), "linked_keyword")
    )
    linked = anchors.select("doc", F.lit(2).alias("step"), "ord", "url", kind.alias("kind"))
    items = own.unionByName(shown).unionByName(linked).filter(F.col("kind").isNotNull() & F.startswith("url", F.lit("http")))
    items = items.withColumns({"url": clean_url(F.col("url")), "scope": F.when(F.col("kind") == "og_image", "thumb").otherwise("main")})
    first = items.groupBy("doc", "scope", "url").agg(F.min_by("kind", F.struct("step", "ord")).alias("kind"), F.min(F.struct("step", "ord")).alias("at"))
    return first.select("doc", F.row_number().over(W.partitionBy("doc").orderBy("at")).alias("idx"), "url", "kind")


def non_image_urls(nodes: DataFrame, config: Config) -> DataFrame:
    """Drive links that lead to sound by their text, the text before them or the heading above: (doc, ord, url)."""
    anchors = nodes.filter(F.col("inside") & (F.col("tag") == "a") & (_attr("href") != "") & ~F.trim(_attr("href")).rlike(r"^(#|mailto:)"))
    anchors = anchors.select("doc", "ord", _absolute(_attr("href")).alias("url"), F.lower("text").alias("text"), "before", F.lower("heading").alias("heading"))
    words = F.lit(False)
    for column in ("text", "before", "heading"):
        for word in config.non_image_keywords:
            words = words | F.contains(F.coalesce(F.col(column), F.lit("")), F.lit(word))
    drive = anchors.filter(is_drive_host(host_of(F.col("url")), config.drive_hosts, config.drive_suffix) & words)
    return first_of(drive.select("doc", "ord", clean_url(F.col("url")).alias("url")), ["doc", "url"])


def media_items(nodes: DataFrame, config: Config) -> DataFrame:
    """Media of a document: (doc, idx, url, kind), players first, then linked files, then sound on a drive."""
    content = nodes.filter("inside")
    players = content.filter(F.col("tag").isin("video", "audio"))
    main = players.select("doc", F.lit(0).alias("step"), F.col("ord").alias("ord"), F.lit(0).alias("part"), _attr("src").alias("ref"), F.concat("tag", F.lit("_tag")).alias("kind"))
    poster = players.filter(F.col("tag") == "video").select("doc", F.lit(0).alias("step"), "ord", F.lit(1).alias("part"), _attr("poster").alias("ref"), F.lit("video_poster").alias("kind"))
    sources = content.filter((F.col("tag") == "source") & (F.coalesce("carrier", F.lit("")) != "picture"))
    held = F.col("carrier").isin("video", "audio")
    nested = sources.select(
        "doc", F.when(held, 0).otherwise(1).alias("step"), F.when(held, F.col("carrier_ord")).otherwise(F.col("ord")).alias("ord"), (F.col("ord") + 2).alias("part"), _attr("src").alias("ref"), F.when(F.col("carrier") == "audio", "audio_tag").otherwise("video_tag").alias("kind")
    )
    anchors = content.filter((F.col("tag") == "a") & ~F.col("card") & (_attr("href") != "") & ~F.trim(_attr("href")).rlike(r"^(#|mailto:)")).select("doc", F.lit(2).alias("step"), "ord", F.lit(0).alias("part"), _attr("href").alias("ref"), F.lit("anchor_direct").alias("kind"))
    refs = main.unionByName(poster).unionByName(nested).unionByName(anchors).filter("ref <> ''").withColumn("url", _absolute(F.col("ref"))).drop("ref")
    refs = refs.filter((F.col("kind") != "anchor_direct") | suffix(path_of(F.col("url"))).isin(*config.video_exts, *config.audio_exts))
    sound = non_image_urls(nodes, config).select("doc", F.lit(3).alias("step"), "ord", F.lit(0).alias("part"), F.lit("gdrive_audio").alias("kind"), "url")
    items = refs.unionByName(sound).filter(F.startswith("url", F.lit("http")) & ~host_of(F.col("url")).isin(*[h.removeprefix("www.") for h in config.embed_hosts]))
    if config.remote_rewrites:
        items = items.filter(~clean_url(F.col("url")).isin(*sorted(config.remote_rewrites)))
    at = F.struct("step", "ord", "part")
    first = items.groupBy("doc", "kind", clean_url(F.col("url")).alias("key")).agg(F.min_by("url", at).alias("url"), F.min(at).alias("at"))
    return first.select("doc", F.row_number().over(W.partitionBy("doc").orderBy("at", "kind", "key")).alias("idx"), "url", "kind")


def section_images(nodes: DataFrame) -> DataFrame:
    """Images under each heading: (doc, section, heading, pos from 0, total, url)."""
    images = nodes.filter(F.col("inside") & ~F.col("card") & (F.col("tag") == "img") & ~_has_class("author-profile-image") & (F.col("section") > 0))
    images = images.select("doc", "section", "heading", "ord", F.coalesce(F.nullif(_attr("src"), F.lit("")), _attr("data-src")).alias("ref")).filter("ref <> '' and heading <> ''")
    images = images.withColumn("url", clean_url(_absolute(F.col("ref"))))
    under = W.partitionBy("doc", "section")
    return images.select("doc", "section", "heading", (F.row_number().over(under.orderBy("ord")) - 1).alias("pos"), F.count("*").over(under).cast("int").alias("total"), "url")


def heading_texts(nodes: DataFrame) -> DataFrame:
    """Distinct texts of headings and of strong text outside of headings: (doc, ord, text), each where it first stands."""
    found = nodes.filter(F.col("inside") & (F.col("text") != "") & (F.col("tag").isin(*HEADINGS) | ((F.col("tag") == "strong") & ~F.coalesce(F.col("carrier").isin(*HEADINGS), F.lit(False)))))
    return found.groupBy("doc", "text").agg(F.min("ord").alias("ord")).select("doc", "ord", "text")


def page_links(nodes: DataFrame) -> DataFrame:
    """Links with an absolute target: (doc, ord, url, text)."""
    anchors = nodes.filter((F.col("tag") == "a") & (_attr("href") != "") & ~F.trim(_attr("href")).rlike("(?i)^(#|mailto:|javascript:)"))
    return anchors.select("doc", "ord", _absolute(_attr("href")).alias("url"), "text").filter(F.startswith("url", F.lit("http")))


def has_forum_images(nodes: DataFrame, config: Config) -> DataFrame:
    """Documents with an image of the old forum: (doc)."""
    return nodes.filter((F.col("tag") == "img") & F.contains(F.coalesce(F.nullif(_attr("src"), F.lit("")), _attr("data-src")), F.lit(config.forum_thumbnails))).select("doc").distinct()
