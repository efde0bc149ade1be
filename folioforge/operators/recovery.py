"""Finding a replacement for what is lost: donors, archived pages, other languages, the channel.

Every step works on what earlier steps left unresolved, so a costly match meets
few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.dom import Node, ancestors, elements, parse, text_of
from folioforge.functions.names import title_slug, url_join
from folioforge.functions.url import clean_url, link_key, original_of_snapshot, percent_decoded
from folioforge.operators.documents import content_of
from folioforge.operators.relations import interval_pairs, similarity

LEAST_CONTEXT, LONGEST_CONTEXT = 20, 120


def donor_images(broken: DataFrame, sections: DataFrame, posts: DataFrame, within: int, least: float) -> DataFrame:
    """Images of sections in other posts that stand in for broken ones.

    broken: doc, url. sections: doc, section, heading, pos, total, url (as
    section_images gives). posts: doc, category, day. A donor is another post of
    the category within so many days, with a section whose heading is similar
    and that has as many images; the image at the same place stands in. The
    nearest donor counts, then the most similar heading, then the least name.

    Returns doc, url, donor, donor_url, days, ratio.
    """
    where = broken.join(sections, ["doc", "url"]).join(posts.select("doc", "category", "day"), "doc")
    lost = where.groupBy("doc", "url").agg(F.min(F.struct("section", "pos", "heading", "total", "category", "day")).alias("s")).select("doc", "url", "s.*")
    asked = lost.select("category", F.col("doc").alias("l"), "day").distinct()
    other = posts.select("category", F.col("doc").alias("r"), F.col("day").alias("other_day"))
    pairs = interval_pairs(asked, other, ["category"], "l", "r", "day", "other_day", within).filter("l <> r")
    donors = sections.select(F.col("doc").alias("r"), F.col("heading").alias("other"), F.col("total"), F.col("pos"), F.col("url").alias("donor_url"))
    # place and number of images are equal, which the join uses; the heading is compared for what is left
    met = lost.withColumnRenamed("doc", "l").select("l", "url", "heading", "total", "pos").join(pairs, "l").join(donors, ["r", "total", "pos"])
    scored = met.withColumn("ratio", similarity("heading", "other")).filter(F.col("ratio") >= least)
    best = scored.groupBy("l", "url").agg(F.min(F.struct("days", -F.col("ratio"), "r", "donor_url", "ratio")).alias("b"))
    return best.select(F.col("l").alias("doc"), "url", F.col("b.r").alias("donor"), "b.donor_url", "b.days", "b.ratio")


def archived_page_match(items: DataFrame, archived: DataFrame) -> DataFrame:
    """The archived form of an item on its page's snapshot, by link key: doc, url, archived_url, the first by order.

    items: doc, url. archived: doc, ord, url of the snapshot's images and links.
    """
    there = archived.select("doc", "ord", F.col("url").alias("archived_url"), link_key(original_of_snapshot(F.col("url"))).alias("k"))
    met = items.withColumn("k", link_key(F.col("url"))).join(there, ["doc", "k"])
    return met.groupBy("doc", "url").agg(F.min_by("archived_url", "ord").alias("archived_url"))


def same_place(items: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Items with the URL at their place in the other document; documents must have as many places.

    items, other: keys, pos, url. Returns keys, pos, url, other_url.
    """
    size = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    equal = size(items, "n").join(size(other, "m"), keys).filter("n = m").select(*keys)
    return items.join(equal, keys, "left_semi").join(other.select(*keys, "pos", F.col("url").alias("other_url")), [*keys, "pos"])


def language_chain(items: DataFrame, swapped: DataFrame, listed: DataFrame, placed: DataFrame) -> DataFrame:
    """The first replacement from other languages: the same URL on their host (A), an equal URL in a candidate post (A2), the same place in a confirmed one (B).

    items: doc, url. The others: doc, url, found, rank of the candidate.
    """
    union = None
    for order, (phase, rows) in enumerate((("A", swapped), ("A2", listed), ("B", placed))):
        part = rows.select("doc", "url", F.lit(order).alias("__o"), "rank", F.lit(phase).alias("phase"), "found").filter("found is not null")
        union = part if union is None else union.unionByName(part)
    best = union.groupBy("doc", "url").agg(F.min(F.struct("__o", "rank", "found", "phase")).alias("b"))
    return items.join(best, ["doc", "url"], "left").select("doc", "url", "b.found", "b.phase")


def larger_first(a: DataFrame, b: DataFrame, keys: list[str], content: str) -> DataFrame:
    """Of two replacements the one with more bytes, a tie to the first; the other as an alternative if it differs.

    Returns keys, content, source (a or b), alternative (null if equal or alone).
    """
    met = a.select(*keys, F.col(content).alias("__a")).join(b.select(*keys, F.col(content).alias("__b")), keys, "full_outer")
    first = F.col("__a").isNotNull() & (F.col("__b").isNull() | (F.octet_length("__a") >= F.octet_length("__b")))
    differs = F.sha2("__a", 256) != F.sha2("__b", 256)
    return met.select(*keys, F.when(first, F.col("__a")).otherwise(F.col("__b")).alias(content), F.when(first, "a").otherwise("b").alias("source"), F.when(differs, F.when(first, F.col("__b")).otherwise(F.col("__a"))).alias("alternative"))


def channel_image(items: DataFrame, urls: Column, idx: Column, own: Column) -> DataFrame:
    """items with the channel's image for them: the first for the page's own image, else the one at their place, null beyond the last."""
    return items.withColumn("channel_url", F.get(urls, F.when(own, 0).otherwise(idx - 1)))


def forum_page(posts: DataFrame, pages: DataFrame, days: int, undated: tuple[str, str]) -> DataFrame:
    """The first forum page of each post whose address contains the post's title: doc, page.

    posts: doc, title, day ('' if unknown). pages: page, day, ord. Pages count
    within so many days, for posts without date between the days of `undated`.
    Days cut into buckets make the range an equality; containment is tested
    within.
    """
    number = lambda c: F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date"))
    p = posts.select("doc", F.lower(title_slug(F.col("title"))).alias("t"), F.expr("try_cast(nullif(day, '') as date)").alias("d")).filter("t <> ''")
    low = F.when(F.col("d").isNotNull(), number(F.col("d")) - days).otherwise(number(F.lit(undated[0])))
    high = F.when(F.col("d").isNotNull(), number(F.col("d")) + days).otherwise(number(F.lit(undated[1])))
    wide = days * 2 + 1
    p = p.withColumns({"low": low, "high": high}).withColumn("b", F.explode(F.sequence(F.floor(F.col("low") / wide), F.floor(F.col("high") / wide))))
    q = pages.select("page", "ord", number(F.col("day")).alias("n"), F.lower(percent_decoded(F.col("page"))).alias("u")).withColumn("b", F.floor(F.col("n") / wide))
    met = p.join(q, "b").filter("n between low and high and contains(u, t)")
    return met.groupBy("doc").agg(F.min_by("page", F.struct("ord", "page")).alias("page"))


def recovered_media(archived: DataFrame, url: str, base: str, html: str) -> DataFrame:
    """Media of archived pages with the text before them: (doc, ord, url, kind, anchor_type, anchor_text).

    The text is the tail of what stands before in the content; with enough of it
    the medium can be put back after it (`positioned`), else it is appended.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, at, text in zip(b["doc"], b["base"], b["html"]):
                content = content_of(parse(text or ""))
                ord_ = 0
                for node in elements(content, {"video", "audio", "iframe"}):
                    if any(a.tag in ("video", "audio") for a in ancestors(node)):
                        continue
                    refs = [node.attributes().get("src", ""), *(s.attributes().get("src", "") for s in elements(node, {"source"}))]
                    before = text_before(content, node)
                    kind = "audio_tag" if node.tag == "audio" else "video_tag"
                    for ref in refs:
                        if ref.strip() and node.tag != "iframe":
                            ord_ += 1
                            enough = len(before) >= LEAST_CONTEXT
                            rows.append((doc, at, ord_, ref.strip(), kind, "positioned" if enough else "append", before[-LONGEST_CONTEXT:] if enough else ""))
            yield pd.DataFrame(rows, columns=["doc", "base", "ord", "ref", "kind", "anchor_type", "anchor_text"])

    rows = archived.select(F.col(url).alias("doc"), F.col(base).alias("base"), F.col(html).alias("html"))
    found = rows.mapInPandas(find, "doc string, base string, ord int, ref string, kind string, anchor_type string, anchor_text string")
    # resolving against a snapshot's address joins the slashes of the address inside
    absolute = F.regexp_replace(original_of_snapshot(F.regexp_replace(url_join(F.col("base"), F.col("ref")), r"(?<=/)(https?):/(?=[^/])", "$1://")), r"^(https?):/(?=[^/])", "$1://")
    first = W.partitionBy("doc", "kind", "key").orderBy("ord")
    keyed = found.withColumn("url", absolute).withColumn("key", clean_url(F.col("url"))).withColumn("__n", F.row_number().over(first))
    return keyed.filter("__n = 1").select("doc", "ord", "url", "kind", "anchor_type", "anchor_text")


def text_before(content: Node, node: Node) -> str:
    """Text of the nearest block before a node in the content, white space as single spaces."""
    last = ""
    for other in elements(content):
        if other is node:
            break
        if other.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "div") and not any(x is node for x in elements(other)):
            own = " ".join(text_of(other).split())
            last = own or last
    return last
