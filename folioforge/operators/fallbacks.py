"""Ordered fallbacks of downloads, and the signals that tie posts of several languages together.

Payloads stay where they are: a chain says which attempt an item takes, by the
key of its payload, so no content goes through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.config import Config
from folioforge.functions.names import suffix
from folioforge.functions.url import clean_url, host_of, path_of

# Content types of archives.
ARCHIVE_TYPES = (
    "application/zip", "application/x-zip-compressed",
    "application/x-rar-compressed", "application/x-7z-compressed",
    "application/gzip", "application/x-tar",
    "application/octet-stream",
)
#: fewer bytes of a drive file are a notice, not the file
LEAST_DRIVE_BYTES = 500


def acceptable(content_type: Column, final_url: Column, size: Column, config: Config, by_extension: Column, archives: Column, least: Column | None = None) -> Column:
    """Whether a response is an image: by its type, where allowed by its extension, or where allowed an archive; of `least` bytes, one at least.

    Never null: a missing type, address or size is none.
    """
    kind, ext = F.lower(F.coalesce(content_type, F.lit(""))), suffix(path_of(F.coalesce(final_url, F.lit(""))))
    archive = F.trim(F.substring_index(kind, ";", 1)).isin(*ARCHIVE_TYPES) | ext.isin(*config.archive_exts)
    good = F.startswith(kind, F.lit("image/")) | (by_extension & ext.isin(*config.image_exts)) | (archives & archive)
    return F.coalesce(good & (size >= F.greatest(F.lit(1), F.lit(1) if least is None else least)), F.lit(False))


def chain(items: DataFrame, keys: list[str], steps: list[tuple[str, DataFrame, list[str], Column]], payload: list[str]) -> DataFrame:
    """items with the payload of the first step that has an acceptable one, and the step's name in `how`, null if none has.

    steps: name, attempts, the columns to join them by, and whether an attempt
    will do. All steps meet in one aggregation, so an item is shuffled once
    for each step and once more for the result. Of several attempts of a step
    the least payload counts. Repeated items give a row each.
    """
    own = [c for c in items.columns if c not in payload]
    union = None
    for n, (name, attempts, on, good) in enumerate(steps):
        met = items.select(*own).distinct().join(attempts.select(*on, *payload), on).filter(good)
        part = met.select(*keys, F.struct(F.lit(n).alias("step"), *payload, F.lit(name).alias("how")).alias("__s"))
        union = part if union is None else union.unionByName(part)
    best = union.groupBy(*keys).agg(F.min("__s").alias("__s"))
    return items.select(*own).join(best, keys, "left").select(*own, *[F.col(f"__s.{c}").alias(c) for c in [*payload, "how"]])


def download_chain(items: DataFrame, direct: DataFrame, archive: DataFrame, from_post: DataFrame, config: Config) -> DataFrame:
    """The attempt that each image takes: direct, then the archive, then the match on its archived post, as its kind allows.

    items: doc, url, kind. direct, archive: url, payload, final_url,
    content_type, size. from_post: the same with doc. A linked file goes to the
    archive on the hosts of the CDN only and never to the post; drive files need
    some bytes when fetched directly; archives count where a link says so.
    """
    payload = ["payload", "final_url", "content_type", "size"]
    kind = F.col("kind")
    linked = kind.isin("linked_keyword", "linked_direct")
    will = lambda least: acceptable(F.col("content_type"), F.col("final_url"), F.col("size"), config, kind == "linked_direct", linked, least)
    on_cdn = host_of(F.col("url")).isin(*config.cdn_hosts)
    return chain(
        items.select("doc", "url", "kind"),
        ["doc", "url"],
        [
            ("direct", direct, ["url"], will(F.when(kind == "gdrive", LEAST_DRIVE_BYTES).otherwise(1))),
            ("archive", archive, ["url"], will(F.lit(1)) & ((kind != "linked_direct") | on_cdn)),
            ("archived_post", from_post, ["doc", "url"], will(F.lit(1)) & (kind != "linked_direct")),
        ],
        payload,
    )


def media_chain(items: DataFrame, direct: DataFrame, archive: DataFrame, forum: DataFrame) -> DataFrame:
    """The attempt that each medium takes: direct, the archive, the archive under the old forum's path. Anything but a page will do."""
    good = (F.col("size") > 0) & ~F.contains(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("text/html"))
    return chain(items.select("doc", "url"), ["doc", "url"], [(n, rows, ["url"], good) for n, rows in (("direct", direct), ("archive", archive), ("forum", forum))], ["payload", "content_type", "size"])


def overridden(items: DataFrame, overrides: DataFrame, image_map: DataFrame) -> DataFrame:
    """Items with an override: doc, url, target and the target's local path, null if it has to be fetched first.

    overrides: url, target. image_map: clean_url, relative_path. Addresses are
    compared in their canonical form; of several overrides of one the least counts.
    """
    wanted = overrides.groupBy(clean_url(F.col("url")).alias("__k")).agg(F.min("target").alias("target")).withColumn("__t", clean_url(F.col("target")))
    met = items.select("doc", "url", clean_url(F.col("url")).alias("__k")).join(wanted, "__k")
    return met.join(image_map.select(F.col("clean_url").alias("__t"), "relative_path"), "__t", "left").select("doc", "url", "target", "relative_path")


def remote_first(media: DataFrame, config: Config) -> DataFrame:
    """media_url, relative_path of a media map in which addresses of the settings' remote rewrites take the place of local paths."""
    remote = media.sparkSession.createDataFrame(sorted(config.remote_urls().items()), "media_url string, relative_path string").withColumn("__o", F.lit(0))
    both = remote.unionByName(media.select("media_url", "relative_path", F.lit(1).alias("__o")))
    first = both.groupBy(clean_url(F.col("media_url")).alias("__k")).agg(F.min(F.struct("__o", "media_url", "relative_path")).alias("f"))
    return first.select("f.media_url", "f.relative_path")


def by_heading(failed: DataFrame, category: str, retry: bool) -> DataFrame:
    """Failed items that may be looked for under like headings: shown images and drive files of one category, on a retry only."""
    return failed.filter((F.col("category") == category) & F.col("kind").isin("img", "gdrive") & F.lit(retry))


def started(lang: Column, day: Column, starts: dict[str, str]) -> Column:
    """Whether a day is not before the first one of a language; unknown days and languages are not."""
    first = F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(starts.items()) for x in kv]), lang) if starts else F.lit(None)
    return ~F.coalesce((day != "") & (day < first), F.lit(False))


def category_index(tags: DataFrame, aliases: DataFrame) -> DataFrame:
    """url, lang, category of posts by their first tag (url, lang, tag), with the aliases (lang, tag, category) of a language's tags."""
    known = aliases.groupBy("lang", "tag").agg(F.min("category").alias("category"))
    return tags.filter("tag <> ''").join(known, ["lang", "tag"], "left").select("url", "lang", F.coalesce("category", "tag").alias("category"))


def language_candidates(posts: DataFrame, others: DataFrame, categories: DataFrame, starts: dict[str, str]) -> DataFrame:
    """Posts of other languages that may be a post's counterpart: doc, url, lang, score, rank from 1.

    posts: doc, slug, day, category, lastmod. others: url, lang, slug, day,
    category, lastmod. categories: category, lang, expected. The same slug
    scores 4; on the same day the expected category and an equal last change
    score 1 each. What scores nothing is no candidate. Each signal is a join of
    its own by equality, so posts of a day don't meet each other for nothing.
    Languages count from their start on.
    """
    there = others.select(F.col("url"), F.col("lang"), F.col("slug").alias("__slug"), F.col("day").alias("__day"), F.col("category").alias("__cat"), F.col("lastmod").alias("__mod"))
    own = posts.select("doc", "slug", "day", "category", "lastmod")
    asked = own.join(categories.filter("expected is not null").select("category", F.col("lang").alias("__lang"), "expected"), "category").filter("day <> ''")
    pair = lambda df, signal, score: df.select("doc", "url", "lang", "day", F.lit(signal).alias("signal"), F.lit(score).alias("score"))
    same_slug = own.join(there, (F.col("slug") == F.col("__slug")) & (F.col("slug") != ""))
    same_category = asked.join(there, (F.col("day") == F.col("__day")) & (F.col("expected") == F.col("__cat")) & (F.col("lang") == F.col("__lang")))
    same_change = own.filter("day <> '' and lastmod <> ''").join(there, (F.col("day") == F.col("__day")) & (F.col("lastmod") == F.col("__mod")))
    every = pair(same_slug, "slug", 4).unionByName(pair(same_category, "category", 1)).unionByName(pair(same_change, "lastmod", 1)).filter(started(F.col("lang"), F.col("day"), starts))
    # a signal counts once for a pair, however often its rows are repeated
    scored = every.drop("day").distinct().groupBy("doc", "url", "lang").agg(F.sum("score").alias("score"))
    return scored.withColumn("rank", F.row_number().over(W.partitionBy("doc").orderBy(F.desc("score"), "lang", "url")))


def date_index(posts: DataFrame) -> DataFrame:
    """day, url, lang of posts with a published time (url, lang, published_time)."""
    return posts.filter("published_time <> ''").select(F.substring("published_time", 1, 10).alias("day"), "url", "lang").distinct()
