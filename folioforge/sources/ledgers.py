"""Readers of the archive's text ledgers, sitemaps and JSON responses.

Ledgers are CSV files with a header line: UTF-8 with or without a byte order
mark, one record per line, fields stripped of spaces, quotes doubled. They are
read as text lines, so a header may stand anywhere (appended files repeat it)
and short lines are no errors. A missing file is an empty table. Lines keep
their order within a file in `_seq`, as first and last wins by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file with `_seq`; the mark at a file's start is removed. Files are small ledgers; a directory of many is read in parallel, a file by one task."""
    if not exists(spark, path):
        return spark.createDataFrame([], "_seq bigint, value string")
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.arrays_zip(F.split(F.regexp_replace("value", "^﻿", ""), r"\r\n|\n|\r", -1).alias("value"))).alias("l"), F.input_file_name().alias("file"))
    numbered = whole.select("file", F.col("l.value").alias("value")).withColumn("_seq", F.monotonically_increasing_id())
    return numbered.filter(F.trim("value") != "").select("_seq", "value")


def ledger(spark: SparkSession, path: str, columns: list[str], least: int | None = None, exactly: bool = False, comment: str | None = None, headers: list[str] | None = None) -> DataFrame:
    """Rows of a ledger, fields '' where missing.

    least: fewer fields make no record (all columns if None). exactly: more
    fields make none either. headers: header lines to leave out, by default the
    columns joined; comment: lines with that start are left out.
    """
    lines = text_lines(spark, path)
    known = headers or [",".join(columns)]
    lines = lines.filter(~F.trim("value").isin(*known))
    if comment is not None:
        lines = lines.filter(~F.startswith(F.trim("value"), F.lit(comment)))
    wide = T.StructType([T.StructField(f"c{n}", T.StringType()) for n in range(len(columns) + 1)])
    fields = F.from_csv("value", F.lit(wide.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), {"escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    rows = lines.withColumn("__f", fields)
    need = len(columns) if least is None else least
    if need:
        rows = rows.filter(F.col(f"__f.c{need - 1}").isNotNull())
    if exactly:
        rows = rows.filter(F.col(f"__f.c{len(columns)}").isNull())
    return rows.select("_seq", *[F.coalesce(F.trim(f"__f.c{n}"), F.lit("")).alias(c) for n, c in enumerate(columns)])


def posts(spark: SparkSession, path: str) -> DataFrame:
    """url, lastmod, published_time; `#` starts a comment, missing fields are ''."""
    return ledger(spark, path, ["url", "lastmod", "published_time"], least=1, comment="#", headers=["url,lastmod,published_time", "url,lastmod", "url"]).filter("url <> ''")


def image_map(spark: SparkSession, path: str) -> DataFrame:
    """clean_url, relative_path; of a URL that occurs again the last path counts."""
    rows = ledger(spark, path, ["clean_url", "relative_path"], exactly=True)
    return rows.groupBy("clean_url").agg(F.max_by("relative_path", "_seq").alias("relative_path"))


def done(spark: SparkSession, path: str) -> DataFrame:
    """slug, post_url; the last line of a slug counts."""
    rows = ledger(spark, path, ["slug", "post_url"]).filter("post_url <> ''")
    return rows.groupBy("slug").agg(F.max_by("post_url", "_seq").alias("post_url"))


def failed(spark: SparkSession, path: str, item: str | None = None) -> DataFrame:
    """post_url, reason, or with `item` its column between them; each row once."""
    columns = ["post_url", "reason"] if item is None else ["post_url", item, "reason"]
    heads = ["post_url,reason", "post_url,img_url,reason", "post_url,media_url,reason"]
    return ledger(spark, path, columns, least=1, headers=heads).drop("_seq").distinct()


def stale(spark: SparkSession, path: str) -> DataFrame:
    """post_url, unmapped as an array without repeats."""
    rows = ledger(spark, path, ["post_url", "unmapped_urls"])
    return rows.select("post_url", F.array_distinct(F.filter(F.split("unmapped_urls", r"\|"), lambda x: x != "")).alias("unmapped"))


def seen(spark: SparkSession, path: str, scopes: tuple[str, ...] = ("main", "thumb")) -> DataFrame:
    """scope, url of prefixed lines; a line without known prefix is of the first scope."""
    pattern = rf"^({'|'.join(scopes)}):"
    scope = F.coalesce(F.nullif(F.regexp_extract("value", pattern, 1), F.lit("")), F.lit(scopes[0]))
    return text_lines(spark, path).select(scope.alias("scope"), F.trim(F.regexp_replace("value", pattern, "")).alias("url")).distinct()


def done_counts(spark: SparkSession, path: str, count: str = "image_count") -> DataFrame:
    """post_url, n; text that is no number counts as 0, the last line of a post counts."""
    rows = ledger(spark, path, ["post_url", count])
    return rows.groupBy("post_url").agg(F.max_by(F.coalesce(F.col(count).try_cast("int"), F.lit(0)), "_seq").alias("n"))


def media_map(spark: SparkSession, path: str) -> DataFrame:
    """post_url, media_url, relative_path, anchor_type (`inline` if missing), anchor_text; the first row of a post's medium counts."""
    rows = ledger(spark, path, ["post_url", "media_url", "relative_path", "anchor_type", "anchor_text"], least=3).filter("media_url <> '' and relative_path <> ''")
    rows = rows.withColumn("anchor_type", F.coalesce(F.nullif("anchor_type", F.lit("")), F.lit("inline")))
    first = rows.groupBy("post_url", "media_url").agg(F.min_by(F.struct("relative_path", "anchor_type", "anchor_text"), "_seq").alias("f"))
    return first.select("post_url", "media_url", "f.*")


def hashes(spark: SparkSession, path: str) -> DataFrame:
    """sha256, relative_path, is_thumb of a hash ledger. Either spelling of the header is one."""
    rows = ledger(spark, path, ["sha256", "relative_path", "is_thumb"], least=2, headers=["sha256_hash,relative_path,is_thumbnail", "hash,relative_path,is_thumb"])
    return hash_entries(rows.filter("sha256 <> '' and relative_path <> ''"))


def hash_entries(rows: DataFrame) -> DataFrame:
    """sha256, relative_path, is_thumb: the last path of a hash counts, and it is a thumbnail's if any row says so (`T`)."""
    return rows.groupBy("sha256").agg(F.max_by("relative_path", "_seq").alias("relative_path"), F.bool_or(F.coalesce(F.col("is_thumb") == "T", F.lit(False))).alias("is_thumb"))


def legacy_thumbs(spark: SparkSession, path: str) -> DataFrame:
    """sha256 of the former list of thumbnails, a hash per line."""
    return text_lines(spark, path).select(F.trim("value").alias("sha256")).distinct()


def file_hashes(spark: SparkSession, folder: str, thumbnails: str = "/thumbnails/", legacy: DataFrame | None = None) -> DataFrame:
    """sha256, relative_path, is_thumb of the files below a folder; the least path of equal files counts.

    A thumbnail is what lies in the folder of thumbnails or is in the legacy list.
    """
    if not exists(spark, folder):
        return spark.createDataFrame([], "sha256 string, relative_path string, is_thumb boolean")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    hashed = files.select(F.sha2("content", 256).alias("sha256"), F.regexp_replace("path", r"^file:(//)?", "").alias("path"))
    known = hashed.groupBy("sha256").agg(F.min("path").alias("relative_path"), F.bool_or(F.contains("path", F.lit(thumbnails))).alias("is_thumb"))
    if legacy is None:
        return known
    listed = legacy.select("sha256").distinct().withColumn("__listed", F.lit(True))
    return known.join(listed, "sha256", "left").select("sha256", "relative_path", (F.col("is_thumb") | F.coalesce("__listed", F.lit(False))).alias("is_thumb"))


def line_count(spark: SparkSession, path: str) -> int:
    """Lines of a ledger that aren't blank."""
    return text_lines(spark, path).count()


def first_row(rows: DataFrame) -> DataFrame:
    """The first row of a ledger."""
    return rows.orderBy("_seq").limit(1)


def modified(spark: SparkSession, path: str) -> int | None:
    """Time of the last change of a file or folder in epoch milliseconds, None if there is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getFileStatus(hadoop).getModificationTime() if system.exists(hadoop) else None


def still_valid(spark: SparkSession, cache: str, sources: list[str]) -> bool:
    """Whether a cache is there and none of its sources was changed after it; missing sources don't count."""
    at = modified(spark, cache)
    return at is not None and all((m := modified(spark, s)) is None or m <= at for s in sources)


def published_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(day, url, lang) and (url, category) of a published index.

    It is a folder as `sinks.write_published_index` writes it, or one JSON
    object of lists by day with `_categories` and `_meta`. A missing or broken
    one gives no rows.
    """
    none = spark.createDataFrame([], "day string, url string, lang string"), spark.createDataFrame([], "url string, category string")
    if not exists(spark, path):
        return none
    if exists(spark, f"{path}/days"):
        days = spark.read.schema("day string, entries array<struct<url:string,lang:string>>").json(f"{path}/days")
        return days.select("day", F.inline("entries")), spark.read.schema("url string, category string").json(f"{path}/categories")
    parts = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "part"))
    days = parts.filter("key not in ('_meta', '_categories')").select(F.col("key").alias("day"), F.explode(F.from_json("part", "array<array<string>>")).alias("e"))
    categories = parts.filter("key = '_categories'").select(F.explode(F.from_json("part", "map<string,string>")).alias("url", "category"))
    return days.select("day", F.get("e", F.lit(0)).alias("url"), F.get("e", F.lit(1)).alias("lang")), categories


def html_files(spark: SparkSession, folder: str, done_rows: DataFrame) -> DataFrame:
    """post_url, path, html of the saved pages that the ledger of done pages knows by their name."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "post_url string, path string, html string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").load(folder)
    files = files.select(F.regexp_extract("path", r"([^/]+)\.html$", 1).alias("slug"), "path", F.col("content").cast("string").alias("html"))
    return files.join(done_rows, "slug").select("post_url", "path", "html")


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """url, lastmod (`YYYY-MM-DD` or '') and its position of every <url> with a <loc>, whatever the namespace. A broken file gives no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], "position int, url string, lastmod string")
    return sitemap_entries(spark.read.text(path, wholetext=True), F.col("value"))


def sitemap_entries(documents: DataFrame, xml: Column) -> DataFrame:
    blocks = documents.select(F.posexplode(F.regexp_extract_all(F.regexp_replace(xml, r"(?s)<!--.*?-->", ""), F.lit(r"(?s)<(?:[\w.-]+:)?url(?:\s[^>]*)?>(.*?)</(?:[\w.-]+:)?url\s*>"), F.lit(1))))
    own = F.regexp_replace("col", r"(?s)<(?:[\w.-]+:)?(?:image|video|news)(?:\s[^>]*)?>.*?</(?:[\w.-]+:)?(?:image|video|news)\s*>", "")
    loc = F.trim(F.regexp_replace(F.regexp_extract(own, r"(?s)<(?:[\w.-]+:)?loc\s*>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</", 1), "&amp;", "&"))
    day = F.regexp_extract(F.regexp_extract(own, r"(?s)<(?:[\w.-]+:)?lastmod\s*>(.*?)</", 1), r"(\d{4}-\d{2}-\d{2})", 1)
    return blocks.select((F.col("pos") + 1).alias("position"), loc.alias("url"), day.alias("lastmod")).filter("url <> ''")


def cdx_rows(responses: DataFrame, body: Column, keep: list[str]) -> DataFrame:
    """timestamp, original, status of archive index responses, rows of an array under a header row; broken ones give none."""
    rows = F.from_json(body, "array<array<string>>")
    told = responses.select(*keep, F.posexplode(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))))
    return told.select(*keep, "pos", F.get("col", F.lit(0)).alias("timestamp"), F.get("col", F.lit(1)).alias("original"), F.get("col", F.lit(2)).alias("status"))


def oldest_snapshots(rows: DataFrame, keep: list[str], most: int = 5) -> DataFrame:
    """The first snapshot with a 2xx or 3xx status of each key, in the archive's order, among its first `most`."""
    good = rows.filter(F.col("status").rlike(r"^\s*[23]") & (F.col("pos") < most) & (F.trim("timestamp") != "") & (F.trim("original") != ""))
    return good.groupBy(*keep).agg(F.min(F.struct("pos", "timestamp", "original")).alias("s")).select(*keep, "s.timestamp", "s.original")


def snapshots_below(rows: DataFrame, prefix: str, first: str, last: str, most: int) -> DataFrame:
    """Distinct addresses below a prefix with a good snapshot between two timestamps, in the archive's order: a report of `most` at most."""
    there = rows.filter(F.startswith("original", F.lit(prefix)) & F.col("timestamp").between(first, last) & (F.col("status") == "200"))
    return there.groupBy("original").agg(F.min("pos").alias("pos")).orderBy("pos", "original").limit(most).select("original", "pos")


def channel_page_items(responses: DataFrame, body: Column) -> DataFrame:
    """id, title, published_at, media_urls, sort of channel API responses; an image gives its URL, a link its first image that has one."""
    media = "array<struct<type:string,url:string,images:array<struct<url:string>>>>"
    page = F.from_json(body, f"items array<struct<id:bigint,title:string,published_at:bigint,sort:string,media:{media}>>")
    items = responses.select(F.explode(page.getField("items")).alias("i")).select("i.*")
    first = lambda m: F.get(F.filter(F.transform(m.images, lambda x: x.url), lambda u: u != ""), F.lit(0))
    urls = F.array_compact(F.transform("media", lambda m: F.when(m.type == "image", F.nullif(m.url, F.lit(""))).when(m.type == "link", first(m))))
    return items.select("id", "title", "published_at", F.coalesce(urls, F.array().cast("array<string>")).alias("media_urls"), F.col("sort").try_cast("bigint").alias("sort"))


def merge_channel(cached: DataFrame, fetched: DataFrame) -> DataFrame:
    """Cache with newer items; what was known up to the cache's greatest `sort` stays, of repeated ids the greatest sort counts."""
    mark = F.broadcast(cached.agg(F.coalesce(F.max("sort"), F.lit(-1)).alias("__mark")))
    new = fetched.join(mark).filter(F.col("sort") > F.col("__mark")).drop("__mark")
    both = cached.unionByName(new)
    return both.groupBy("id").agg(F.max_by(F.struct(*[c for c in both.columns if c != "id"]), "sort").alias("r")).select("id", "r.*")
