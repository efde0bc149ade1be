"""Queries of the general problems 1 to 4 over the project's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.url import host_of, slug_of, with_image_key
from folioforge.operators.orphans import orphans_of_intervals, orphans_of_snapshots, per_table_and_period
from folioforge.operators.snapshots import snapshot_changes
from folioforge.operators.timestamps import with_instant
from folioforge.sources.tables import Blogs, table

#: zone of channel timestamps that are written out in digits
CHANNEL_ZONE = "Asia/Seoul"


def post_key(blogs: Blogs, url: Column) -> tuple[Column, Column]:
    """(lang, slug) of a post's url; lang is null for other hosts."""
    return blogs.lang_of(host_of(url)), slug_of(url)


def post_instants(posts: DataFrame, blogs: Blogs, column: str, out: str) -> DataFrame:
    host = host_of(F.col("url"))
    return with_instant(posts, F.col(column), blogs.tz_of(host), blogs.order_of(host), out)


def channel_instants(channel: DataFrame, out: str) -> DataFrame:
    return with_instant(channel, F.col("published_at"), F.lit(CHANNEL_ZONE), F.lit("ymd"), out)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Values that denote an instant and aren't written in the canonical form yet."""
    blogs = Blogs.read(table(spark, folder, "blogs"))
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("lastmod", "published_time")]))
    posts = table(spark, folder, "all_posts").select("row_id", "url", fields.alias("__f")).select("row_id", "url", "__f.field", "__f.value")
    posts = posts.filter(~F.coalesce(F.regexp_like("value", F.lit(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$")), F.lit(True)))
    posts = post_instants(posts, blogs, "value", "utc_ms").select(F.lit("all_posts").alias("tab"), "row_id", "field", "utc_ms")
    channel = table(spark, folder, "channel_posts").select("row_id", "published_at").filter(F.length(F.col("published_at").cast("string")) != 13)
    channel = channel_instants(channel, "utc_ms").select(F.lit("channel_posts").alias("tab"), "row_id", F.lit("published_at").alias("field"), "utc_ms")
    return posts.unionByName(channel).filter(F.col("utc_ms").isNotNull())


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Posts added, removed or changed at each snapshot."""
    blogs = Blogs.read(table(spark, folder, "blogs"))
    posts = table(spark, folder, "all_posts").select("snap_no", "url", "lastmod", "loaded_at")
    lang, slug = post_key(blogs, F.col("url"))
    rows = post_instants(posts, blogs, "lastmod", "utc_ms").select("snap_no", "loaded_at", "utc_ms", lang.alias("lang"), F.nullif(slug, F.lit("")).alias("slug"))
    return snapshot_changes(rows, "snap_no", ["lang", "slug"], ["loaded_at"], [F.col("utc_ms")])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """References of done_html without a listed post and of image_map without a kept download."""
    blogs = Blogs.read(table(spark, folder, "blogs"))
    lang, slug = post_key(blogs, F.col("post_url"))
    done = table(spark, folder, "done_html").filter(F.trim("post_url") != "").select("done_id", "done_at", F.coalesce(lang, F.lit("")).alias("lang"), slug.alias("slug"))
    lang, slug = post_key(blogs, F.col("url"))
    listed = table(spark, folder, "all_posts").select("snap_no", "snapshot_date", lang.alias("lang"), slug.alias("slug"))
    posts = orphans_of_snapshots(done, "done_at", "done_id", ["lang", "slug"], listed, "snap_no", "snapshot_date")
    images = with_image_key(table(spark, folder, "image_map").select("map_id", "url", "logged_at"), F.col("url"), "image")
    url = F.regexp_replace("dl_key", r"^\s*(?:main|thumb):(?=\s*[A-Za-z][A-Za-z0-9+.\-]*:|\s*//)", "")
    kept = with_image_key(table(spark, folder, "downloaded_urls").select("dl_key", "downloaded_at", "removed_at"), url, "image")
    files = orphans_of_intervals(images, "image", "logged_at", "map_id", kept, "downloaded_at", "removed_at")
    shape = lambda df, tab, key, at: df.select(F.lit(tab).alias("tab"), F.col(key).alias("ref_id"), F.date_format(at, "yyyy-MM").alias("period"), "reason")
    return shape(posts, "done_html", "done_id", "done_at").unionByName(shape(files, "image_map", "map_id", "logged_at"))


def p4_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references counted per table, month and reason."""
    return per_table_and_period(p4_found(spark, folder))


def _image_key_sql(url: str) -> str:
    no_ref = f"regexp_replace(regexp_replace(regexp_replace({url}, '([?&])ref=[^&#]*(&|$)', '\\1', 'g'), '[?&]$', ''), '(?i)/size/w\\d+(?:h\\d+)?', '', 'g')"
    bare = f"rtrim(regexp_replace(regexp_replace({no_ref}, '^\\s*(?:[A-Za-z]+:)?//', ''), '(?i)^(cdn\\.[^/]+/image/[a-z]+/[a-z]{{2}})/[po]/', '\\1/'), '/ ')"
    return f"lower(split_part({bare}, '/', 1)) || substr({bare}, length(split_part({bare}, '/', 1)) + 1)"


_HOST = "regexp_replace(lower(regexp_extract(u, '^\\s*(?:[A-Za-z]+:)?//([^/:?#]*)', 1)), '^www\\.', '')"
_SLUG = "lower(url_decode(replace(regexp_extract(regexp_replace(regexp_replace(u, '[?#].*$', ''), '[/\\s]+$', ''), '([^/]+)$', 1), '+', '%2B')))"
#: SQL of p4_found
P4_SQL = f"""
WITH snaps AS (SELECT snap_no, min(snapshot_date::DATE) AS d FROM all_posts GROUP BY snap_no),
listed AS (SELECT DISTINCT b.lang, slug, d FROM (SELECT snap_no, {_HOST} AS host, {_SLUG} AS slug FROM (SELECT snap_no, url AS u FROM all_posts)) a JOIN blogs b USING (host) JOIN snaps USING (snap_no)),
done AS (SELECT done_id, done_at, coalesce(b.lang, '') AS lang, slug, (SELECT max(d) FROM snaps WHERE d <= done_at::DATE) AS cur FROM (SELECT done_id, done_at, {_HOST} AS host, {_SLUG} AS slug FROM (SELECT done_id, done_at, post_url AS u FROM done_html WHERE trim(post_url) <> '')) LEFT JOIN blogs b USING (host)),
posts AS (SELECT done_id, any_value(done_at) AS done_at, count(l.d) AS n, count(*) FILTER (WHERE l.d = cur) AS now, count(*) FILTER (WHERE l.d < cur) AS earlier FROM done LEFT JOIN listed l USING (lang, slug) GROUP BY done_id),
kept AS (SELECT {_image_key_sql("u")} AS k, downloaded_at AS s, removed_at AS e FROM (SELECT regexp_replace(dl_key, '^(main|thumb):', '') AS u, * FROM downloaded_urls)),
refs AS (SELECT map_id, logged_at AS t, {_image_key_sql("u")} AS k FROM (SELECT map_id, logged_at, url AS u FROM image_map)),
files AS (SELECT map_id, any_value(t) AS t, count(kept.k) AS n, count(*) FILTER (WHERE s <= t AND (e IS NULL OR e > t)) AS held, count(*) FILTER (WHERE s <= t) AS started FROM refs LEFT JOIN kept USING (k) GROUP BY map_id)
SELECT 'done_html' AS tab, done_id AS ref_id, strftime(done_at, '%Y-%m') AS period, CASE WHEN n = 0 THEN 'missing' WHEN earlier > 0 THEN 'deleted' ELSE 'late' END AS reason FROM posts WHERE now = 0
UNION ALL
SELECT 'image_map', map_id, strftime(t, '%Y-%m'), CASE WHEN n = 0 THEN 'missing' WHEN started = 0 THEN 'late' ELSE 'deleted' END FROM files WHERE held = 0
"""
