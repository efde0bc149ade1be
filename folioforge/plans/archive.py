"""Queries of the archive's own operators over the project's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.config import Config
from folioforge.functions import names
from folioforge.functions.url import clean_url, host_of, language_variant, link_key, moved, original_of_snapshot, snapshot_image_url
from folioforge.operators import documents as docs
from folioforge.operators import fallbacks
from folioforge.operators import relations as rel
from folioforge.operators import render
from folioforge.plans.announcements import shown_headline_and_date
from folioforge.plans.problems import _HOST, _SLUG, CHANNEL_ZONE, channel_instants, post_instants, post_key
from folioforge.session import checkpoint
from folioforge.sources import ledgers
from folioforge.sources.tables import Blogs, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def clean_sql(url: str) -> str:
    """SQL of the canonical URL of an image."""
    no_ref = f"regexp_replace(regexp_replace(regexp_replace({url}, '([?&])ref=[^&#]*(&|$)', '\\1', 'g'), '[?&]$', ''), '/size/w\\d+(?:h\\d+)?', '', 'gi')"
    return f"rtrim(regexp_replace({no_ref}, '(cdn\\.[^/]+/image/[a-z]+/[a-z]{{2}})/p/', '\\1/o/', 'gi'), '/')"


HOST_SQL = "lower(regexp_extract({url}, '^\\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^@/]*@)?(?:[wW]{{3}}\\.)?([^/:?#]*)', 1))"
PATH_SQL = "regexp_extract({url}, '^\\s*(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?[^/?#\\s]*([^?#]*)', 1)"
LATEST = "(SELECT max(snap_no) FROM all_posts)"


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the latest snapshot."""
    posts = table(spark, folder, "all_posts")
    return posts.join(F.broadcast(posts.agg(F.max("snap_no").alias("snap_no"))), "snap_no")


# scalar functions


@query(f"SELECT map_id, {clean_sql('url')} AS clean_url FROM image_map")
def canonical_urls(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "image_map").select("map_id", clean_url(F.col("url")).alias("clean_url"))


@query(f"SELECT {HOST_SQL.format(url='url')} AS host, count(*) AS n FROM image_map GROUP BY 1")
def url_host_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "image_map").groupBy(host_of(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query(
    "SELECT row_id, substr(coalesce(nullif(list_extract(list_filter(string_split("
    + PATH_SQL.format(url="url")
    + ", '/'), lambda x: x <> ''), -1), ''), regexp_replace(url, '[^\\p{L}\\p{N}_-]', '_', 'g')), 1, 120) AS slug FROM all_posts"
)
def url_slugs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "all_posts").select("row_id", names.url_slug(F.col("url")).alias("slug"))


@query(
    "SELECT map_id, lower(regexp_extract(url, '^\\s*[A-Za-z]+://([^/:?#]*)', 1)) || CASE WHEN p = '/' THEN p ELSE rtrim(p, '/') END AS link_key FROM "
    f"(SELECT map_id, url, regexp_replace(url_decode(replace({PATH_SQL.format(url='url')}, '+', '%2B')), '/size/w\\d+(?:h\\d+)?', '', 'gi') AS p FROM image_map)"
)
def link_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "image_map").select("map_id", link_key(F.col("url")).alias("link_key"))


@query(
    "SELECT map_id, regexp_extract(url_decode(regexp_extract(url, '([^/?#]*)/*(?:[?#].*)?$', 1)), '^(.*)\\.[^./]+$', 1) || '_' || substr(md5(url), 1, 8) || "
    "lower(regexp_extract(url_decode(regexp_extract(url, '([^/?#]*)/*(?:[?#].*)?$', 1)), '(\\.[^./]+)$', 1)) AS asset, "
    "regexp_replace(url_decode(regexp_extract(url, '([^/?#]*)/*(?:[?#].*)?$', 1)), '[\\\\/:*?\"<>|]', '_', 'g') AS safe_name FROM image_map"
)
def asset_names(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return table(spark, folder, "image_map").select("map_id", names.asset_filename(url).alias("asset"), names.safe_filename(names.basename(url)).alias("safe_name"))


@query(
    "SELECT event_id, strftime(ts, '%Y/%m') AS folder, year(ts)::VARCHAR || '년 ' || month(ts)::VARCHAR || '월 ' || day(ts)::VARCHAR || '일 ' || "
    "list_extract(['월요일','화요일','수요일','목요일','금요일','토요일','일요일'], isodow(ts)) AS label, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS local_date FROM events"
)
def event_dates(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    local = F.date_format(F.convert_timezone(F.lit("UTC"), F.lit("Asia/Seoul"), ts), "yyyy-MM-dd")
    return table(spark, folder, "events").select("event_id", names.date_folder(F.date_format(ts, "yyyy-MM-dd")).alias("folder"), names.long_date_ko(F.to_date(ts)).alias("label"), local.alias("local_date"))


@query("SELECT event_id, (props::JSON->>'k')::BIGINT AS k FROM events")
def json_props(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@query(
    "SELECT c.row_id, trim(regexp_replace(c.title, '[\\s\\p{Z}_-]+', '-', 'g'), '-') AS title_slug, trim(regexp_replace(c.title, '[\\s\\p{Z}]+', ' ', 'g')) AS normal, "
    "regexp_matches(lower(c.title), 'coupon|쿠폰|クーポン') AS keyword FROM channel_posts c"
)
def title_texts(spark: SparkSession, folder: str) -> DataFrame:
    title = F.col("title")
    return table(spark, folder, "channel_posts").select(
        "row_id", names.title_slug(title).alias("title_slug"), F.trim(F.regexp_replace(title, r"(?U)[\s\p{Z}]+", " ")).alias("normal"), F.lower(title).rlike("coupon|쿠폰|クーポン").alias("keyword")
    )


@query(
    "SELECT m.map_id, b.lang, regexp_replace(m.url, '^([A-Za-z][A-Za-z0-9+.-]*://)[^/?#]*', '\\1' || b.host) AS candidate FROM image_map m, blogs b WHERE b.lang IN ('en', 'ja')"
)
def language_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """URLs of an image on the blogs of two other languages; blogs is a fixed dimension of a row per language."""
    blogs = table(spark, folder, "blogs").filter(F.col("lang").isin("en", "ja")).select("lang", "host")
    each = table(spark, folder, "image_map").select("map_id", "url").join(F.broadcast(blogs))
    return each.select("map_id", "lang", language_variant(F.col("url"), F.col("host"), F.concat(F.lit("_"), F.upper("lang"))).alias("candidate"))


@query(
    "SELECT map_id, 'https://web.archive.org/web/20240101000000im_/' || url AS snapshot, url AS original, "
    "CASE WHEN lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) = 'cdn.lanternkeep.example' THEN 'https://forum.lanternkeep.example/storage' || regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) END AS forum FROM image_map"
)
def snapshot_urls(spark: SparkSession, folder: str) -> DataFrame:
    snapshot = F.concat(F.lit("https://web.archive.org/web/20240101000000/"), F.col("url"))
    return table(spark, folder, "image_map").select(
        "map_id", snapshot_image_url(snapshot).alias("snapshot"), original_of_snapshot(snapshot_image_url(snapshot)).alias("original"), moved(F.col("url"), "cdn.lanternkeep.example", "forum.lanternkeep.example", "/storage").alias("forum")
    )


# scans of ledgers: first and last win, scopes


@query(f"SELECT {clean_sql('url')} AS clean_url, max_by(coalesce(relative_path, chr(1)), map_id) AS path FROM image_map GROUP BY 1")
def image_map_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "image_map").select("map_id", clean_url(F.col("url")).alias("clean_url"), F.coalesce("relative_path", F.lit("\u0001")).alias("path"))
    return rel.last_wins(rows, ["clean_url"], ["map_id"], "path")


@query(f"SELECT {clean_sql('url')} AS clean_url, min_by(relative_path, map_id) AS path FROM image_map WHERE relative_path IS NOT NULL GROUP BY 1")
def media_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "image_map").filter("relative_path is not null").select("map_id", clean_url(F.col("url")).alias("clean_url"), F.col("relative_path").alias("path"))
    return rel.first_wins(rows, ["clean_url"], ["map_id"], "path")


@query("SELECT slug, max_by(post_url, done_id) AS post_url FROM done_html WHERE coalesce(post_url, '') <> '' GROUP BY slug")
def done_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    return rel.last_wins(table(spark, folder, "done_html").filter("coalesce(post_url, '') <> ''"), ["slug"], ["done_id"], "post_url")


_SEEN = "CASE WHEN regexp_matches(dl_key, '^(main|thumb):') THEN regexp_extract(dl_key, '^(main|thumb):', 1) ELSE 'main' END"
_SEEN_URL = "regexp_replace(dl_key, '^(main|thumb):', '')"


@query(f"SELECT DISTINCT {_SEEN} AS scope, {clean_sql(_SEEN_URL)} AS url FROM downloaded_urls")
def seen_keys(spark: SparkSession, folder: str) -> DataFrame:
    scope = F.coalesce(F.nullif(F.regexp_extract("dl_key", "^(main|thumb):", 1), F.lit("")), F.lit("main"))
    return table(spark, folder, "downloaded_urls").select(scope.alias("scope"), clean_url(F.regexp_replace("dl_key", "^(main|thumb):", "")).alias("url")).distinct()


# lists of posts


@query(
    "WITH m AS (SELECT url, max_by(coalesce(lastmod, ''), snap_no * 1000000000::BIGINT - row_id) AS lastmod, min(snap_no * 1000000000::BIGINT + row_id) AS place FROM all_posts GROUP BY url) "
    "SELECT url, lastmod, row_number() OVER (ORDER BY lastmod <> '' DESC, lastmod DESC, place, url) AS position FROM m"
)
def links_merge(spark: SparkSession, folder: str) -> DataFrame:
    """One list of all that any snapshot lists."""
    return rel.merge_lists(table(spark, folder, "all_posts"), "snap_no", "url", "lastmod", "row_id")


@query(
    f"WITH known AS (SELECT url, max(published_time) AS p FROM all_posts WHERE snap_no < {LATEST} AND coalesce(published_time, '') <> '' GROUP BY url) "
    f"SELECT row_id, coalesce(nullif(a.published_time, ''), k.p, '') AS published_time FROM all_posts a LEFT JOIN known k USING (url) WHERE snap_no = {LATEST}"
)
def published_carry(spark: SparkSession, folder: str) -> DataFrame:
    posts = table(spark, folder, "all_posts")
    latest = F.broadcast(posts.agg(F.max("snap_no").alias("latest")))
    both = posts.join(latest)
    filled = rel.carry_forward(both.filter("snap_no = latest").select("row_id", "url", "published_time"), both.filter("snap_no < latest"), ["url"], "published_time")
    return filled.select("row_id", "published_time")


@query("SELECT snap_no, count(*) AS n, count(*) FILTER (WHERE coalesce(lastmod, '') = '') AS undated, max(nullif(lastmod, '')) AS newest, min(nullif(lastmod, '')) AS oldest FROM all_posts GROUP BY snap_no")
def sitemap_stats(spark: SparkSession, folder: str) -> DataFrame:
    dated = F.nullif("lastmod", F.lit(""))
    return table(spark, folder, "all_posts").groupBy("snap_no").agg(F.count("*").alias("n"), F.count_if(F.coalesce("lastmod", F.lit("")) == "").alias("undated"), F.max(dated).alias("newest"), F.min(dated).alias("oldest"))


# ledgers, scopes, refresh


@query("SELECT h.page_id FROM html h WHERE EXISTS (SELECT 1 FROM done_html d WHERE d.post_url = h.post_url)")
def retry_scope(spark: SparkSession, folder: str) -> DataFrame:
    return rel.retry_scope(table(spark, folder, "html").select("page_id", "post_url"), [table(spark, folder, "done_html").filter("post_url is not null")], ["post_url"]).select("page_id")


@query("SELECT h.page_id FROM html h WHERE NOT EXISTS (SELECT 1 FROM done_html d WHERE d.post_url = h.post_url)")
def pending_scope(spark: SparkSession, folder: str) -> DataFrame:
    return rel.pending(table(spark, folder, "html").select("page_id", "post_url"), table(spark, folder, "done_html"), ["post_url"]).select("page_id")


def _failures(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of the image map without a path as failures of their month; one of an animation stands for all of the month."""
    rows = table(spark, folder, "image_map").filter("relative_path is null")
    return rows.select(F.date_format("logged_at", "yyyy-MM").alias("post"), F.when(F.col("url").rlike(r"(?i)\.gif"), "").otherwise(F.col("url")).alias("item")).distinct()


_FAILURES = "(SELECT DISTINCT strftime(logged_at, '%Y-%m') AS post, CASE WHEN regexp_matches(url, '(?i)[.]gif') THEN '' ELSE url END AS item FROM image_map WHERE relative_path IS NULL)"


@query(f"SELECT post, CASE WHEN bool_or(item = '') THEN NULL ELSE array_to_string(list_sort(list(DISTINCT item)), '|') END AS items FROM {_FAILURES} GROUP BY post")
def failed_entries(spark: SparkSession, folder: str) -> DataFrame:
    return rel.failed_entries(_failures(spark, folder), "post", "item").select("post", F.array_join("items", "|").alias("items"))


@query(f"SELECT f.post, f.item FROM {_FAILURES} f WHERE f.item = '' OR NOT EXISTS (SELECT 1 FROM image_map m WHERE m.relative_path IS NOT NULL AND m.url = f.item AND strftime(m.logged_at, '%Y-%m') = f.post)")
def still_failed(spark: SparkSession, folder: str) -> DataFrame:
    fixed = table(spark, folder, "image_map").filter("relative_path is not null").select(F.date_format("logged_at", "yyyy-MM").alias("post"), F.col("url").alias("item"))
    return rel.still_failed(_failures(spark, folder), fixed, "post", "item")


@query(f"SELECT DISTINCT f.post FROM {_FAILURES} f WHERE EXISTS (SELECT 1 FROM downloaded_urls d WHERE {_SEEN_URL} = f.item)")
def stale_refresh(spark: SparkSession, folder: str) -> DataFrame:
    stale = _failures(spark, folder).groupBy("post").agg(F.collect_set("item").alias("unmapped"))
    known = table(spark, folder, "downloaded_urls").select(F.regexp_replace("dl_key", "^(main|thumb):", "").alias("url"))
    return rel.stale_posts(stale, "post", "unmapped", known, "url")


@query(
    "SELECT event_type, count(*) AS total, count(*) FILTER (WHERE value > 50) AS ok, count(*) FILTER (WHERE value <= 50) AS failed, round(sum(value), 2) AS amount FROM events GROUP BY event_type"
)
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("total"), F.count_if(F.col("value") > 50).alias("ok"), F.count_if(F.col("value") <= 50).alias("failed"), F.round(F.sum("value"), 2).alias("amount"))


@query("SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY md5(row_id::VARCHAR || '/7'), row_id) AS n, count(*) OVER () AS c FROM channel_posts) WHERE n <= 1000 AND n <= greatest(1, c // 10)")
def sample_capped(spark: SparkSession, folder: str) -> DataFrame:
    """The sampling operator: its cap is the feature."""
    return rel.sample(table(spark, folder, "channel_posts").select("row_id"), "row_id", 1000, seed=7)


# content


@query(
    "WITH h AS (SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents), f AS (SELECT sha256, min(doc_id) AS first_id FROM h GROUP BY sha256) SELECT doc_id, sha256, first_id::VARCHAR AS kept_path, doc_id <> first_id AS is_alias FROM h JOIN f USING (sha256)"
)
def content_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("string").alias("path"))
    return rel.content_dedup(rows, F.col("text"), ["doc_id"], "path").select("doc_id", "sha256", "kept_path", "is_alias")


@query(
    "WITH f AS (SELECT coalesce(lang, '') AS folder, coalesce(source, '') AS name, sha256(coalesce(text, '')) AS h, min(doc_id) AS first_at FROM documents GROUP BY 1, 2, 3), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY folder, name ORDER BY first_at, h) AS n FROM f) SELECT folder, name, h, name || CASE WHEN n > 1 THEN '_' || n::VARCHAR ELSE '' END AS saved_name FROM r"
)
def collision_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("folder"), F.coalesce("source", F.lit("")).alias("name"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return rel.collision_names(rows, "folder", "name", "h", ["doc_id"])


@query(
    f"WITH s AS (SELECT {clean_sql('url')} AS k, 0 AS p, 'map' AS how, relative_path AS v FROM image_map WHERE relative_path IS NOT NULL UNION ALL "
    f"SELECT {clean_sql(_SEEN_URL)}, CASE WHEN starts_with(dl_key, 'thumb:') THEN 2 ELSE 1 END, CASE WHEN starts_with(dl_key, 'thumb:') THEN 'thumb' ELSE 'main' END, dl_key FROM downloaded_urls WHERE removed_at IS NULL), "
    "b AS (SELECT k, min(struct_pack(p := p, v := v, how := how)) AS b FROM s GROUP BY k) "
    f"SELECT map_id, b.b.v AS v, coalesce(b.b.how, 'none') AS how FROM (SELECT map_id, {clean_sql('url')} AS k FROM image_map WHERE relative_path IS NULL) m LEFT JOIN b USING (k)"
)
def fallback_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Images without path: path of the same image, else its download, else its thumbnail."""
    images = table(spark, folder, "image_map").select("map_id", "relative_path", clean_url(F.col("url")).alias("k"))
    kept = table(spark, folder, "downloaded_urls").filter("removed_at is null").select(clean_url(F.regexp_replace("dl_key", "^(main|thumb):", "")).alias("k"), F.col("dl_key").alias("v"))
    thumb = F.startswith("v", F.lit("thumb:"))
    sources = [("map", images.select("k", F.col("relative_path").alias("v"))), ("main", kept.filter(~thumb)), ("thumb", kept.filter(thumb))]
    return rel.first_available(images.filter("relative_path is null").select("map_id", "k"), sources, ["k"], "v").select("map_id", "v", "how")


# matching


@query("SELECT a.o_orderkey AS l, b.o_orderkey AS r, abs(date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE))::INT AS days FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey AND abs(date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE)) <= 62")
def donor_interval(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return _donors(orders).filter("l <> r")


def _donors(orders: DataFrame) -> DataFrame:
    a, b = orders.select("o_custkey", F.col("o_orderkey").alias("l"), "o_orderdate"), orders.select("o_custkey", F.col("o_orderkey").alias("r"), "o_orderdate")
    return rel.interval_pairs(a, b, ["o_custkey"], "l", "r", "o_orderdate", "o_orderdate", 62)


@query(
    "WITH p AS (SELECT a.o_orderkey AS l, b.o_orderkey AS r, abs(date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE))::INT AS days FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey AND abs(date_diff('day', a.o_orderdate::DATE, b.o_orderdate::DATE)) <= 62) "
    "SELECT l, r, days FROM (SELECT *, row_number() OVER (PARTITION BY l ORDER BY days, r) AS n FROM p) WHERE n = 1"
)
def nearest_donor(spark: SparkSession, folder: str) -> DataFrame:
    return rel.nearest(_donors(table(spark, folder, "orders")).filter("l <> r"), "l", "r", "days")


_POSTS = (
    f"WITH raw AS (SELECT row_id, {_HOST} AS host, {_SLUG} AS slug, coalesce(published_time, '') AS p, coalesce(lastmod, '') AS m FROM (SELECT *, url AS u FROM all_posts WHERE snap_no = {LATEST})), "
    "posts AS (SELECT row_id, b.lang, slug, p, m FROM raw JOIN blogs b USING (host) WHERE slug <> ''), "
)


def _latest_posts(spark: SparkSession, folder: str) -> DataFrame:
    """row_id, lang, slug and the texts p (published) and m (last change) of all rows of the latest snapshot that are posts."""
    lang, slug = post_key(Blogs.read(table(spark, folder, "blogs")), F.col("url"))
    rows = _latest(spark, folder).select("row_id", lang.alias("lang"), slug.alias("slug"), F.coalesce("published_time", F.lit("")).alias("p"), F.coalesce("lastmod", F.lit("")).alias("m"))
    return rows.filter("lang is not null and slug <> ''")


@query(
    _POSTS + "k AS (SELECT DISTINCT lang, slug, substr(p, 1, 10) AS d, m FROM posts), ko AS (SELECT slug || '|' || d || '|' || m AS doc, * FROM k WHERE lang = 'ko'), o AS (SELECT lang || '/' || slug || '|' || d || '|' || m AS url, * FROM k WHERE lang <> 'ko'), "
    "s AS (SELECT doc, url, o.lang, 4 AS score FROM ko JOIN o ON ko.slug = o.slug UNION ALL SELECT doc, url, o.lang, 1 FROM ko JOIN o ON ko.d = o.d AND ko.m = o.m AND ko.d <> '' AND ko.m <> ''), "
    "g AS (SELECT doc, url, lang, sum(score) AS score FROM s GROUP BY ALL) SELECT doc, url, lang, score::BIGINT AS score, row_number() OVER (PARTITION BY doc ORDER BY score DESC, lang, url)::INT AS rank FROM g"
)
def candidate_score_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Posts of other languages that share the slug, or the day and the last change, with a Korean one, ranked; days are the first ten characters of the published time."""
    posts = _latest_posts(spark, folder).select("lang", "slug", F.substring("p", 1, 10).alias("day"), F.col("m").alias("lastmod"), F.lit("").alias("category")).distinct()
    name = F.concat_ws("|", "slug", "day", "lastmod")
    ko = posts.filter("lang = 'ko'").withColumn("doc", name)
    others = posts.filter("lang <> 'ko'").withColumn("url", F.concat("lang", F.lit("/"), name))
    none = spark.createDataFrame([], "category string, lang string, expected string")
    return fallbacks.language_candidates(ko, others, none, {})


def _day(ms: str) -> Column:
    """Day of the instant in the zone of the channel."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(CHANNEL_ZONE), F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {ms} div 1000)"))
    return F.date_format(local, "yyyy-MM-dd")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """A row per post of the latest snapshot, with the instants (null if there are none) of the row that was loaded last."""
    blogs = Blogs.read(table(spark, folder, "blogs"))
    lang, slug = post_key(blogs, F.col("url"))
    rows = _latest(spark, folder).select("row_id", "url", "lastmod", "published_time", "loaded_at", lang.alias("lang"), slug.alias("slug")).filter("lang is not null and slug <> ''")
    last = rows.groupBy("lang", "slug").agg(F.max(F.struct("loaded_at", "row_id", "url", "lastmod", "published_time")).alias("r")).select("lang", "slug", "r.row_id", "r.url", "r.lastmod", "r.published_time")
    return post_instants(post_instants(last, blogs, "published_time", "published_ms"), blogs, "lastmod", "lastmod_ms").select("lang", "slug", "row_id", "published_ms", "lastmod_ms")


@query(None)
def channel_title_match(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of the day of a channel post with the most similar title; the ratio has no form in SQL.

    Posts without a published time are of the day that their page shows, channel
    posts without one of the time they are sorted by.
    """
    blogs = Blogs.read(table(spark, folder, "blogs"))
    channel = channel_instants(table(spark, folder, "channel_posts"), "ms").withColumn("ms", F.coalesce("ms", F.expr("sort div 10")))
    channel = channel.filter("title is not null and ms is not null").select("row_id", "title", _day("ms").alias("d"))
    lang, slug = post_key(blogs, F.col("post_url"))
    headline, shown = shown_headline_and_date("html")
    html = table(spark, folder, "html").select(F.col("page_id").cast("string").alias("doc"), F.col("post_url").alias("url"), "html", lang.alias("lang"), slug.alias("slug")).filter("lang is not null and slug <> ''")
    titles = docs.page_meta(docs.node_table(html, "doc", "html"), ()).select("doc", F.nullif("title", F.lit("")).alias("title"))
    # text dumps have their headline above the date
    pages = html.select("doc", "url", "lang", "slug", headline.alias("headline"), shown.alias("shown")).join(titles, "doc", "left")
    pages = checkpoint(pages.select("url", "lang", "slug", F.coalesce("title", "headline").alias("page_title"), "shown").filter("page_title is not null"))
    lang, slug = post_key(blogs, F.col("url"))
    posts = table(spark, folder, "all_posts").select("url", "published_time", lang.alias("lang"), slug.alias("slug")).filter("lang is not null and slug <> ''")
    listed = posts.groupBy("lang", "slug").agg(F.min("url").alias("url"), F.collect_set(F.nullif("published_time", F.lit(""))).alias("times"))
    listed = checkpoint(listed)
    published = post_instants(listed.select("lang", "slug", "url", F.explode("times").alias("value")), blogs, "value", "ms").filter("ms is not null").select("lang", "slug", _day("ms").alias("d")).distinct()
    dated = pages.filter("shown is not null").join(listed.select("lang", "slug"), ["lang", "slug"], "left_semi").join(published, ["lang", "slug"], "left_anti")
    dated = post_instants(dated, blogs, "shown", "ms").filter("ms is not null").select("lang", "slug", _day("ms").alias("d")).distinct()
    titled = pages.groupBy("lang", "slug", "page_title").agg(F.min("url").alias("url")).join(published.unionByName(dated), ["lang", "slug"]).select("d", "page_title", F.xxhash64("url").alias("page"))
    return rel.best_title(channel, titled, ["d"], "row_id", "title", "page", "page_title", 0.55)


@query("SELECT b.host, min(d.doc_id) AS doc_id FROM blogs b JOIN documents d ON contains(lower(d.text), lower(b.host)) GROUP BY b.host")
def substring_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first document that names each blog; blogs is a fixed dimension of a row per language."""
    return rel.first_containing(F.broadcast(table(spark, folder, "blogs").select("host")), "host", table(spark, folder, "documents"), "text", "doc_id")


@query(
    "SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading FROM events"
)
def previous_heading(spark: SparkSession, folder: str) -> DataFrame:
    return rel.previous_marked(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", "event_id", "heading").select("event_id", "heading")


@query(
    "WITH s AS (SELECT event_id, user_id, ts, sum((event_type = 'signup')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS section FROM events) "
    "SELECT event_id, section::BIGINT AS section, row_number() OVER (PARTITION BY user_id, section ORDER BY ts, event_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id, section) AS total FROM s"
)
def section_positions(spark: SparkSession, folder: str) -> DataFrame:
    numbered = rel.sections(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup")
    return numbered.select("event_id", "section", F.col("pos").cast("bigint").alias("pos"), "total")


@query(
    "WITH d AS (SELECT *, CAST(row_number() OVER (PARTITION BY coalesce(lang, '') ORDER BY length(text) DESC NULLS LAST, doc_id) AS INT) AS rank FROM documents) SELECT coalesce(lang, '') AS lang, doc_id, rank FROM d WHERE rank <= 3"
)
def top_per_group(spark: SparkSession, folder: str) -> DataFrame:
    """The three longest documents of each language: a top-k report."""
    rows = table(spark, folder, "documents").select(F.coalesce("lang", F.lit("")).alias("lang"), "doc_id", F.length("text").alias("n"))
    return rel.ranked(rows, ["lang"], [F.desc_nulls_last("n"), F.col("doc_id")]).filter("rank <= 3").drop("n")


_SUFFIX_SQL = "lower(regexp_extract(" + PATH_SQL.format(url="url") + ", '[^/.][^/]*?(\\.[^./]+)$', 1))"


@query(
    f"SELECT map_id, {_SUFFIX_SQL} IN ('.png', '.jpg', '.jpeg', '.gif', '.webp', '.bmp', '.svg') AS image, {_SUFFIX_SQL} IN ('.zip', '.rar', '.7z', '.tar', '.gz', '.tgz') AS archive FROM image_map"
)
def accepted_by_extension(spark: SparkSession, folder: str) -> DataFrame:
    """Which addresses count as images and as archives when the response says no more than text."""
    will = lambda ext, archives: fallbacks.acceptable(F.lit("text/plain"), F.col("url"), F.lit(1), Config(), F.lit(ext), F.lit(archives))
    return table(spark, folder, "image_map").select("map_id", will(True, False).alias("image"), will(False, True).alias("archive"))


@query(
    f"SELECT substr(published_time, 1, 10) AS day, b.lang, count(DISTINCT url) AS n FROM (SELECT url, published_time, {_HOST} AS host FROM (SELECT *, url AS u FROM all_posts)) JOIN blogs b USING (host) WHERE published_time <> '' GROUP BY ALL"
)
def date_index_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts per day and language, by the first ten characters of their published time."""
    lang, _ = post_key(Blogs.read(table(spark, folder, "blogs")), F.col("url"))
    posts = table(spark, folder, "all_posts").select("url", lang.alias("lang"), "published_time").filter("lang is not null")
    return fallbacks.date_index(posts).groupBy("day", "lang").agg(F.count("*").alias("n"))


@query(
    "WITH r AS (SELECT dl_key, strftime(downloaded_at, '%Y%m%d%H%M%S') AS timestamp, CASE WHEN removed_at IS NULL THEN '200' ELSE '404' END AS status, row_number() OVER (PARTITION BY dl_key ORDER BY dl_id) - 1 AS pos FROM downloaded_urls) "
    "SELECT dl_key, arg_min(timestamp, pos) AS timestamp FROM r WHERE status = '200' AND pos < 5 GROUP BY dl_key"
)
def oldest_good(spark: SparkSession, folder: str) -> DataFrame:
    """The first good one among the first five snapshots of each address, downloads standing for snapshots."""
    rows = table(spark, folder, "downloaded_urls").select("dl_key", "dl_id", F.col("dl_key").alias("original"), F.date_format("downloaded_at", "yyyyMMddHHmmss").alias("timestamp"), F.when(F.col("removed_at").isNull(), "200").otherwise("404").alias("status"))
    placed = rows.withColumn("pos", F.row_number().over(W.partitionBy("dl_key").orderBy("dl_id")) - 1)
    return ledgers.oldest_snapshots(placed, ["dl_key"]).select("dl_key", "timestamp")


@query(
    "SELECT md5(url) AS sha256, arg_max(relative_path, map_id) AS relative_path, bool_or(url LIKE '%/size/%') AS is_thumb FROM image_map WHERE relative_path IS NOT NULL GROUP BY 1"
)
def hash_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The last path of each hash, and whether any of its rows is a thumbnail's."""
    rows = table(spark, folder, "image_map").filter("relative_path is not null")
    return ledgers.hash_entries(rows.select(F.md5("url").alias("sha256"), "relative_path", F.when(F.contains("url", F.lit("/size/")), "T").otherwise("").alias("is_thumb"), F.col("map_id").alias("_seq")))


# documents


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "html").select(F.col("page_id").cast("string").alias("id"), "post_url", "html")
    return docs.node_table(pages, "id", "html")


_H1 = "trim(regexp_replace(regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's'), '<[^>]*>', '', 'g'))"


@query(
    f"SELECT page_id::VARCHAR AS doc, replace(replace(replace(replace({_H1}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&') AS title FROM html WHERE regexp_matches(html, '<(h[1-6]|meta|title|img|a|strong)\\b')"
)
def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of all pages with markup."""
    return docs.page_meta(_nodes(spark, folder), Config().categories).select("doc", "title")


@query(
    "SELECT page_id::VARCHAR AS doc, count(*) AS n_links FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]+)\"', 1)) AS href FROM html) GROUP BY 1"
)
def out_degree(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, folder).filter("tag = 'a' and coalesce(attrs['href'], '') <> ''").groupBy("doc").agg(F.count("*").alias("n_links"))


@query(
    "WITH i AS (SELECT page_id, generate_subscripts(l, 1) AS pos, unnest(l) AS src FROM (SELECT page_id, regexp_extract_all(html, '<img src=\"([^\"]+)\"', 1) AS l FROM html)) SELECT page_id::VARCHAR AS doc, pos, src FROM i"
)
def image_positions(spark: SparkSession, folder: str) -> DataFrame:
    images = _nodes(spark, folder).filter("tag = 'img'").select("doc", "ord", F.col("attrs")["src"].alias("src"))
    return images.select("doc", F.row_number().over(W.partitionBy("doc").orderBy("ord")).cast("bigint").alias("pos"), "src")


def _site(spark: SparkSession, folder: str) -> Config:
    """Settings with the hosts of the blogs table, a fixed dimension."""
    hosts = tuple(sorted(Blogs.read(table(spark, folder, "blogs")).lang))
    return Config(blog_host=hosts[0] if hosts else "", image_hosts=hosts)


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """The last saved page of each post, whatever the spelling of its address (lang and slug are null for other pages): post_url is the least of them."""
    lang, slug = post_key(Blogs.read(table(spark, folder, "blogs")), F.col("post_url"))
    pages = table(spark, folder, "html").filter("post_url is not null").select("page_id", "fetched_at", "html", F.trim("post_url").alias("post_url"), lang.alias("lang"), F.when(lang.isNotNull(), F.nullif(slug, F.lit(""))).alias("slug"))
    pages = pages.withColumn("key", F.when(F.col("slug").isNotNull(), F.concat_ws("/", "lang", "slug")).otherwise(F.col("post_url")))
    last = pages.groupBy("key").agg(F.max(F.struct("fetched_at", "page_id")).getField("page_id").alias("page_id"), F.min("post_url").alias("post_url"))
    # the text isn't part of the aggregation: it is joined to the pages that count
    html = pages.select("key", "page_id", "lang", "slug", "html")
    return last.join(html, ["key", "page_id"]).groupBy("post_url", "lang", "slug").agg(F.min("html").alias("html"))


@query(None)
def page_images(spark: SparkSession, folder: str) -> DataFrame:
    """Images that each page offers, in order; addresses are resolved, which has no form in SQL."""
    return docs.image_items(docs.node_table(_pages(spark, folder), "post_url", "html"), _site(spark, folder))


@query(None)
def page_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Headings of each page in order."""
    return docs.heading_texts(docs.node_table(_pages(spark, folder), "post_url", "html"))


def _described(spark: SparkSession, folder: str) -> DataFrame:
    pages = checkpoint(_pages(spark, folder))
    meta = docs.page_meta(docs.node_table(pages, "post_url", "html"), Config().categories).withColumnRenamed("doc", "post_url")
    kind = F.substring_index(names.url_slug(F.col("post_url")), "-", 1)
    lang, slug = post_key(Blogs.read(table(spark, folder, "blogs")), F.col("url"))
    day = table(spark, folder, "all_posts").select(lang.alias("lang"), slug.alias("slug"), F.substring("published_time", 1, 10).alias("date")).groupBy("lang", "slug").agg(F.max("date").alias("date"))
    return pages.join(meta.drop("category"), "post_url", "left").join(day, ["lang", "slug"], "left").withColumns({"category": kind, "title": F.coalesce("title", F.lit(""))})


def _images_by_url(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "image_map").filter("relative_path is not null").select("map_id", clean_url(F.col("url")).alias("clean_url"), "relative_path")
    return rel.last_wins(rows, ["clean_url"], ["map_id"], "relative_path")


@query(None)
def markdown_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page in Markdown, with local images."""
    return render.markdown(_described(spark, folder), "post_url", "html", "title", "date", "category", _images_by_url(spark, folder))


@query(None)
def localised_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page for offline reading, with the images that have no local path."""
    pages = _described(spark, folder)
    targets = pages.select(F.col("post_url").alias("page_url"), F.concat("category", F.lit("/"), names.url_slug(F.col("post_url")), F.lit(".html")).alias("path"))
    none = spark.createDataFrame([], "post_url string, media_url string, relative_path string, anchor_type string, anchor_text string")
    return render.localised(pages, "post_url", "html", "category", _images_by_url(spark, folder), none, targets, none, _site(spark, folder))


@query(None)
def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing pages of all posts and of each category."""
    posts = _described(spark, folder).select("title", names.url_slug(F.col("post_url")).alias("link"), F.col("og_image").alias("image"), F.coalesce("date", F.lit("")).alias("date"), "category")
    return render.listing(posts, "<html><body><p>{count}</p>\n{posts}\n</body></html>")


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    """(src, dst) of links between posts, by language and slug, from all pages in any spelling."""
    blogs = Blogs.read(table(spark, folder, "blogs"))
    pages = table(spark, folder, "html").select(F.trim("post_url").alias("post_url"), "html").filter("post_url is not null")
    links = docs.page_links(docs.node_table(pages, "post_url", "html"))
    post = lambda url: F.concat_ws("/", *[F.nullif(c, F.lit("")) for c in post_key(blogs, url)])
    links = links.filter(~render.first_segment(F.col("url")).isin(*Config().excluded_paths))
    return links.select(post(F.col("doc")).alias("src"), post(F.col("url")).alias("dst")).filter("src like '%/%' and dst like '%/%'")


@query(
    f"WITH h AS (SELECT {_HOST} AS host, {_SLUG} AS slug, html FROM (SELECT html, post_url AS u FROM html)), "
    "l AS (SELECT host, slug, unnest(regexp_extract_all(html, '<a [^>]*href=\"(/[^\"]*)\"', 1)) AS u FROM h), "
    f"e AS (SELECT DISTINCT b.lang || '/' || slug AS s, b.lang || '/' || {_SLUG} AS t FROM l JOIN blogs b USING (host) WHERE slug <> '' AND NOT regexp_matches(u, '^/+(tag|author|rss|assets|content|public)(/|$)') AND {_SLUG} <> ''), "
    "a AS (SELECT DISTINCT s FROM e WHERE contains(s, '/maintenance')), l1 AS (SELECT DISTINCT t FROM e JOIN a USING (s)), l2 AS (SELECT DISTINCT e.t FROM e JOIN l1 ON e.s = l1.t) "
    "SELECT t AS slug, min(h) AS hops FROM (SELECT t, 1 AS h FROM l1 UNION ALL SELECT t, 2 FROM l2) GROUP BY t"
)
def two_hop_reach(spark: SparkSession, folder: str) -> DataFrame:
    edges = checkpoint(_edges(spark, folder))
    start = edges.filter("contains(src, '/maintenance')").select(F.col("src").alias("slug"))
    return rel.reachable(edges, "src", "dst", start, "slug")


@query(
    _POSTS + "c AS (SELECT lang || '/' || split_part(slug, '-', 1) AS category, p, row_id FROM posts), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY p DESC, row_id) AS place FROM c) "
    "SELECT category, (place - 1) // 20 + 1 AS page_no, string_agg(row_id::VARCHAR, ',' ORDER BY place) AS posts FROM r GROUP BY 1, 2"
)
def category_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the pages of a listing by language and category, in the order of the published texts, 20 a page."""
    rows = _latest_posts(spark, folder).select(F.concat_ws("/", "lang", F.substring_index("slug", "-", 1)).alias("category"), "p", "row_id")
    placed = rel.paged(rows, "category", [F.desc("p"), F.col("row_id")], 20)
    ids: Column = F.transform(F.array_sort(F.collect_list(F.struct("place", "row_id"))), lambda x: x.row_id.cast("string"))
    return placed.groupBy("category", "page_no").agg(F.array_join(ids, ",").alias("posts"))


@query(None)
def category_pages(spark: SparkSession, folder: str) -> DataFrame:
    """category_listing with a row per post and by instants, newest first and unknown ones last; it has no SQL, as that can't read the times."""
    rows = _listed(spark, folder).withColumn("of", F.concat_ws("/", "lang", F.substring_index("slug", "-", 1)))
    placed = rel.paged(rows, "of", [F.desc_nulls_last("published_ms"), F.col("row_id")], 20)
    ids: Column = F.transform(F.array_sort(F.collect_list(F.struct("place", "row_id"))), lambda x: x.row_id.cast("string"))
    pages = placed.groupBy("of", "page_no").agg(F.array_join(ids, ",").alias("posts"))
    return pages.select(F.substring_index("of", "/", 1).alias("lang"), F.expr("substr(of, instr(of, '/') + 1)").alias("category"), "page_no", "posts")


@query("SELECT c_custkey, '\"' || replace(c_name || ', \"' || c_mktsegment || '\"', '\"', '\"\"') || '\",' || c_custkey::VARCHAR AS line FROM customer")
def csv_lines(spark: SparkSession, folder: str) -> DataFrame:
    quoted = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"')).alias("name")
    return table(spark, folder, "customer").select("c_custkey", F.to_csv(F.struct(quoted, "c_custkey"), {"escape": '"'}).alias("line"))
