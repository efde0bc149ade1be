"""The archive's stages over tables, in order: html, images, media, md, html-local.

Network results arrive as tables; each stage is a function of tables and gives
tables. A stage keeps ledgers by anti-join, so a rerun does what is pending.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.config import Config
from folioforge.functions import names
from folioforge.functions.url import clean_url
from folioforge.operators import documents as docs
from folioforge.operators import fallbacks, recovery, render
from folioforge.operators import relations as rel

ORDER = ("html", "images", "media", "md", "html-local")


@dataclass
class Stages:
    """Tables in and out of a run.

    posts: url, lastmod, published_time. fetches: url, status, final_url,
    content_type, content_disposition, content. Earlier results may be given as
    done (stage, post_url).

    archive (url, payload, final_url, content_type, size) and from_post (doc,
    and the same) are what the archive has, payload being the address in fetches
    of the content. earlier: the image map of former runs. With `retry`, images
    that no fetch gives are looked for under like headings of posts of
    `retry_category`.
    """

    posts: DataFrame
    fetches: DataFrame
    config: Config = field(default_factory=Config)
    done: DataFrame | None = None
    force: bool = False
    archive: DataFrame | None = None
    from_post: DataFrame | None = None
    earlier: DataFrame | None = None
    assets: DataFrame | None = None
    retry: bool = False
    retry_category: str = "Notice"
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def run(self, selected: tuple[str, ...] = ORDER) -> dict[str, DataFrame]:
        if unknown := set(selected) - set(ORDER):
            raise ValueError(f"unknown stages: {sorted(unknown)}")
        for stage in ORDER:
            if stage in selected:
                getattr(self, "_" + stage.replace("-", "_"))()
        return self.tables

    def _todo(self, stage: str) -> DataFrame:
        rows = self.posts.withColumnRenamed("url", "post_url")
        if self.force or self.done is None:
            return rows
        return rel.pending(rows, self.done.filter(F.col("stage") == stage), ["post_url"])

    def _html(self) -> None:
        """Saved pages, and failures with their reason."""
        todo = self._todo("html")
        got = todo.join(self.fetches.withColumnRenamed("url", "post_url"), "post_url", "left")
        kind = F.lower(F.coalesce("content_type", F.lit("")))
        reason = F.when(F.col("status").isNull(), "fetch_failed").when(~F.col("status").between(200, 299), F.concat(F.lit("http_"), F.col("status").cast("string"))).when(~F.contains(kind, F.lit("text/html")), F.concat(F.lit("unexpected_content_type:"), kind))
        told = got.withColumn("reason", reason)
        self.tables["failed_html"] = told.filter("reason is not null").select("post_url", "reason")
        pages = told.filter("reason is null").select("post_url", "lastmod", "published_time", F.col("content").cast("string").alias("html"))
        meta = docs.page_meta(docs.node_table(pages, "post_url", "html"), self.config.categories).withColumnRenamed("doc", "post_url")
        filled = pages.join(meta, "post_url", "left").withColumn("published_time", F.coalesce(F.nullif("published_time", F.lit("")), "published", F.lit("")))
        self.tables["pages"] = filled.withColumns({"date": F.coalesce(F.nullif(F.substring("published_time", 1, 10), F.lit("")), "lastmod"), "slug": names.url_slug(F.col("post_url"))})

    def _nodes(self) -> DataFrame:
        return docs.node_table(self.tables["pages"], "post_url", "html")

    def _responses(self) -> DataFrame:
        """Good responses, by address, without their content."""
        good = self.fetches.filter(F.col("status").between(200, 299))
        return good.select("url", F.col("url").alias("payload"), "final_url", "content_type", F.octet_length("content").alias("size"))

    def _with_content(self, chained: DataFrame) -> DataFrame:
        content = self.fetches.select(F.col("url").alias("payload"), "content", "content_disposition")
        return chained.join(content, "payload", "left").withColumn("ok", F.col("how").isNotNull() & F.col("content").isNotNull())

    def _images(self) -> None:
        """Image map, failures and counts; equal content is kept once, later URLs are aliases."""
        spark = self.posts.sparkSession
        nodes = self._nodes()
        pages = self.tables["pages"].select(F.col("post_url").alias("doc"), "date", "category")
        items = docs.image_items(nodes, self.config)
        sound = docs.non_image_urls(nodes, self.config).select("doc", "url")
        items = items.join(sound, ["doc", "url"], "left_anti").join(pages, "doc")
        # an override leads to the path of its target, or to its target's address
        earlier = self.earlier if self.earlier is not None else spark.createDataFrame([], "clean_url string, relative_path string")
        overrides = spark.createDataFrame(sorted(self.config.image_overrides.items()), "url string, target string")
        over = fallbacks.overridden(items, overrides, earlier).select("doc", "url", "target", "relative_path").distinct()
        items = items.join(over, ["doc", "url"], "left").withColumns({"own_url": F.col("url"), "url": F.coalesce("target", "url")})
        mapped = items.filter("relative_path is not null").select(F.col("own_url").alias("clean_url"), "relative_path")
        items = items.filter("relative_path is null").drop("relative_path", "target")
        none = "url string, payload string, final_url string, content_type string, size int"
        archive = self.archive if self.archive is not None else spark.createDataFrame([], none)
        from_post = self.from_post if self.from_post is not None else spark.createDataFrame([], "doc string, " + none)
        chained = fallbacks.download_chain(items, self._responses(), archive, from_post, self.config)
        got = self._with_content(items.join(chained.drop("kind").distinct(), ["doc", "url"]))
        failed = got.filter(~F.col("ok"))
        found = spark.createDataFrame([], "clean_url string, relative_path string")
        if self.retry:
            asked = fallbacks.by_heading(failed, self.retry_category, self.retry).select("doc", "url").distinct()
            donors = recovery.donor_images(asked, docs.section_images(nodes), pages.withColumnRenamed("date", "day"), self.config.donor_days, self.config.heading_similarity)
            found = donors.join(earlier.withColumnRenamed("clean_url", "donor_url"), "donor_url").groupBy(F.col("url").alias("clean_url")).agg(F.min("relative_path").alias("relative_path"))
            failed = failed.join(found.select(F.col("clean_url").alias("url")), "url", "left_anti")
        self.tables["failed_images"] = failed.select(F.col("doc").alias("post_url"), F.col("own_url").alias("img_url"), F.lit("download_failed").alias("reason")).distinct()
        exts = (*self.config.image_exts, *self.config.archive_exts)
        name = names.safe_filename(names.image_filename(F.col("kind"), F.col("url"), F.coalesce("final_url", "url"), F.coalesce("content_type", F.lit("")), F.coalesce("content_disposition", F.lit("")), F.col("idx"), exts))
        folder = F.concat_ws("/", F.lit("images"), F.coalesce(F.nullif("category", F.lit("")), F.lit("etc")), names.date_folder(F.col("date")))
        saved = got.filter("ok").select("doc", "idx", F.col("own_url").alias("url"), "kind", folder.alias("folder"), name.alias("name"), F.sha2("content", 256).alias("sha256"))
        named = rel.collision_names(saved, "folder", "name", "sha256", ["doc", "idx"])
        stemmed = F.concat(names.stem(F.col("name")), F.regexp_extract("saved_name", r"(_\d+)$", 1), names.suffix(F.col("name")))
        paths = saved.join(named, ["folder", "name", "sha256"]).withColumn("path", F.concat_ws("/", "folder", F.when(F.col("saved_name") == F.col("name"), F.col("name")).otherwise(stemmed)))
        first = paths.groupBy("sha256").agg(F.min(F.struct("doc", "idx", "path")).alias("f")).select("sha256", F.col("f.path").alias("relative_path"))
        kept = paths.join(first, "sha256")
        every = kept.select(F.col("url").alias("clean_url"), "relative_path").unionByName(mapped).unionByName(found)
        self.tables["image_map"] = every.groupBy("clean_url").agg(F.min("relative_path").alias("relative_path"))
        self.tables["image_hashes"] = kept.groupBy("sha256").agg(F.min("relative_path").alias("relative_path"), F.bool_and(F.col("kind") == "og_image").alias("is_thumb"))
        self.tables["image_metrics"] = got.agg(F.count("*").alias("items"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"))

    def _media(self) -> None:
        """Media map and failures."""
        items = docs.media_items(self._nodes(), self.config)
        none = "url string, payload string, content_type string, size int"
        archive = self.archive if self.archive is not None else self.posts.sparkSession.createDataFrame([], none)
        forum = self.posts.sparkSession.createDataFrame([], none)
        chained = fallbacks.media_chain(items, self._responses(), archive.select("url", "payload", "content_type", "size"), forum)
        got = self._with_content(items.join(chained.distinct(), ["doc", "url"]))
        exts = (*self.config.video_exts, *self.config.audio_exts)
        name = names.safe_filename(names.media_filename(F.col("url"), F.coalesce("content_type", F.lit("")), F.coalesce("content_disposition", F.lit("")), exts))
        self.tables["media_map"] = got.filter("ok").select(F.col("doc").alias("post_url"), F.col("url").alias("media_url"), F.concat(F.lit("media/"), name).alias("relative_path"), F.lit("inline").alias("anchor_type"), F.lit("").alias("anchor_text"))
        self.tables["failed_media"] = got.filter(~F.col("ok")).select(F.col("doc").alias("post_url"), F.col("url").alias("media_url"), F.lit("download_failed").alias("reason")).distinct()

    def _image_map(self) -> DataFrame:
        empty = self.posts.sparkSession.createDataFrame([], "clean_url string, relative_path string")
        return self.tables.get("image_map", empty)

    def _md(self) -> None:
        self.tables["markdown"] = render.markdown(self.tables["pages"], "post_url", "html", "title", "date", "category", self._image_map())

    def _html_local(self) -> None:
        """Localised pages, the ledger of unmapped images, and listing pages."""
        spark = self.posts.sparkSession
        pages = self.tables["pages"]
        file = F.concat(F.when(F.col("category") != "", F.concat("category", F.lit("/"))).otherwise(""), "slug", F.lit(".html"))
        targets = pages.select(F.col("post_url").alias("page_url"), file.alias("path"))
        media = self.tables.get("media_map", spark.createDataFrame([], "post_url string, media_url string, relative_path string, anchor_type string, anchor_text string"))
        lookup = fallbacks.remote_first(media, self.config)
        out = render.localised(pages, "post_url", "html", "category", self._image_map(), lookup, targets, media.filter("anchor_type <> 'inline'"), self.config, self.assets)
        self.tables["html_local"] = out.select("post_url", "html")
        self.tables["stale_html_local"] = out.filter(F.size("unmapped") > 0).select("post_url", "unmapped")
        image = pages.join(self._image_map(), clean_url(F.col("og_image")) == F.col("clean_url"), "left")
        cards = image.select("title", F.col("slug").alias("link"), F.coalesce("relative_path", "og_image").alias("image"), F.coalesce("date", F.lit("")).alias("date"), "category")
        self.tables["listings"] = render.listing(cards, "<html><body><p>{count}</p>\n{posts}\n</body></html>")
