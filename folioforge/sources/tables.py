"""Parquet tables of a folder, and the small dimension of blogs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: blogs is configuration: a row per language. More rows than this are refused, so the literal maps below stay small.
MAX_BLOGS = 2_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of `folder`, one Parquet file or folder per table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


@dataclass(frozen=True)
class Blogs:
    """The blogs table as literal maps keyed by bare host."""

    lang: dict[str, str]
    tz: dict[str, str]
    order: dict[str, str]

    @staticmethod
    def read(blogs: DataFrame) -> "Blogs":
        rows = blogs.select("lang", "host", "tz", "date_order").limit(MAX_BLOGS + 1).collect()
        if len(rows) > MAX_BLOGS:
            raise ValueError(f"blogs has more than {MAX_BLOGS} rows; it is meant to be a small dimension")
        rows = [r for r in rows if r["host"]]
        bare = [r["host"].strip().lower().removeprefix("www.") for r in rows]
        return Blogs(
            {h: r["lang"] for h, r in zip(bare, rows) if r["lang"]},
            {h: r["tz"] for h, r in zip(bare, rows) if r["tz"]},
            {h: r["date_order"] for h, r in zip(bare, rows) if r["date_order"]},
        )

    @staticmethod
    def _lookup(values: dict[str, str], host: Column) -> Column:
        if not values:
            return F.lit(None).cast("string")
        pairs = [F.lit(x) for kv in sorted(values.items()) for x in kv]
        return F.try_element_at(F.create_map(*pairs), host)

    def lang_of(self, host: Column) -> Column:
        return self._lookup(self.lang, host)

    def tz_of(self, host: Column) -> Column:
        return self._lookup(self.tz, host)

    def order_of(self, host: Column) -> Column:
        return self._lookup(self.order, host)
