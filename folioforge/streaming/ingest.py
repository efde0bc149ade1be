"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioforge.operators.relations import stale_posts


def new_files(spark: SparkSession, folder: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """Rows of Parquet files as they arrive in a folder; what was read is kept in the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def first_by_key(rows: DataFrame, key: Column, event_time: str, delay: str) -> DataFrame:
    """The first row of each key; a repeat within `delay` of event time is dropped, and state older than that is given up."""
    return rows.withColumn("__key", key).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["__key"]).drop("__key")


def window_counts(rows: DataFrame, event_time: str, width: str, delay: str, keys: list[str], slide: str | None = None) -> DataFrame:
    """Rows per window and key; rows later than `delay` are left out, windows are final once they close."""
    window = F.window(event_time, width, slide) if slide else F.window(event_time, width)
    counted = rows.withWatermark(event_time, delay).groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), *keys, "n")


def session_counts(rows: DataFrame, event_time: str, gap: str, delay: str, keys: list[str]) -> DataFrame:
    """Rows per session of each key, a session ending with a gap."""
    counted = rows.withWatermark(event_time, delay).groupBy(F.session_window(event_time, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")


def run_once(rows: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None] | None = None, table: str | None = None, mode: str = "append") -> StreamingQuery:
    """All that has arrived, then stop: each batch to `handle`, or into an in-memory table for tests."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode)
    query = writer.foreachBatch(handle).start() if handle else writer.format("memory").queryName(table).start()
    query.awaitTermination()
    return query


def refresh(batch: DataFrame, stale: DataFrame, post: str, unmapped: str, key: str) -> DataFrame:
    """Posts of the stale ledger that new keys make ready to be written again."""
    return stale_posts(stale, post, unmapped, batch, key)
