"""Variants of the test tables: without rows, with nulls everywhere, with columns of clashing names."""

from pathlib import Path

from pyspark.sql import functions as F

TABLES = "all_posts channel_posts image_map downloaded_urls done_html html documents eval_items mix_targets blogs".split()
CLASHING = ["lang", "slug", "snap_no", "change", "id", "text", "key", "doc", "value", "utc_ms", "post", "weight", "host", "n", "at", "copies", "template", "restored", "__t", "__k", "_seq"]


def write(spark, source: Path, target: Path, kind: str) -> str:
    for name in TABLES:
        df = spark.read.parquet(f"{source}/{name}.parquet")
        if kind == "empty":
            df = df.limit(0)
        elif kind == "nulls":
            # one row more per column with a null there, one of nulls only, and all of the first rows twice
            first = df.limit(1).cache()
            for c in df.columns:
                df = df.unionByName(first.withColumn(c, F.lit(None).cast(df.schema[c].dataType)))
            df = df.unionByName(first.select([F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])).unionByName(first)
        else:
            df = df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})
        df.coalesce(1).write.mode("overwrite").parquet(f"{target}/{name}.parquet")
    return str(target)
