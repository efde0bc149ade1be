"""Writers of ledgers, reports and text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.relations import collision_names


def csv_line(*fields: Column) -> Column:
    """One CSV line; fields with a comma, quote or break are quoted, quotes doubled."""
    return F.to_csv(F.struct(*[f.cast("string").alias(f"c{n}") for n, f in enumerate(fields)]), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""})


def write_ledger(rows: DataFrame, path: str, order: list[Column] | None = None, mode: str = "overwrite", mark: bool = False) -> None:
    """Ledger as CSV files with a header each, which readers know as such wherever it stands.

    A sorted one is sorted by many tasks: its files, in the order of their
    names, hold the rows in order. mark: files start with a byte order mark.
    """
    out = rows.orderBy(*order) if order else rows
    if mark:
        out = out.withColumnRenamed(rows.columns[0], "\ufeff" + rows.columns[0])
    out.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def report(recovered: list[DataFrame]) -> DataFrame:
    """Recovered items of several logs in report order."""
    union = recovered[0]
    for r in recovered[1:]:
        union = union.unionByName(r)
    return union.orderBy("post_url", "fallback_type", "saved_path")


def write_published_index(days: DataFrame, categories: DataFrame, path: str) -> None:
    """Published index as lines of JSON: a row per day with its posts, the categories, and the number of posts per language."""
    days.groupBy("day").agg(F.array_sort(F.collect_set(F.struct("url", "lang"))).alias("entries")).write.mode("overwrite").json(f"{path}/days")
    categories.select("url", "category").write.mode("overwrite").json(f"{path}/categories")
    days.groupBy("lang").agg(F.count_distinct("url").alias("n")).write.mode("overwrite").json(f"{path}/meta")


def named_texts(rows: DataFrame, folder: str, name: str, text: str, order: list[str]) -> DataFrame:
    """folder, file, text of distinct contents: equal content shares a file, another of the same name gets _2, _3, ..."""
    hashed = rows.withColumn("__h", F.sha2(text, 256))
    names = collision_names(hashed, folder, name, "__h", order)
    content = hashed.groupBy(folder, name, "__h").agg(F.first(text).alias(text))
    return names.join(content, [folder, name, "__h"]).select(folder, F.col("saved_name").alias("file"), text)


def write_texts(named: DataFrame, folder: str, text: str, path: str) -> None:
    """Texts as lines of JSON below a folder per category, each with its file name."""
    named.select(F.coalesce(F.nullif(folder, F.lit("")), F.lit("uncategorised")).alias("category"), "file", F.col(text).alias("text")).write.mode("overwrite").partitionBy("category").json(path)
