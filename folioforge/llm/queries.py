"""Queries of the problems on training text, with their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import boilerplate, leakage, mixing, mojibake
from folioforge.sources.tables import table


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of saved pages, and excerpts, that are site furniture."""
    return boilerplate.page_furniture(table(spark, folder, "html"), "page_id", "html", "excerpt", "post_url")


def p5_main(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of saved pages."""
    return boilerplate.main_text(table(spark, folder, "html"), "page_id", "html", "post_url")


def p6_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the test items that they contain a passage of, and its length."""
    return leakage.leaked_items(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_leaks(spark, folder).drop("n_tokens")


def mix(spark: SparkSession, folder: str) -> mixing.Mix:
    return mixing.Mix(table(spark, folder, "documents"), "doc_id", "source", "text", table(spark, folder, "mix_targets"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix: a row per copy of a document."""
    return mix(spark, folder).rows()


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of each source."""
    return mix(spark, folder).shares()


def p8_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Garbled documents with the original text."""
    return mojibake.garbled(table(spark, folder, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_repaired(spark, folder).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p5_found, p5_main, p6_found, p6_leaks, p7_mix, p7_shares, p8_found, p8_repaired)}


def oracle_sql() -> dict[str, str]:
    return {}
