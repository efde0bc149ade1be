"""All queries outside the llm subpackage, with their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.plans import announcements, archive, problems

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    named = {
        "p1_found": problems.p1_found,
        "p2_found": problems.p2_found,
        "p3_found": announcements.p3_found,
        "p3_matches": announcements.p3_matches,
        "p4_found": problems.p4_found,
        "p4_periods": problems.p4_periods,
    }
    return named | archive.QUERIES


def oracle_sql() -> dict[str, str]:
    """p1 to p3 have none: their calendars, sounds and messages are no matter of SQL; they are tested by brute force."""
    return {"p4_found": problems.P4_SQL, "p4_periods": f"SELECT tab, period, reason, count(*) AS n_refs FROM ({problems.P4_SQL}) GROUP BY 1, 2, 3"} | archive.SQL
