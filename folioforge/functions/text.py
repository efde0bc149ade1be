"""Expressions shared by text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """value, calculated in the projection it stands in and nowhere else.

    The condition is always true but not deterministic to the optimizer, so the
    projection isn't merged into one above that uses the column several times,
    and no filter on it is pushed below, which would calculate it again.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)
