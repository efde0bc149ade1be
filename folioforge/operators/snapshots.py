"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A list of snapshots up to this length is broadcast; a longer one is joined by shuffle.
MAX_BROADCAST_SNAPSHOTS = 100_000


def row_hash(*values: Column) -> Column:
    """Canonical 64-bit hash of a row: values as text, each with its length, so neighbours can't run together.

    Null if any value is null: a missing value says nothing about a change. It
    is compared between the two rows of one key only, and is of fixed width, so
    aggregations on it are by hash.
    """
    texts = [v.cast("string") for v in values]
    whole = F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts])
    return F.when(whole.isNotNull(), F.xxhash64(whole))


def _latest_of(rows: DataFrame, keys: list[str], newest: list[str], value: str) -> DataFrame:
    """value, a 64-bit hash, of the newest row of each key; of equally new ones the greatest.

    One column of dates, times or integers is packed with the hash into one
    decimal: that is of fixed width, so the aggregation is by hash. A structure,
    which is taken for anything else, makes Spark sort all rows.
    """
    kind = rows.schema[newest[0]].dataType if len(newest) == 1 else None
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        at = F.col(newest[0]).cast("bigint")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        at = F.unix_micros(F.col(newest[0]).cast("timestamp"))
    elif isinstance(kind, T.DateType):
        at = F.unix_date(newest[0]).cast("bigint")
    else:
        return rows.groupBy(*keys).agg(F.max(F.struct(*newest, value)).getField(value).alias(value))
    # 64 bits of time above 62 of the hash, which a decimal of 38 digits holds; nulls are least
    high = F.coalesce(at, F.lit(-(1 << 63))).cast("decimal(19,0)") * F.lit(Decimal(1 << 62))
    low = F.when(F.col(value).isNull(), F.lit(0)).otherwise(F.greatest(F.shiftrightunsigned(value, 2), F.lit(1)))
    order = (high.cast("decimal(38,0)") + low.cast("decimal(19,0)")).cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def small(df: DataFrame, limit: int = MAX_BROADCAST_SNAPSHOTS) -> DataFrame:
    """df with a broadcast hint if it is counted to have at most `limit` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def _steps(snaps: DataFrame) -> DataFrame:
    """Each snapshot with the next one, and whether it is the first.

    A list within the bound of a broadcast is read once and sorted here; a
    longer one is a window without partition over the list of snapshots only.
    """
    schema = T.StructType([snaps.schema[0], T.StructField("__next", snaps.schema[0].dataType), T.StructField("__first", T.BooleanType())])
    head = sorted(r[0] for r in snaps.limit(MAX_BROADCAST_SNAPSHOTS + 1).collect())
    if len(head) <= MAX_BROADCAST_SNAPSHOTS:
        return F.broadcast(snaps.sparkSession.createDataFrame([(s, n, k == 0) for k, (s, n) in enumerate(zip(head, [*head[1:], None]))], schema))
    around = W.orderBy("__snap")
    return snaps.select("__snap", F.lead("__snap").over(around).alias("__next"), F.lag("__snap").over(around).isNull().alias("__first"))


def snapshot_changes(rows: DataFrame, snapshot: str, keys: list[str], newest: list[str], compared: list[Column]) -> DataFrame:
    """Rows added, removed or changed between each two consecutive snapshots.

    rows: full snapshots, told apart by the column `snapshot`. keys: primary
    key. newest: columns that order several rows of one key in one snapshot; the
    greatest counts, nulls are least. compared: what the row hash is made of.

    Full outer join of each snapshot with the one before on key; a missing side
    gives `added` or `removed`, unequal hashes give `changed`. A null among the
    compared values on either side is no change. Rows with a null in the key or
    the snapshot are no records and are left out. The first snapshot, a single
    snapshot and an empty table give no rows. Repeated rows and ties in `newest`
    with equal content change nothing; ties with unequal content take the
    greater hash. With one column of times, dates or integers in `newest` no
    step sorts all rows. Numbers may be skipped. Extra columns are ignored.

    Returns snapshot, keys, change.
    """
    kept = rows.filter(F.col(snapshot).isNotNull())
    for k in keys:
        kept = kept.filter(F.col(k).isNotNull())
    hashed = kept.select(F.col(snapshot).alias("__snap"), *keys, *[c for c in newest if c not in keys], row_hash(*compared).alias("__hash"))
    latest = _latest_of(hashed, ["__snap", *keys], newest, "__hash")
    steps = _steps(rows.select(F.col(snapshot).alias("__snap")).filter(F.col("__snap").isNotNull()).distinct())
    staged = latest.join(steps, "__snap")
    old = staged.filter(F.col("__next").isNotNull()).select(F.col("__next").alias("__snap"), *keys, F.col("__hash").alias("__old"), F.lit(True).alias("__was"))
    new = staged.filter(~F.col("__first")).select("__snap", *keys, F.col("__hash").alias("__new"), F.lit(True).alias("__is"))
    change = F.when(F.col("__was").isNull(), "added").when(F.col("__is").isNull(), "removed").when(F.col("__old") != F.col("__new"), "changed")
    return (
        old.join(new, ["__snap", *keys], "full_outer")
        .select(F.col("__snap").alias(snapshot), *keys, change.alias("change"))
        .filter(F.col("change").isNotNull())
    )
