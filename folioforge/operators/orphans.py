"""References to records that do not exist, are gone, or came later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.text import once
from folioforge.operators.snapshots import small
from folioforge.session import stored


def orphan_keys(refs: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of refs, without nulls, that parents lacks.

    Both sides are reduced to distinct keys before the anti-join, so a key that
    holds a third of all references is one row per input task from there on.
    """
    wanted = refs.select(*keys)
    for k in keys:
        wanted = wanted.filter(F.col(k).isNotNull())
    return wanted.distinct().join(parents.select(*keys).distinct(), keys, "left_anti")


def orphans_of_snapshots(refs: DataFrame, at: str, ref_id: str, keys: list[str], listed: DataFrame, snapshot: str, snapshot_date: str) -> DataFrame:
    """References at a time to records that the snapshot in force lacks.

    refs: references with keys, the time column `at` and `ref_id`. listed:
    snapshot rows with the same keys, a snapshot number and its date; a snapshot
    is in force from 00:00 of its date until the next. The reason is `missing`
    if no snapshot lists the key, `deleted` if an earlier one does, else `late`.
    Before the first snapshot nothing is listed. A reference without time gets
    no case unless the key is missing at all times; references with a null in a
    key are none. Listed rows with nulls are ignored. Repeated rows of either
    side count once as parents and each as reference.

    Returns ref_id, `at`, reason. Extra columns are ignored.
    """
    rows = listed.filter(F.col(snapshot).isNotNull()).select(*keys, F.col(snapshot).alias("__snap"), F.expr(f"try_cast(trim(`{snapshot_date}`) as date)").alias("__day"))
    # a row per snapshot, numbered by date; windows without partition are over this list and over the calendar only
    snaps = rows.filter(F.col("__day").isNotNull()).groupBy("__snap").agg(F.min("__day").alias("__day"))
    snaps = snaps.select("__snap", "__day", F.row_number().over(W.orderBy("__day", "__snap")).alias("__seq"))
    known = rows.select(*keys, "__snap").filter(" and ".join(f"`{k}` is not null" for k in keys)).distinct()
    listed_at = known.join(small(snaps.select("__snap", "__seq")), "__snap").select(*keys, "__seq")
    asked = refs.select(*keys, F.to_date(at).alias("__day"), F.col(at).alias("__at"), F.col(ref_id).alias("__id"))
    days = asked.select("__day").filter(F.col("__day").isNotNull()).distinct().withColumn("__seq", F.lit(None).cast("int"))
    calendar = days.unionByName(snaps.select("__day", "__seq"))
    in_force = calendar.select("__day", F.coalesce(F.max("__seq").over(W.orderBy("__day").rangeBetween(W.unboundedPreceding, 0)), F.lit(0)).alias("__seq")).distinct()
    asked = asked.join(small(in_force), "__day", "left")
    gone = orphan_keys(asked.withColumn("__seq", F.coalesce("__seq", F.lit(-1))), listed_at, [*keys, "__seq"])
    first = listed_at.groupBy(*keys).agg(F.min("__seq").alias("__first"))
    reason = F.when(F.col("__first").isNull(), "missing").when(F.col("__seq") < 0, None).when(F.col("__first") < F.col("__seq"), "deleted").otherwise("late")
    told = gone.join(first, keys, "left").select(*keys, "__seq", reason.alias("reason")).filter(F.col("reason").isNotNull())
    back = asked.withColumn("__seq", F.coalesce("__seq", F.lit(-1))).join(told, [*keys, "__seq"])
    return back.select(F.col("__id").alias(ref_id), F.col("__at").alias(at), "reason")


#: a key with more rows than this goes by days, seconds and instants, any other by instants at once; the result is the same
HOT = 20_000
#: day of references without time, before all others
_NEVER = -100_000_000


def _cells(t: str, never: bool = False) -> list[Column]:
    """The cells of time that t falls in, from coarse to fine: its day, its second of the day, itself; or those of no time at all."""
    none = F.date_from_unix_date(F.lit(_NEVER))
    if never:
        return [none, F.lit(0), none.cast("timestamp_ntz")]
    at = F.coalesce(F.col(t).cast("timestamp_ntz"), none.cast("timestamp_ntz"))
    day, second = F.coalesce(F.to_date(t), none), F.coalesce(F.hour(t) * 3600 + F.minute(t) * 60 + F.floor(F.second(t)).cast("int"), F.lit(0))
    return [day.alias("__c0"), second.alias("__c1"), at.alias("__c2")]


def _orphans_in_cells(refs: DataFrame, moves: DataFrame, first: DataFrame, cells: list[str], finer: list[str], opening: DataFrame | None = None) -> DataFrame:
    """Orphans among refs, by cells, and in those that change by finer ones; see `orphans_of_intervals`.

    refs: __k, cells, __id. moves: __k, cells, __open (1 for a start, -1 for an
    end). first: __k, its first start in cells and __known. opening: the cells
    around these, with the balance before them.
    """
    keys = ["__k", *cells]
    last = not finer
    zero, yes, no = F.lit(0).cast("bigint").alias("__open"), F.lit(True), F.lit(False)
    events = refs.select(*keys, zero, yes.alias("__asked"), no.alias("__moved")).unionByName(moves.select(*keys, "__open", no.alias("__asked"), yes.alias("__moved")))
    met = events.groupBy(*keys).agg(F.sum("__open").alias("__open"), F.bool_or("__asked").alias("__asked"), F.bool_or("__moved").alias("__moved"))
    before = met
    if opening is not None:
        # the balance so far stands before all cells of its own
        start = opening.select(*keys[:-1], F.lit(None).cast(met.schema[cells[-1]].dataType).alias(cells[-1]), F.col("__before").alias("__open"), no.alias("__asked"), no.alias("__moved"))
        before = before.unionByName(start)
    upto = W.partitionBy(*keys[:-1]).orderBy(F.asc_nulls_first(cells[-1])).rowsBetween(W.unboundedPreceding, 0 if last else -1)
    state = stored(before.select(*keys, "__asked", "__moved", F.coalesce(F.sum("__open").over(upto), F.lit(0)).alias("__before")).filter("__asked"))
    # cells where something starts or ends are no orphans yet; at an instant the balance has its own moves
    kept = state.filter("__before > 0" if last else "__moved or __before > 0")
    gone = orphan_keys(state, kept, keys)
    started = [f"__f{c[3:]}" for c in cells]
    late = F.col(started[0]).isNull() | (F.struct(*started) > F.struct(*cells))
    reason = F.when(F.col("__known").isNull(), "missing").when(F.col(cells[0]) == _cells("__at", never=True)[int(cells[0][3:])], None).when(late, "late").otherwise("deleted")
    told = gone.join(first, "__k", "left").select(*keys, reason.alias("reason")).filter(F.col("reason").isNotNull())
    found = refs.join(told, keys).select("__id", "__at", "reason")
    if last:
        return found
    changing = state.filter("__moved").select(*keys, "__before")
    if changing.isEmpty():
        return found
    inner = [stored(df.join(changing.select(*keys), keys, "left_semi")) for df in (refs, moves)]
    return found.unionByName(_orphans_in_cells(*inner, first, [*cells, finer[0]], finer[1:], changing))


def orphans_of_intervals(refs: DataFrame, key: str, at: str, ref_id: str, kept: DataFrame, start: str, end: str, hot: int = HOT) -> DataFrame:
    """References at a time to things that were not kept at that time.

    kept: intervals [start, end) of the same key, end null while it lasts. A reference
    is an orphan if no interval of its key holds its time: `missing` if the key
    has no interval at all, `late` if all start after it, else `deleted`.

    Foreign keys are distinct (key, time); parent keys are those at which the
    key was kept. What the anti-join of the two leaves is joined back for the
    reason and the references. Whether a key was kept at a time is the balance
    of its starts and ends up to then, a window over the times of one key.

    A key with more than `hot` rows would be too much for one task. It goes by
    cells of time: those in which nothing starts or ends are decided as a whole,
    the others are cut into finer ones: days, seconds, instants. Cells are
    distinct before the window, which is over those of one key in one coarser
    cell, so there is a row per day, per second of a day, or per microsecond of
    a second at most, whatever the number of references.

    References with a null or empty key are none; those without time are cases only if
    the key is missing. Intervals that end before they start hold nothing but
    count as having started; intervals without start make a key known, no more.
    Ties: an interval holds its start, not its end.

    Returns ref_id, `at`, reason. Extra columns are ignored.
    """
    pack = F.unhex(F.md5(F.nullif(key, F.lit(""))))  # 16 bytes for a key of any length
    # written, as both are read several times, and a key may cost more than its reading
    asked = stored(refs.select(once(pack).alias("__k"), F.col(at).alias("__at"), F.col(ref_id).alias("__id")).filter(F.col("__k").isNotNull()))
    asked = asked.select("__k", "__at", "__id", *_cells("__at"))
    spans = stored(kept.select(once(pack).alias("__k"), F.col(start).alias("__s"), F.col(end).alias("__e")).filter(F.col("__k").isNotNull()))
    first = spans.groupBy("__k").agg(F.min("__s").alias("__s"))
    first = first.select("__k", F.lit(True).alias("__known"), *[F.when(F.col("__s").isNotNull(), c).alias(f"__f{n}") for n, c in enumerate(_cells("__s"))])
    starts = spans.filter("__s is not null").select("__k", F.col("__s").alias("__t"), F.when(F.col("__e") <= F.col("__s"), 0).otherwise(1).cast("bigint").alias("__open"))
    ends = spans.filter("__e > __s").select("__k", F.col("__e").alias("__t"), F.lit(-1).cast("bigint").alias("__open"))
    moves = starts.unionByName(ends).select("__k", "__open", *_cells("__t"))
    rows = asked.select("__k").unionByName(spans.select("__k")).groupBy("__k").agg(F.count("*").alias("__n"))
    many = stored(rows.filter(F.col("__n") > hot).select("__k"))
    if many.isEmpty():
        found = _orphans_in_cells(asked, moves, first, ["__c2"], [])
    else:
        few = [df.join(many, "__k", "left_anti") for df in (asked, moves)]
        large = [df.join(many, "__k", "left_semi") for df in (asked, moves)]
        found = _orphans_in_cells(*few, first, ["__c2"], []).unionByName(_orphans_in_cells(*large, first, ["__c0"], ["__c1", "__c2"]))
    return found.select(F.col("__id").alias(ref_id), F.col("__at").alias(at), "reason")


def per_table_and_period(orphans: DataFrame) -> DataFrame:
    """Orphans (tab, period, reason, ...) counted per table, month and reason."""
    return orphans.groupBy("tab", "period", "reason").agg(F.count("*").alias("n_refs"))
