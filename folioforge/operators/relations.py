"""Relational operators of the archive: merging lists, ledgers, deduplication, fallbacks, matching, reachability.

Whatever is first or last by order in a list is by a column here: every result
is the same for any partitioning.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.session import checkpoint


def last_wins(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """value of the last row by order of each key; a null value may win."""
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, value)).getField(value).alias(value))


def first_wins(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """value of the first row by order of each key; a null value may win."""
    return rows.groupBy(*keys).agg(F.min(F.struct(*order, value)).getField(value).alias(value))


def with_position(rows: DataFrame, order: list[Column], out: str) -> DataFrame:
    """rows with their position from 1 in a total order, by a distributed sort.

    Sorted partitions are numbered within themselves and moved by the sizes of
    those before; what is gathered is a row per partition. The sorted rows are a
    checkpoint, so both passes see the same partitions.
    """
    placed = checkpoint(rows.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    part, within = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    moved = F.broadcast(sizes.select("__part", before.alias("__before")))
    return placed.withColumn("__part", part).join(moved, "__part").withColumn(out, F.col("__before") + within + 1).drop("__id", "__part", "__before")


def merge_lists(rows: DataFrame, which: str, key: str, date: str, order: str) -> DataFrame:
    """Union of lists by key, newest first and undated last.

    rows: all lists, told apart and ranked by the column `which`. A key's date
    comes from the last list that has it, its place among equal dates from the
    first. Returns key, date, position from 1.
    """
    tagged = rows.select(F.col(key), F.coalesce(F.col(date), F.lit("")).alias(date), F.col(which).alias("__list"), F.col(order).alias("__ord"))
    place = F.struct("__list", "__ord")
    merged = tagged.groupBy(key).agg(F.max(F.struct("__list", -F.col("__ord"), date)).getField(date).alias(date), F.min(place).alias("__place"))
    return with_position(merged, [(F.col(date) != "").desc(), F.col(date).desc(), F.col("__place"), F.col(key)], "position").select(key, date, "position")


def carry_forward(current: DataFrame, earlier: DataFrame, keys: list[str], value: str) -> DataFrame:
    """current with an empty value filled from earlier rows of the key, '' if neither has one."""
    known = earlier.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*keys).agg(F.max(value).alias("__known"))
    return current.join(known, keys, "left").withColumn(value, F.coalesce(F.nullif(F.col(value), F.lit("")), F.col("__known"), F.lit(""))).drop("__known")


def ledger_add(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Ledger with rows added, each once."""
    return ledger.unionByName(rows).dropDuplicates()


def ledger_remove(ledger: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Ledger without the rows whose keys are in `gone`; nulls are equal to nulls here."""
    both = None
    other = gone.select(*[F.col(k).alias(f"__g_{k}") for k in keys]).distinct()
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__g_{k}"))
        both = same if both is None else both & same
    return ledger.join(other, both, "left_anti")


def pending(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def retry_scope(rows: DataFrame, failed: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows that failed in any of the stages."""
    union = failed[0].select(*keys)
    for f in failed[1:]:
        union = union.unionByName(f.select(*keys))
    return rows.join(union.distinct(), keys, "left_semi")


def failed_entries(ledger: DataFrame, post: str, item: str) -> DataFrame:
    """Failed items of each post as a sorted array; null, which means all, as soon as one item is empty."""
    all_of = F.bool_or(F.coalesce(F.col(item), F.lit("")) == "")
    return ledger.groupBy(post).agg(F.when(~all_of, F.array_sort(F.collect_set(item))).alias("items"))


def still_failed(failed: DataFrame, recovered: DataFrame, post: str, item: str) -> DataFrame:
    """Failures that weren't recovered; those of whole posts (empty item) always stay."""
    fixed = recovered.select(F.col(post).alias("__p"), F.col(item).alias("__i")).filter("__i <> ''").distinct()
    return failed.join(fixed, (F.col(post) == F.col("__p")) & (F.col(item) == F.col("__i")), "left_anti")


def stale_posts(stale: DataFrame, post: str, unmapped: str, known: DataFrame, key: str) -> DataFrame:
    """Posts with a formerly unmapped URL that is known now."""
    return stale.select(post, F.explode(unmapped).alias(key)).join(known.select(key).distinct(), key, "left_semi").select(post).distinct()


def content_dedup(rows: DataFrame, content: Column, order: list[str], path: str) -> DataFrame:
    """rows with the hash of their content and the path of the first row that has it; later ones are aliases.

    The first path is aggregated before it is joined back, so a content that a
    third of all rows share isn't gathered in one task.
    """
    hashed = rows.withColumn("sha256", F.sha2(content, 256))
    first = hashed.groupBy("sha256").agg(F.min(F.struct(*order, path)).alias("__first"))
    joined = hashed.join(first, "sha256")
    return joined.withColumns({"kept_path": F.col(f"__first.{path}"), "is_alias": F.struct(*order, path) != F.col("__first")}).drop("__first")


def collision_names(rows: DataFrame, folder: str, name: str, content_hash: str, order: list[str]) -> DataFrame:
    """A name per distinct content in a folder: the first keeps it, the others get _2, _3, ... in order of their first row.

    Contents are numbered by a distributed sort, so a name that a third of all
    contents want isn't dealt with by one task. Nulls are equal to nulls.
    """
    first = rows.groupBy(folder, name, content_hash).agg(F.min(F.struct(*order)).alias("__at"))
    placed = with_position(first, [F.col(folder), F.col(name), F.col("__at"), F.col(content_hash)], "__pos")
    start = placed.groupBy(F.col(folder).alias("__f"), F.col(name).alias("__m")).agg(F.min("__pos").alias("__start"))
    n = F.col("__pos") - F.col("__start") + 1
    suffix = F.when(n > 1, F.concat(F.lit("_"), n.cast("string"))).otherwise("")
    met = placed.join(start, F.col(folder).eqNullSafe(F.col("__f")) & F.col(name).eqNullSafe(F.col("__m")))
    return met.select(folder, name, content_hash, F.concat(F.col(name), suffix).alias("saved_name"))


def first_available(rows: DataFrame, sources: list[tuple[str, DataFrame]], keys: list[str], value: str) -> DataFrame:
    """value of the first source in order that has one for the key, with the source's name in `how`.

    All sources are one table with a priority, so a row meets one join, not one
    per source. Null values count as missing; of several the least counts.
    """
    union = None
    for n, (name, source) in enumerate(sources):
        part = source.select(*keys, F.lit(n).alias("__prio"), F.lit(name).alias("how"), F.col(value).alias(value)).filter(F.col(value).isNotNull())
        union = part if union is None else union.unionByName(part)
    best = union.groupBy(*keys).agg(F.min(F.struct("__prio", value, "how")).alias("__best"))
    return rows.join(best, keys, "left").withColumns({value: F.col(f"__best.{value}"), "how": F.coalesce(F.col("__best.how"), F.lit("none"))}).drop("__best")


def interval_pairs(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, left_day: str, right_day: str, within: int) -> DataFrame:
    """Pairs of one key whose days differ by `within` at most: (left_id, right_id, days).

    Days are cut into buckets of that width; the left side looks into its own
    and the two around it, so the join is by equality.
    """
    number = lambda c: F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))
    a = left.select(*keys, F.col(left_id), number(left_day).alias("__a")).withColumn("__b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("__a") / within) + d)))
    b = right.select(*keys, F.col(right_id), number(right_day).alias("__c")).withColumn("__b", F.floor(F.col("__c") / within))
    days = F.abs(F.col("__a") - F.col("__c"))
    return a.join(b, [*keys, "__b"]).filter(days <= within).select(left_id, right_id, days.alias("days"))


def nearest(pairs: DataFrame, left_id: str, right_id: str, distance: str) -> DataFrame:
    """The partner of least distance, ties to the least id."""
    return pairs.groupBy(left_id).agg(F.min(F.struct(distance, right_id)).alias("__n")).select(left_id, f"__n.{right_id}", f"__n.{distance}")


def ranked(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order)))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two texts (Ratcliff and Obershelp), null for a null on either side."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def best_title(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, left_title: str, right_id: str, right_title: str, least: float) -> DataFrame:
    """The right row of the most similar title among those of equal keys, if it reaches `least`; of equals the least id."""
    pairs = left.select(*keys, left_id, F.col(left_title).alias("__a")).join(right.select(*keys, right_id, F.col(right_title).alias("__b")), keys)
    # the ratio can't exceed what the lengths allow, which is known without comparing
    most = 2 * F.least(F.length("__a"), F.length("__b")) / (F.length("__a") + F.length("__b"))
    pairs = pairs.filter(most >= least)
    scored = pairs.select(left_id, right_id, similarity("__a", "__b").alias("ratio")).filter(F.col("ratio") >= least)
    return scored.groupBy(left_id).agg(F.max_by(F.struct(right_id, "ratio"), F.struct("ratio", -F.col(right_id))).alias("__m")).select(left_id, f"__m.{right_id}", "__m.ratio")


def first_containing(needles: DataFrame, needle: str, texts: DataFrame, text: str, text_id: str) -> DataFrame:
    """The first text by id that contains each needle, ignoring case. needles is a stated query set."""
    return needles.join(texts.select(text_id, F.lower(text).alias("__t")), F.contains("__t", F.lower(needle))).groupBy(needle).agg(F.min(text_id).alias(text_id))


def previous_marked(rows: DataFrame, group: list[str], order: list[str], marked: Column, value: str, out: str) -> DataFrame:
    """rows with the value of the nearest marked row before each (backward as-of by order)."""
    before = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn(out, F.last(F.when(marked, F.col(value)), ignorenulls=True).over(before))


def sections(rows: DataFrame, group: list[str], order: list[str], heading: Column) -> DataFrame:
    """rows with the number of their section, their place in it and its size; a heading starts a section, rows before the first are in 0."""
    upto = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    numbered = rows.withColumn("section", F.sum(heading.cast("int")).over(upto))
    own = W.partitionBy(*group, "section")
    return numbered.withColumns({"pos": F.row_number().over(own.orderBy(*order)) - 1, "total": F.count("*").over(own)})


def reachable(edges: DataFrame, source: str, target: str, start: DataFrame, node: str, hops: int = 2) -> DataFrame:
    """Nodes within `hops` edges of start, with the least number of hops."""
    links = edges.select(F.col(source).alias("__s"), F.col(target).alias("__t")).filter("__s is not null and __t is not null").distinct()
    level = start.select(F.col(node).alias("__n")).distinct()
    found = None
    for hop in range(1, hops + 1):
        level = links.join(level, F.col("__s") == F.col("__n"), "left_semi").select(F.col("__t").alias("__n")).distinct()
        step = level.withColumn("hops", F.lit(hop))
        found = step if found is None else found.unionByName(step)
    return found.groupBy(F.col("__n").alias(node)).agg(F.min("hops").alias("hops"))


def sample(rows: DataFrame, key: str, n: int, seed: int = 0, tenth: bool = True) -> DataFrame:
    """n rows by a hash of key and seed; with `tenth`, a tenth of all at most and one at least."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")))
    return rows.orderBy(order, key).limit(min(n, max(1, rows.count() // 10)) if tenth else n)


def paged(rows: DataFrame, group: str, order: list[Column], per_page: int) -> DataFrame:
    """rows with their place in their group and the page it falls on, both from 1; a group of any size is sorted by many tasks."""
    numbered = with_position(rows, [F.col(group), *order], "__pos")
    first = numbered.groupBy(group).agg(F.min("__pos").alias("__first"))
    place = F.col("__pos") - F.col("__first") + 1
    return numbered.join(first, group).withColumns({"place": place, "page_no": F.floor((place - 1) / per_page) + 1}).drop("__pos", "__first")
