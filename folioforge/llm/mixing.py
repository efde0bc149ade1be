"""Mixing sources to target shares of tokens, by Poisson replication.

Every document draws a uniform number from a hash of its id and the seed; its
number of copies is the inverse of a Poisson distribution at that number, cut
at the cap of its source. The means are calibrated on the drawn numbers, so
shares are met by tokens, not on average only.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import stored

#: file of a public tokenizer, a parameter of `Mix`; it is read once by the driver, not by workers
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how text is cut before byte pairs are merged.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: targets are a small dimension; more rows than this are refused
MAX_SOURCES = 10_000
#: drawn numbers are counted in so many bins per source for the calibration
BINS = 4096


def count_tokens(spark: SparkSession, vocabulary: str):
    """Batch function that adds n_tokens to (id, source, text). The vocabulary goes to the workers as a broadcast of its some hundred thousand entries, so they need no file."""
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    shared = spark.sparkContext.broadcast(ranks)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encoding = tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        for b in batches:
            texts = b["text"].fillna("").tolist()
            yield pd.DataFrame({"id": b["id"], "source": b["source"], "u": b["u"], "n_tokens": [len(x) for x in encoding.encode_ordinary_batch(texts, num_threads=1)]}).astype({"id": "Int64"})

    return count


def source_name(source: Column) -> Column:
    """One spelling of a source: lower case, words joined by `_`, no spaces around."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(source, r"(?U)\s+", " "))), r"[\s\-]+", "_")


def uniform(seed: int, *key: Column) -> Column:
    """A number in [0, 1) of a key, the same in every run with that seed."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11) / F.lit(float(1 << 53))


def thresholds(mean: float, cap: int) -> tuple[int, list[float]]:
    """Distribution function of Poisson(mean), cut at cap: (least, steps). A number draws `least` copies, and one more for each step that it reaches.

    Copies that every drawn number has, or none, for all its bits, are no steps,
    so there are some ten deviations of them, whatever the mean and the cap.
    """
    if mean <= 0:
        return 0, []
    width = 10.0 * math.sqrt(mean) + 40.0
    low, high = min(cap, max(0, math.floor(mean - width))), min(cap, math.ceil(mean + width))
    k = np.arange(low, high)
    steps = np.cumsum(np.exp(k * math.log(mean) - mean - _log_factorials(high)[low:high]))
    return low, np.minimum(steps, 1.0).tolist()


@lru_cache(maxsize=64)
def _log_factorials_upto(power: int) -> np.ndarray:
    return np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, 1 << power)))))


def _log_factorials(n: int) -> np.ndarray:
    """Logarithms of the factorials of 0 to n - 1, at least."""
    return _log_factorials_upto(max(10, int(n).bit_length()))


def copies_at(u: float, mean: float, cap: int) -> int:
    least, steps = thresholds(mean, cap)
    return least + sum(u >= t for t in steps)


@dataclass(frozen=True)
class Plan:
    """Mean and cap of each source of the mix."""

    means: dict[str, float]
    caps: dict[str, int]

    def with_copies(self, rows: DataFrame) -> DataFrame:
        """rows (source, u, ...) with the number of copies of each; 0 for sources without target.

        The steps are a row per source, of at most MAX_SOURCES, so their
        table is small enough to be broadcast.
        """
        steps = [(s, *thresholds(m, self.caps[s])) for s, m in sorted(self.means.items()) if m > 0]
        table = rows.sparkSession.createDataFrame(steps, "source string, __least int, __steps array<double>")
        joined = rows.join(F.broadcast(table), "source", "left")
        reached = F.col("__least") + F.size(F.filter("__steps", lambda t: F.col("u") >= t))
        return joined.withColumn("copies", F.when(F.col("__steps").isNotNull(), reached).otherwise(0)).drop("__least", "__steps")


def make_plan(tokens: dict[str, dict[int, int]], targets: list[tuple[str, float, int]], reach: float = 0.9, total: float | None = None) -> Plan:
    """Means that give each source its share of the tokens.

    tokens: tokens of a source by bin of the drawn number. targets: source,
    share, cap. Shares of sources without tokens fall to the others in
    proportion. total: tokens of the mix; if None, as many as the source that
    runs out first gives when `reach` of its capped copies are drawn.
    """
    have = {s: sum(b.values()) for s, b in tokens.items()}
    open_ = [(s, w, c) for s, w, c in targets if have.get(s, 0) > 0 and w > 0 and c > 0]
    if not open_:
        return Plan({}, {})
    whole = sum(w for _, w, _ in open_)
    if total is None:
        total = min(reach * c * have[s] * whole / w for s, w, c in open_)

    counted = {s: (np.array(sorted(tokens[s]), dtype=float), np.array([tokens[s][b] for b in sorted(tokens[s])], dtype=float)) for s, _, _ in open_}

    def drawn(s: str, mean: float, cap: int) -> float:
        bins, n = counted[s]
        least, steps = thresholds(mean, cap)
        part = least + np.clip(bins[:, None] + 1 - np.array(steps)[None, :] * BINS, 0.0, 1.0).sum(axis=1)
        return float((n * part).sum())

    means = {}
    for s, w, c in open_:
        want = min(total * w / whole, c * have[s])
        low, high = 0.0, 4.0 * c + 16.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if drawn(s, middle, c) < want else (low, middle)
        means[s] = (low + high) / 2
    return Plan(means, {s: c for s, _, c in open_})


class Mix:
    """A mix of documents by targets.

    documents: id, source, text. targets: source, share of tokens, cap. Sources
    are compared in one spelling. Documents with a null or unknown source are
    not in the mix. A null or empty text has no tokens and is drawn like any
    other. Null ids draw by the text. Repeated rows draw alike. Empty tables
    give an empty mix. Of repeated targets the shares add up and the least cap
    holds; null shares count as 0, null caps as 1. Extra columns are ignored.
    """

    def __init__(self, documents: DataFrame, doc_id: str, source: str, text: str, targets: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, seed: int = 0, reach: float = 0.9, total: float | None = None):
        self.spark: SparkSession = documents.sparkSession
        self.doc_id, self.seed = doc_id, seed
        rows = targets.select("source", "target_share", "max_repeats").filter("source is not null").limit(MAX_SOURCES + 1).withColumn("source", source_name(F.col("source"))).collect()
        if len(rows) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} targets")
        shares: dict[str, float] = {}
        caps: dict[str, int] = {}
        for r in rows:
            shares[r["source"]] = shares.get(r["source"], 0.0) + (r["target_share"] or 0.0)
            caps[r["source"]] = min(caps.get(r["source"], 1 << 20), 1 if r["max_repeats"] is None else r["max_repeats"])
        self.targets = [(s, w, caps[s]) for s, w in sorted(shares.items())]
        key = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("\u0000"), F.col(text)), F.lit(""))
        named = documents.select(F.col(doc_id).alias("id"), source_name(F.col(source)).alias("source"), F.col(text).alias("text"), uniform(seed, key).alias("u"))
        self.documents = named.filter(F.col("source").isin(list(shares)) if shares else F.lit(False))
        self.counted = stored(self.documents.mapInPandas(count_tokens(self.spark, vocabulary), "id bigint, source string, u double, n_tokens bigint"))
        bins = self.counted.groupBy("source", F.floor(F.col("u") * BINS).alias("bin")).agg(F.sum("n_tokens").alias("n")).collect()
        tokens: dict[str, dict[int, int]] = {}
        for r in bins:
            tokens.setdefault(r["source"], {})[r["bin"]] = r["n"]
        self.plan = make_plan(tokens, self.targets, reach, total)

    def rows(self) -> DataFrame:
        """doc_id, source, copy_no, text in an order shuffled over all: rows are spread by a hash of document and copy, and sorted by it."""
        drawn = self.plan.with_copies(self.documents).filter("copies > 0")
        each = drawn.select("id", "source", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"), "text", "u")
        place = F.xxhash64(F.lit(self.seed + 1), "u", "id", "copy_no")
        shuffled = each.withColumn("place", place).repartition("place").sortWithinPartitions("place")
        return shuffled.select(F.col("id").alias(self.doc_id), "source", "copy_no", "text")

    def shares(self) -> DataFrame:
        """source, target_share, max_repeats, n_docs, n_copies, n_tokens, actual_share: a row per target."""
        used = self.plan.with_copies(self.counted)
        by = used.groupBy("source").agg(
            F.sum((F.col("copies") > 0).cast("bigint")).alias("n_docs"), F.sum("copies").cast("bigint").alias("n_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("n_tokens"), F.max("copies").alias("most_repeats")
        )
        targets = self.spark.createDataFrame(self.targets, "source string, target_share double, max_repeats int")
        whole = by.agg(F.sum("n_tokens").alias("whole"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
        told = F.broadcast(targets).join(by, "source", "left").join(F.broadcast(whole))
        return told.select("source", "target_share", "max_repeats", zero("n_docs"), zero("n_copies"), zero("n_tokens"), zero("most_repeats"), F.coalesce(F.try_divide(F.col("n_tokens"), F.col("whole")), F.lit(0.0)).alias("actual_share"))
