"""Evaluation passages inside training documents, by a stored positional inverted index.

The index holds every token of every training document with its places. A token
is a word or, in scripts without spaces, two characters in a row. It is built
once and serves any number of sets of test items: nothing of it depends on them.

It is cut into blocks of documents and, by the hash of the token, into buckets;
a row holds the sorted tokens of a bucket in a block with their postings. Rows
lie sorted by bucket, so a search reads the buckets of its tokens only.

A search counts its tokens, takes the rarest of each stretch of an item, and
intersects their lists, shifted by the place in the item: where enough of them
fall on one diagonal (place in the document less place in the item), document
and item are aligned token by token. All of that is read from the index; texts
aren't read again.
"""

from __future__ import annotations

import html
import re
import unicodedata as ud
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import stored

#: one token in so many may differ
ONE_IN = 10
#: test items are searched in sets of so many tokens, which bounds what is broadcast, whatever their number
ITEM_TOKENS = 1_000_000
#: a block of the index has about so many tokens and fewer documents than two bytes count
BLOCK_TOKENS, BLOCK_DOCUMENTS = 1_000_000, 60_000
#: rows of a block, by the first bits of a token's hash
BUCKET_BITS = 6
#: places in a document and an item that agree on the diagonal but for so many tokens are one candidate
BAND = 16
#: pairs of places that are looked at together
CHUNK = 4_000_000
#: an alignment follows a passage to another diagonal by stretches of so many equal tokens, however far
STRETCH = 5


@dataclass(frozen=True)
class Unit:
    """How texts are cut and matched: least length of a passage, length of a token, rarest tokens looked up in a stretch of that length, changes that the best stretch of a passage may have."""

    name: str
    least: int
    width: int
    looked_up: int
    changes: int

    @property
    def surely(self) -> int:
        """Tokens looked up that stay whole in the best stretch of any passage: each change breaks at most `width` of them."""
        return self.looked_up - self.width * self.changes

    @property
    def window(self) -> int:
        """Tokens of the least passage."""
        return self.least - self.width + 1

    @property
    def whole(self) -> int:
        """Tokens of any kind that stay whole in the best stretch of any passage."""
        return self.window - self.width * self.changes


#: a passage of 20 words has two changes, one of 30 may have three in its middle, which no stretch of 20 avoids; longer ones have a better stretch
WORDS = Unit("words", 20, 1, 10, 3)
#: six changes in 60 characters, nine in 90, each in two pairs
CHARACTERS = Unit("characters", 60, 2, 34, 9)

# Scripts without spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("[ก-๛ກ-ໟༀ-࿿က-႟ក-៿ぁ-ゖァ-ヺ㐀-䶿一-鿿\U00020000-\U0003134f]")
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_LINK = re.compile(r"\]\([^()\s]*\)")
_UNSEEN = re.compile("[​-‏­﻿⁠]")
_BREAK = re.compile(r"<(?:br|p|div|li|/p|/div|/li)\b[^<>]*>", re.I)
# Apostrophes; they join the parts of a word.
_APOSTROPHES = "'’ʼ`´"
_WORD = re.compile(r"[^\W_]+")
#: marks that belong to the letter before them, in scripts where letters don't hold them
_MARK_CLASS = "".join(chr(c) for c in range(0x300, 0x1E00) if ud.category(chr(c)).startswith("M"))
_MARK = re.compile(f"[{_MARK_CLASS}]")
_MARKED_WORD = re.compile(rf"(?:[^\W_]|[{_MARK_CLASS}])+")


def plain(text: str) -> str:
    """Without markup, case and character forms."""
    if "<" in text:
        text = _TAG.sub("", _BREAK.sub(" ", text))
    if "](" in text:
        text = _LINK.sub("", text)
    if "&" in text:
        text = html.unescape(text)
    if text.isascii():
        return text.lower()
    return ud.normalize("NFKC", _UNSEEN.sub("", text)).casefold()


def words(text: str) -> list[str]:
    for mark in _APOSTROPHES:
        if mark in text:
            text = text.replace(mark, "")
    if text.isascii() or not _MARK.search(text):
        return _WORD.findall(text)
    return _MARKED_WORD.findall(text)


def characters(text: str) -> str:
    return "".join(words(text))


def unit_of(text: str) -> Unit:
    """Text in scripts without spaces counts by characters, all other by words."""
    return CHARACTERS if len(_UNSPACED.findall(text)) * 5 > len(text) else WORDS


def word_key(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def pair_keys(text: str) -> np.ndarray:
    """64-bit keys of each two characters in a row."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(c) < 2:
        return np.zeros(0, dtype=np.uint64)
    # mixed, so that buckets are even
    k = (c[:-1] << np.uint64(32)) | c[1:]
    with np.errstate(over="ignore"):
        k = (k ^ (k >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        k = (k ^ (k >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return k ^ (k >> np.uint64(31))


def keys_of(text: str, unit: Unit) -> np.ndarray:
    """Keys of the tokens of a plain text in order."""
    if unit == CHARACTERS:
        return pair_keys(characters(text))
    return np.array([word_key(w) for w in words(text)], dtype=np.uint64)


# the index

INDEX = "block bigint, bucket int, keys binary, starts binary, docs binary, places binary"


class _Block:
    """Postings of some documents, in the making."""

    def __init__(self, number: int) -> None:
        self.number, self.size = number, 0
        self.ids: list[int] = []
        self.known: dict[str, int] = {}
        self.words: list[list[int]] = []
        self.pairs: list[np.ndarray] = []

    def add(self, doc: int, text: str) -> None:
        norm = plain(text)
        known = self.known
        own = [known.setdefault(w, len(known)) for w in words(norm)]
        pairs = pair_keys(characters(norm)) if _UNSPACED.search(norm) else np.zeros(0, dtype=np.uint64)
        self.ids.append(doc)
        self.words.append(own)
        self.pairs.append(pairs)
        self.size += len(own) + len(pairs)

    def full(self) -> bool:
        return self.size >= BLOCK_TOKENS or len(self.ids) >= BLOCK_DOCUMENTS

    def rows(self) -> list[tuple]:
        """A row per bucket, and one of bucket -1 with the ids of the documents."""
        table = np.array([word_key(w) for w in self.known], dtype=np.uint64)
        keys, docs, places = [], [], []
        for n, (own, pairs) in enumerate(zip(self.words, self.pairs)):
            for part in (table[own] if own else None, pairs if len(pairs) else None):
                if part is not None:
                    keys.append(part)
                    docs.append(np.full(len(part), n, dtype=np.uint16))
                    places.append(np.arange(len(part), dtype=np.uint32))
        out = [(self.number, -1, b"", b"", np.array(self.ids, dtype=np.int64).tobytes(), b"")]
        if not keys:
            return out
        key, doc, place = np.concatenate(keys), np.concatenate(docs), np.concatenate(places)
        order = np.argsort(key, kind="stable")
        key, doc, place = key[order], doc[order], place[order]
        bounds = np.searchsorted(key, np.arange(1 << BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)).tolist() + [len(key)]
        for bucket, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if b > a:
                own = key[a:b]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                wide = place[a:b].max() > 0xFFFF
                starts = np.append(first, b - a).astype(np.uint32)
                out.append((self.number, bucket, own[first].tobytes(), starts.tobytes(), doc[a:b].tobytes(), (place[a:b] if wide else place[a:b].astype(np.uint16)).tobytes()))
        return out


def build_index(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The positional index of all tokens of documents, as a written table."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in INDEX.split(", ")]
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        block = _Block(number)
        for b in batches:
            for i, raw in zip(b["id"], b["text"]):
                if raw:
                    block.add(i, raw)
                    if block.full():
                        yield pd.DataFrame(block.rows(), columns=names)
                        number += 1
                        block = _Block(number)
        if block.ids:
            yield pd.DataFrame(block.rows(), columns=names)

    source = documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
    return stored(source.mapInPandas(build, INDEX).sortWithinPartitions("bucket"))


@dataclass
class _Row:
    """A row of the index, decoded."""

    keys: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    places: np.ndarray

    @staticmethod
    def read(keys: bytes, starts: bytes, docs: bytes = b"", places: bytes = b"") -> "_Row":
        d = np.frombuffer(docs, dtype=np.uint16)
        return _Row(np.frombuffer(keys, dtype=np.uint64), np.frombuffer(starts, dtype=np.uint32).astype(np.int64), d, np.frombuffer(places, dtype=np.uint32 if len(places) == 4 * len(d) else np.uint16))

    def of(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys: the numbers of those that are here, and where."""
        at = np.searchsorted(self.keys, asked)
        there = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == asked)) if len(self.keys) else np.zeros(0, dtype=np.int64)
        return there, at[there]

    def postings(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the key, document, place) of all postings of sorted keys."""
        which, at = self.of(asked)
        size = self.starts[at + 1] - self.starts[at]
        take = _ranges(self.starts[at], size)
        return np.repeat(which, size), self.docs[take], self.places[take].astype(np.int64)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ranges, one after the other."""
    if not len(sizes) or not sizes.sum():
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) - np.repeat(ends - sizes - starts, sizes)


# searching


@dataclass
class Items:
    """A set of test items: their tokens as numbers of `keys`, which are sorted and of one unit each."""

    ids: list[int] = field(default_factory=list)
    units: list[Unit] = field(default_factory=list)
    tokens: list[np.ndarray] = field(default_factory=list)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    size: int = 0

    def add(self, item: int, text: str) -> None:
        norm = plain(text)
        unit = unit_of(norm)
        own = keys_of(norm, unit)
        # an item shorter than a passage has none
        if len(own) >= unit.window:
            self.ids.append(item)
            self.units.append(unit)
            self.tokens.append(own)
            self.size += len(own)

    def close(self) -> "Items":
        if self.tokens:
            self.keys = np.unique(np.concatenate(self.tokens))
            self.tokens = [np.searchsorted(self.keys, t) for t in self.tokens]
        return self

    def rarest(self, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token, item, place) of the rarest tokens of each stretch of an item that is as long as a passage; tokens that occur nowhere count as such, but aren't looked up."""
        found = []
        for item, (unit, own) in enumerate(zip(self.units, self.tokens)):
            n = often[own]
            # rank by rarity, ties by place
            rank = np.argsort(np.argsort(n, kind="stable"), kind="stable")
            stretches = np.lib.stride_tricks.sliding_window_view(rank, unit.window)
            best = np.argpartition(stretches, unit.looked_up - 1, axis=1)[:, : unit.looked_up]
            places = np.unique(best + np.arange(len(best))[:, None])
            places = places[n[places] > 0]
            found.append((own[places], np.full(len(places), item), places))
        return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64) for x in (zip(*found) if found else ((), (), ())))

    @staticmethod
    def sets(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator["Items"]:
        """Test items in sets of about `limit` tokens; they come one partition at a time."""
        rows = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
        one = Items()
        for r in rows.toLocalIterator():
            one.add(r["id"], r["text"])
            if one.size >= limit:
                yield one.close()
                one = Items()
        if one.ids:
            yield one.close()


def longest_passage(item: np.ndarray, doc: np.ndarray, diagonals: set[int], unit: Unit) -> int:
    """Most words (characters) of a passage of item in doc in order and in one piece, with at most one in ten changed; 0 if there is none of the least length.

    Runs of equal tokens near the diagonals are chained, and longer ones on
    other diagonals that changes allow for; between two runs as many tokens
    differ as the longer gap has. A passage starts and ends with a run.
    """
    near = {x for d in diagonals for x in range(d - 4, d + 5)}
    drift = len(item) // ONE_IN
    far = {x for d in diagonals for x in range(d - drift, d + drift + 1)} - near
    # a stretch with enough equal tokens near the diagonals comes first: few candidates have one
    equal = np.zeros(len(item), dtype=bool)
    for d in near:
        lo, hi = max(0, -d), min(len(item), len(doc) - d)
        if hi > lo:
            equal[lo:hi] |= item[lo:hi] == doc[lo + d : hi + d]
    sums = np.concatenate(([0], np.cumsum(equal)))
    if len(item) < unit.window or (sums[unit.window :] - sums[: -unit.window]).max() < unit.whole:
        return 0
    runs: set[tuple[int, int, int]] = set()
    for some, shortest in ((near, 3 - unit.width), (far, STRETCH)):
        for d in some:
            lo, hi = max(0, -d), min(len(item), len(doc) - d)
            if hi - lo < shortest:
                continue
            same = item[lo:hi] == doc[lo + d : hi + d]
            if not same.any():
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
            runs.update((lo + int(a), lo + int(a) + d, int(b - a) + unit.width - 1) for a, b in zip(edges[::2], edges[1::2]) if b - a >= shortest)
    chain = sorted(runs)
    length = len(item) + unit.width - 1
    best = 0
    # from each run on, the fewest changes up to each later run
    for s, (i0, _, _) in enumerate(chain):
        allowed = (length - i0) // ONE_IN
        if length - i0 <= best:
            break
        cost = {s: 0}
        for k in range(s, len(chain)):
            i, j, n = chain[k]
            if k not in cost:
                least = allowed + 1
                for q, spent in cost.items():
                    a, b, m = chain[q]
                    gap_i, gap_j = i - a - m, j - b - m
                    cut = max(0, -gap_i, -gap_j)
                    if cut < n and i + cut > a:
                        least = min(least, spent + max(gap_i, gap_j) + cut)
                if least > allowed:
                    continue
                cost[k] = least
            span = i + n - i0
            if span > best and cost[k] * ONE_IN <= span:
                best = span
    return best if best >= unit.least else 0


def _candidates(postings: tuple, asked: tuple, starts: np.ndarray, items: Items) -> list[tuple[int, int, list[int]]]:
    """(document, item, diagonals) where as many of the asked tokens meet on a diagonal as a passage has."""
    token, doc, place = postings
    order = np.argsort(doc, kind="stable")
    token, doc, place = token[order], doc[order], place[order]
    sizes = starts[token + 1] - starts[token]
    total = np.cumsum(sizes)
    surely = np.array([u.surely for u in items.units])
    found: list[np.ndarray] = []
    a = 0
    while a < len(doc):
        # whole documents, up to the bound or at least one
        b = int(np.searchsorted(total, (total[a - 1] if a else 0) + CHUNK, side="right"))
        b = int(np.searchsorted(doc, doc[max(a, b - 1)], side="left")) if b < len(doc) else len(doc)
        if b <= a:
            b = int(np.searchsorted(doc, doc[a], side="right"))
        at = _ranges(starts[token[a:b]], sizes[a:b])
        met = np.stack((np.repeat(doc[a:b], sizes[a:b]), asked[1][at], np.repeat(place[a:b], sizes[a:b]) - asked[2][at]))
        found += [x for shift in (0, BAND // 2) for x in _bands(met, asked[2][at], shift, surely)]
        a = b
    if not found:
        return []
    every = np.concatenate(found, axis=1)
    every = every[:, np.lexsort((every[2], every[1], every[0]))]
    every = every[:, np.concatenate(([True], (every[:, 1:] != every[:, :-1]).any(axis=0)))]
    first = np.flatnonzero(np.concatenate(([True], (every[:2, 1:] != every[:2, :-1]).any(axis=0))))
    return [(d, i, x.tolist()) for d, i, x in zip(every[0, first].tolist(), every[1, first].tolist(), np.split(every[2], first[1:]))]


def _bands(met: np.ndarray, place: np.ndarray, shift: int, surely: np.ndarray) -> list[np.ndarray]:
    """Of meetings (document, item, diagonal) those in bands of diagonals with enough distinct places of the item."""
    if not met.shape[1]:
        return []
    doc, item, diagonal = met
    key = (doc << 48) ^ (item << 28) ^ ((diagonal + (1 << 31) + shift) // BAND)
    # most bands have few meetings; they fall out without sorting, by a table of counts that others share
    with np.errstate(over="ignore"):
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)
    often = np.bincount(slot.astype(np.int64), minlength=1 << 22)
    there = np.flatnonzero(often[slot.astype(np.int64)] >= surely[item])
    if not len(there):
        return []
    there = there[np.lexsort((place[there], key[there]))]
    own, spot = key[there], place[there]
    new = np.concatenate(([True], own[1:] != own[:-1]))
    fresh = new | np.concatenate(([True], spot[1:] != spot[:-1]))
    first = np.flatnonzero(new)
    enough = np.add.reduceat(fresh.astype(np.int64), first) >= surely[item[there[first]]]
    return [met[:, there[np.repeat(enough, np.diff(np.append(first, len(there))))]]]


def search(index: DataFrame, items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(id, item, n) of documents of an index with the items that they contain a passage of, and its length."""
    found = None
    for one in Items.sets(items, item_id, text, ITEM_TOKENS):
        part = _search(index, one)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return index.sparkSession.createDataFrame([], "id bigint, item bigint, n int")
    return found.groupBy("id", "item").agg(F.max("n").alias("n"))


def _search(index: DataFrame, items: Items) -> DataFrame:
    sc = index.sparkSession.sparkContext
    buckets = sorted({int(b) for b in np.unique(items.keys >> np.uint64(64 - BUCKET_BITS))})
    rows = index.filter(F.col("bucket").isin(buckets))
    # of a size that ITEM_TOKENS bounds
    shared = sc.broadcast(items)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = shared.value.keys
        often = np.zeros(len(keys), dtype=np.int64)
        for b in batches:
            for k, s in zip(b["keys"], b["starts"]):
                row = _Row.read(k, s)
                which, at = row.of(keys)
                often[which] += row.starts[at + 1] - row.starts[at]
        there = np.flatnonzero(often)
        yield pd.DataFrame({"token": there, "n": often[there]})

    # of the index only the tokens are read here, not their places; the result is a row per token of the items
    often = np.zeros(len(items.keys), dtype=np.int64)
    for r in rows.select("keys", "starts").mapInPandas(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect():
        often[r["token"]] = r["n"]
    asked = items.rarest(often)
    order = np.argsort(asked[0], kind="stable")
    asked = tuple(x[order] for x in asked)
    starts = np.searchsorted(asked[0], np.arange(len(items.keys) + 1))
    wanted = sc.broadcast((asked, starts, np.unique(asked[0])))

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Postings of the rarest tokens."""
        rare = wanted.value[2]
        keys = shared.value.keys[rare]
        for b in batches:
            out = []
            for block, k, s, d, p in zip(b["block"], b["keys"], b["starts"], b["docs"], b["places"]):
                which, docs, places = _Row.read(k, s, d, p).postings(keys)
                if len(which):
                    out.append((block, rare[which].astype(np.int32).tobytes(), docs.tobytes(), places.astype(np.uint32).tobytes()))
            yield pd.DataFrame(out, columns=["block", "tokens", "docs", "places"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        postings = _joined(group)
        met = _candidates(postings, wanted.value[0], wanted.value[1], shared.value)
        return pd.DataFrame([(group["block"].iloc[0], d, i, x) for d, i, x in met], columns=["block", "doc", "item", "diagonals"])

    sliced = "block bigint, tokens binary, docs binary, places binary"
    near = stored(rows.select("block", "keys", "starts", "docs", "places").mapInPandas(slices, sliced).groupBy("block").applyInPandas(meet, "block bigint, doc int, item int, diagonals array<int>"))
    # all tokens of the items in the candidates, from the index again
    per_block = near.groupBy("block").agg(F.collect_set("doc").alias("asked"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = shared.value.keys
        for b in batches:
            out = []
            for block, bucket, k, s, d, p, docs_asked in zip(b["block"], b["bucket"], b["keys"], b["starts"], b["docs"], b["places"], b["asked"]):
                if bucket < 0:
                    out.append((block, None, d, None))
                    continue
                which, docs, places = _Row.read(k, s, d, p).postings(keys)
                keep = np.isin(docs, np.asarray(docs_asked, dtype=np.uint16))
                if keep.any():
                    out.append((block, which[keep].astype(np.int32).tobytes(), docs[keep].tobytes(), places[keep].astype(np.uint32).tobytes()))
            yield pd.DataFrame(out, columns=["block", "tokens", "docs", "places"])

    def align(group: pd.DataFrame, cases: pd.DataFrame) -> pd.DataFrame:
        query = shared.value
        ids = np.frombuffer(group["docs"][group["tokens"].isna()].iloc[0], dtype=np.int64)
        token, doc, place = _joined(group[group["tokens"].notna()])
        order = np.argsort(doc, kind="stable")
        token, doc, place = token[order], doc[order], place[order]
        of_unit = np.zeros(len(query.keys), dtype=bool)
        for unit, own in zip(query.units, query.tokens):
            if unit == CHARACTERS:
                of_unit[own] = True
        out = []
        for d, its in cases.groupby("doc"):
            a, b = np.searchsorted(doc, [d, d + 1])
            texts = {}
            for unit in (WORDS, CHARACTERS):
                own = of_unit[token[a:b]] == (unit == CHARACTERS)
                t, p = token[a:b][own], place[a:b][own]
                line = np.full(int(p.max()) + 1 if len(p) else 0, -1, dtype=np.int64)
                line[p] = t
                texts[unit.name] = line
            for item, diagonals in zip(its["item"], its["diagonals"]):
                unit = query.units[item]
                n = longest_passage(query.tokens[item], texts[unit.name], set(map(int, diagonals)), unit)
                if n:
                    out.append((ids[d], query.ids[item], n))
        return pd.DataFrame(out, columns=["id", "item", "n"])

    full = index.filter(F.col("bucket").isin([-1, *buckets])).join(per_block, "block").mapInPandas(whole, sliced)
    cases = near.select(F.col("block").alias("of"), "doc", "item", "diagonals")
    return full.groupBy("block").cogroup(cases.groupBy("of")).applyInPandas(align, "id bigint, item bigint, n int")


def _joined(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, document, place) of slices, one after the other."""
    kinds = {"tokens": np.int32, "docs": np.uint16, "places": np.uint32}
    return tuple(np.concatenate([np.frombuffer(x, dtype=t) for x in group[c]]).astype(np.int64) if len(group) else np.zeros(0, dtype=np.int64) for c, t in kinds.items())


def leaked_items(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """Documents that contain a passage of a test item, each with the item.

    A passage has at least 20 words (in scripts without spaces 60 characters) of
    the item in order and in one piece, where up to one in ten may be changed,
    added or dropped. Case, punctuation, spacing, line breaks, character forms
    and inline markup don't matter. Whole texts are searched, whatever their
    length.

    Null texts and items, and items shorter than a passage, give no rows; items
    of equal text are found each; documents of equal text are found each by
    their id; a repeated (id, text) gives one row. An empty table on either side
    gives an empty table. Extra columns are ignored.

    Returns doc_id, item_id, n_tokens (the longest passage).
    """
    found = search(build_index(documents, doc_id, text), items, item_id, item_text)
    return found.select(F.col("id").alias(doc_id), F.col("item").alias(item_id), F.col("n").alias("n_tokens"))
