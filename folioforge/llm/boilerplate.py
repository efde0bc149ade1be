"""Main content of web pages, and the furniture around it.

Each page is parsed once. A tree builder with visibility rules renders all
visible text; every visible line knows its source line and the blocks around
it. In markup the block that holds the headline is the content, all else is
furniture. What lines stand outside of it, page after page of a host, is that
host's lexicon; it tells furniture apart where there is no markup: in plain
text dumps, in excerpts, and for promotion set into the content.

The lexicon is a table, a row per host and line, joined to the pages by host:
what is furniture on a page depends on the pages of its own host only.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.dom import parse
from folioforge.functions.url import host_of
from folioforge.llm.rendering import content_block, layout, plain_steps, read, style_of
from folioforge.session import stored

#: A line is in a host's lexicon if it stands on this share of the host's marked-up pages at least, and on two. It bounds
#: the lexicon of a host, whatever the number of its pages: lines per page / share.
LEAST_SHARE = 0.001
#: A line of the lexicon on fewer pages, and on a smaller share of them, may be the reference of others to a page's headline.
FEW, FEW_SHARE = 5, 0.01
#: pages of one host are dealt with in parts of so many characters, each with the host's lexicon
PART_SIZE = 4_000_000

_SEPARATOR = re.compile(r"\s*[|·•・»>]\s*|\s+[/—–-]\s+|\s{2,}|\t")
_DATE = re.compile(
    r"^\W*(?:\w{2,10}\.?, )?(?:\d{4}\s?[-./년年]\s?\d{1,2}\s?[-./월月]\s?\d{1,2}|\d{1,2}[./-]\d{1,2}[./-]\d{4}|\d{1,2}\.?(?:er)? [^\W\d]{3,10}\.? \d{4}|[^\W\d]{3,10}\.? \d{1,2}, \d{4})\D{0,3}.{0,20}$"
)
#: a label before a reference to another page, as in "Read also: ..."
_LABEL = re.compile(r"^([^:：▶►→]{2,30}?)\s?[:：▶►→]\s*\S")
_CJK = re.compile(r"[぀-ヿ一-鿿]")
_KANA = re.compile(r"[぀-ヿ]")
_SENTENCE_END = re.compile(r"[.!?。！？…」』”»\"']$")
_SENTENCE_START = re.compile(r"[.!?。！？…|·•・»>/]\s*|\s[—–-]\s")
_LIST_ITEM = re.compile(r"^[-*•‣◦] ")
_MARKUP = re.compile(r"\s*<(?:!doctype|html|head|body|div|table|article|section|main|p|nav|h1)\b", re.I)
_NUMBER = re.compile(r"\d+(?:[.,  ]\d+)*")
#: where the lexicon is looked up by the first or last letters of its entries
_STEM = 5

INSIDE, STYLED, HEADLINE = 1, 2, 4
OUT_TERM, IN_TERM, STYLED_TERM, HEADLINE_TERM = 1, 2, 4, 8
LINES = "id bigint, host string, excerpt string, has_text boolean, size bigint, parted boolean, nos array<int>, texts array<string>, marks array<int>, terms array<bigint>, kinds array<int>, names array<string>"
STEPS = "ops array<int>, op_lines array<int>, op_texts array<string>"


@lru_cache(maxsize=100_000)
def template(text: str) -> str:
    """Line with numbers as 0 and single spaces."""
    return _NUMBER.sub("0", " ".join(text.split()))


@lru_cache(maxsize=100_000)
def key_of(text: str) -> int:
    """64-bit hash of a template of any length, as a signed number."""
    h = xxhash.xxh3_64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def label(text: str) -> str | None:
    """Key of the label that a line starts with."""
    m = _LABEL.match(text)
    return None if m is None else "\u0001" + template(m.group(1))


def segments(text: str) -> list[str]:
    return [s for s in _SEPARATOR.split(text.strip()) if s]


def is_markup(document: str) -> bool:
    return _MARKUP.match(document) is not None


@dataclass(slots=True)
class Page:
    """Visible lines of a page with their marks; `parted` if its markup parts content from the rest."""

    nos: list[int]
    texts: list[str]
    marks: list[int]
    parted: bool
    steps: list = field(default_factory=list)


def read_page(document: str, steps: bool = False) -> Page:
    if not is_markup(document):
        lines = [(n, x.strip(" \t\r\f\v")) for n, x in enumerate(document.split("\n"), 1) if x.strip()]
        return Page([n for n, _ in lines], [t for _, t in lines], [0] * len(lines), False, plain_steps(lines) if steps else [])
    root = parse(document)
    block = content_block(root)
    reading = read(root, block, steps)
    nos = sorted(reading.lines)
    lines = [reading.lines[n] for n in nos]
    parted = block is not None and not all(x.inside for x in lines)
    marks = [HEADLINE if x.headline else 0 for x in lines]
    if parted:
        # classes of blocks outside, which a line of the content has too
        outer = {style_of(x.block.tag, x.block.attrs) for x in lines if not x.inside} - {""}
        for k, x in enumerate(lines):
            if x.inside:
                marks[k] |= INSIDE | (STYLED if x.block is not block and style_of(x.block.tag, x.block.attrs) in outer else 0)
    return Page(nos, [x.text() for x in lines], marks, parted, reading.steps)


def terms_of(page: Page) -> tuple[list[int], list[int], list[str | None]]:
    """What a page tells about its host's furniture: keys of templates, where they stand, and their text unless they are content only."""
    where: dict[str, int] = {}
    for text, mark in zip(page.texts, page.marks):
        t = template(text)
        if mark & INSIDE:
            kind = IN_TERM | (STYLED_TERM if mark & STYLED else 0) | (HEADLINE_TERM if mark & HEADLINE else 0)
            for own in (t, label(text)):
                if own is not None:
                    where[own] = where.get(own, 0) | kind
        else:
            where[t] = where.get(t, 0) | OUT_TERM
            # the terms of a menu; two parts may be a title, and so may be the end of a trail
            parts = segments(text)
            if len(parts) > 2 and ">" not in text and "»" not in text:
                for p in map(template, parts):
                    where[p] = where.get(p, 0) | OUT_TERM
    return [key_of(t) for t in where], list(where.values()), [t if k & ~(IN_TERM | HEADLINE_TERM) else None for t, k in where.items()]


def lines_of(pages: DataFrame, page_id: str, url: str | None, html_column: str, excerpt: str | None, steps: bool = False) -> DataFrame:
    """A row per page with its visible lines, each page parsed once; a written table, as it is read several times."""

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in LINES.split(", ")] + ([c.split()[0] for c in STEPS.split(", ")] if steps else [])
        for b in batches:
            rows = []
            for i, host, short, document in zip(b["id"], b["host"], b["excerpt"], b["html"]):
                page = read_page(document, steps) if document else Page([], [], [], False)
                terms = terms_of(page) if page.parted else ([], [], [])
                row = (i, host, short, document is not None, len(document or "") + len(short or ""), page.parted, page.nos, page.texts, page.marks, *terms)
                rows.append((*row, *map(list, zip(*page.steps))) if steps and page.steps else (*row, [], [], []) if steps else row)
            yield pd.DataFrame(rows, columns=names).astype({"id": "Int64"})

    host = F.coalesce(host_of(F.col(url)), F.lit("")) if url else F.lit("")
    short = F.col(excerpt) if excerpt else F.lit(None).cast("string")
    rows = pages.select(F.col(page_id).cast("bigint").alias("id"), host.alias("host"), short.alias("excerpt"), F.col(html_column).alias("html"))
    return stored(rows.mapInPandas(render, LINES + (", " + STEPS if steps else "")))


def host_sizes(read_: DataFrame) -> DataFrame:
    """A row per host: its marked-up pages, and the parts that its pages are dealt with in."""
    sizes = read_.groupBy("host").agg(F.count_if("parted").alias("n_parted"), F.sum("size").alias("size"))
    return sizes.select("host", "n_parted", F.greatest(F.ceil(F.col("size") / PART_SIZE), F.lit(1)).alias("parts"))


def lexicon(read_: DataFrame, sizes: DataFrame) -> DataFrame:
    """Lexicons of all hosts: host, term, name, furniture, rare. name is null for what stands in contents only, headlines apart.

    Numbers are counted, text is joined to what is left: so the aggregations are
    by hash, and a template of any length costs the same.
    """
    each = read_.filter("parted").select("host", F.explode(F.arrays_zip("terms", "kinds", "names")).alias("t")).select("host", F.col("t.terms").alias("term"), F.col("t.kinds").alias("kind"), F.col("t.names").alias("name"))
    on = lambda bit: F.sum(F.when(F.col("kind").bitwiseAND(bit) > 0, 1).otherwise(0))
    counted = each.groupBy("host", "term").agg(on(OUT_TERM).alias("outside"), on(IN_TERM).alias("inside"), on(STYLED_TERM).alias("styled"), on(HEADLINE_TERM).alias("headlines"))
    usual = counted.join(sizes, "host").filter(F.col("outside") + F.col("inside") >= F.greatest(F.lit(2.0), LEAST_SHARE * F.col("n_parted")))
    furniture = (F.col("outside") > 9 * F.col("inside")) | (F.col("styled") >= F.greatest(F.lit(2.0), 0.1 * F.col("inside")))
    told = usual.select("host", "term", furniture.alias("furniture"), (F.col("outside") < F.greatest(F.lit(float(FEW)), FEW_SHARE * F.col("n_parted"))).alias("rare"), "outside", "headlines").filter("furniture or (outside = 0 and headlines = 0)")
    named = each.filter("name is not null").select("host", "term", "name").distinct()
    return told.join(named, ["host", "term"], "left").select("host", "term", "name", "furniture", "rare")


class Lexicon:
    """Lexicon of one host. furniture: templates that are furniture wherever they stand; rare: those on few pages, as titles that others list are; body: keys of what stands in contents only."""

    def __init__(self, terms, names, furniture, rare) -> None:
        self.rare = frozenset(n for n, f, r in zip(names, furniture, rare) if f and r and isinstance(n, str))
        self.furniture = frozenset(n for n, f in zip(names, furniture) if f and isinstance(n, str))
        self.body = frozenset(int(t) for t, f in zip(terms, furniture) if not f)
        # furniture that is enough by itself: of some words, or of some letters where words aren't parted
        long = sorted(f for f in self.furniture if len(f) >= _STEM and f[0] != "\u0001" and (" " in f or _CJK.match(f)))
        self.starts: dict[str, list[str]] = {}
        self.ends: dict[str, list[str]] = {}
        for f in long:
            self.starts.setdefault(f[:_STEM], []).append(f)
            self.ends.setdefault(f[-_STEM:], []).append(f)

    def holds(self, text: str) -> bool:
        """Whether a line is furniture: itself, by its label, in all its segments, or, as a trail to the page, in all but the last; or word by word."""
        if template(text) in self.furniture or label(text) in self.furniture:
            return True
        parts = segments(text)
        if len(parts) > 1:
            known = [template(p) in self.furniture for p in parts]
            if all(known) or (len(parts) > 2 and all(known[:-1])) or (len(parts) == 2 and known[0] and ">" in text):
                return True
        words = text.split()
        return len(words) > 2 and self._run(words) == len(words)

    def _run(self, words: list[str]) -> int:
        """How many words from the first are a run of furniture terms."""
        at = 0
        while at < len(words):
            step = next((n for n in (4, 3, 2, 1) if at + n <= len(words) and template(" ".join(words[at : at + n])) in self.furniture), 0)
            if not step:
                break
            at += step
        return at

    def in_excerpt(self, excerpt: str, headline: str = "") -> bool:
        """Whether an excerpt contains furniture: a furniture line of some length, or two terms of a menu side by side.

        The page's own headline is none, though other pages may list it.
        """
        raw = html.unescape(excerpt).strip()
        text = " ".join(raw.split()).rstrip("…").strip()
        if not text or headline.startswith(text):
            return False
        if template(text) in self.furniture or self.holds(raw):
            return True
        parts = segments(raw)
        known = [template(p) in self.furniture for p in parts]
        if any(a and b for a, b in zip(known, known[1:])) or any(k and len(p) >= _STEM for k, p in zip(known, parts)):
            return True
        plain, own = template(text), template(headline)
        # at the end, after a space or, in scripts without spaces, after any letter
        for f in self.ends.get(plain[-_STEM:], ()):
            if plain.endswith(f) and f != own and len(f) < len(plain) and (not plain[-len(f) - 1].isalnum() or _CJK.match(f)):
                return True
        # furniture may run into the text, so it is looked for wherever a sentence or a segment starts
        for s in {0} | {m.end() for m in _SENTENCE_START.finditer(plain)}:
            words = plain[s:].split(" ", 40)
            if len(words) > 1 and _KANA.search(words[0]) and words[0] in self.furniture:
                return True  # text in this script has no spaces, so the term stands alone
            run = self._run(words)
            if run > 1 and len(" ".join(words[:run])) >= _STEM:
                return True
            for f in self.starts.get(plain[s : s + _STEM], ()):
                end = s + len(f)
                if len(f) >= 8 and f != own and plain.startswith(f, s) and (end == len(plain) or not plain[end].isalnum() or _CJK.match(f)):
                    return True
        return False


def furniture_of(nos, texts, marks, parted: bool, lexicon_: Lexicon) -> list[bool]:
    """For each visible line whether it is furniture."""
    if parted:
        return [not m & INSIDE or (not m & HEADLINE and bool(m & STYLED or lexicon_.holds(t))) for t, m in zip(texts, marks)]
    known = [lexicon_.holds(t) for t in texts]
    # without structure: the line before the date is the headline, what comes before it is furniture
    dates = [n for n, t in enumerate(texts) if n and len(t) < 45 and not known[n] and _DATE.match(t) and not _LIST_ITEM.match(t) and template(t) not in lexicon_.furniture]

    def body_like(n: int) -> bool:
        t = texts[n]
        return not known[n] and (key_of(template(t)) in lexicon_.body or bool(_LIST_ITEM.match(t)) or (len(t) > 15 and bool(_SENTENCE_END.search(t))) or len(t) > 90)

    if dates:
        start = dates[0] - 1
        first = dates[0]
    else:
        first = next((n for n in range(len(texts)) if body_like(n)), len(texts))
        start = max(0, first - 1) if first < len(texts) else 0
        if first < len(texts) and start < first and known[start] and template(texts[start]) not in lexicon_.rare:
            start = first
    last = max((n for n in range(first, len(texts)) if body_like(n)), default=first)
    # up to the first furniture after the last line that is text for sure
    end = next((n for n in range(last + 1, len(texts)) if known[n]), len(texts))
    return [n < start or n >= end or (known[n] and n != start) for n in range(len(texts))]


def _by_host(read_: DataFrame, columns: list[str], judge, schema: str) -> DataFrame:
    """judge(pages, lexicon) over parts of the pages of each host, each with the host's lexicon.

    A host with a third of all pages has as many parts as its size asks for.
    """
    sizes = host_sizes(read_)
    words = lexicon(read_, sizes).join(sizes.select("host", "parts"), "host")
    words = words.select(F.col("host").alias("of"), F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("of_part"), "term", "name", "furniture", "rare")
    parted = read_.join(sizes.select("host", "parts"), "host").withColumn("part", F.pmod(F.xxhash64("id", "size"), F.col("parts")).cast("int"))

    def each(pages: pd.DataFrame, terms: pd.DataFrame) -> pd.DataFrame:
        return judge(pages, Lexicon(terms["term"], terms["name"], terms["furniture"], terms["rare"]))

    return parted.select("host", "part", *columns).groupBy("host", "part").cogroup(words.groupBy("of", "of_part")).applyInPandas(each, schema)


def page_furniture(pages: DataFrame, page_id: str, html_column: str, excerpt: str, url: str | None = None) -> DataFrame:
    """Lines of pages that are furniture.

    Returns page_id, line_no: source lines from 1, and 0 for an excerpt that
    contains furniture. A null or empty page and a page without visible text
    have no lines; a null or empty excerpt is no case. A page whose markup has
    no headline is treated like plain text. Repeated pages count each. Lines of
    any length, any number of lines and any depth of nesting are read whole.
    Pages are told apart by the host of `url`; those without one, or without
    such a column, are of one host. An empty table gives an empty table. Extra
    columns are ignored.
    """

    def judge(group: pd.DataFrame, words: Lexicon) -> pd.DataFrame:
        ids, lines = [], []
        for page_no, short, parted, nos, texts, marks in zip(group["id"], group["excerpt"], group["parted"], group["nos"], group["texts"], group["marks"]):
            furniture = furniture_of(nos, texts, marks, parted, words)
            cases = [n for n, f in zip(nos, furniture) if f]
            # the first line of the content
            if short and words.in_excerpt(short, next((t for t, f in zip(texts, furniture) if not f), "")):
                cases.append(0)
            ids += [page_no] * len(cases)
            lines += cases
        return pd.DataFrame({"id": pd.array(ids, dtype="Int64"), "line": pd.array(lines, dtype="Int32")})

    read_ = lines_of(pages, page_id, url, html_column, excerpt)
    found = _by_host(read_, ["id", "excerpt", "parted", "nos", "texts", "marks"], judge, "id bigint, line int")
    return found.select(F.col("id").alias(page_id), F.col("line").alias("line_no"))


def main_text(pages: DataFrame, page_id: str, html_column: str, url: str | None = None) -> DataFrame:
    """Text of each page without furniture, laid out; null for a null page, '' for one without content.

    Returns page_id, main_text, a row per page. Pages are treated as in
    `page_furniture`.
    """

    def judge(group: pd.DataFrame, words: Lexicon) -> pd.DataFrame:
        out = []
        for there, parted, nos, texts, marks, ops, op_lines, op_texts in zip(group["has_text"], group["parted"], group["nos"], group["texts"], group["marks"], group["ops"], group["op_lines"], group["op_texts"]):
            furniture = furniture_of(nos, texts, marks, parted, words)
            keep = {int(n) for n, f in zip(nos, furniture) if not f}
            out.append(layout(list(zip(ops, op_lines, op_texts)), keep) if there else None)
        return pd.DataFrame({"id": group["id"], "text": out}).astype({"id": "Int64"})

    read_ = lines_of(pages, page_id, url, html_column, None, steps=True)
    text = _by_host(read_, ["id", "has_text", "parted", "nos", "texts", "marks", "ops", "op_lines", "op_texts"], judge, "id bigint, text string")
    return text.select(F.col("id").alias(page_id), F.col("text").alias("main_text"))
