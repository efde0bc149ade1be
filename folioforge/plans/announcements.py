"""Problem 3: which post of the blogs a post of the channel announces.

The channel has a hand-written title and a time, the post a url, a time and,
if its page was saved, a title. What they share is noisy: the name in the slug
by sound, the wording by language and kind, the title letter by letter, the
numbers, and the time.
"""

from __future__ import annotations

import html
import re
import unicodedata as ud
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.phonetic import LETTERS, contains_near, ngrams, readings, script, sounds
from folioforge.functions.text import once
from folioforge.operators.entity_match import best_match, match_marginals
from folioforge.operators.snapshots import small
from folioforge.plans.problems import channel_instants, post_instants, post_key
from folioforge.session import checkpoint
from folioforge.sources.tables import Blogs, table

HOUR = 3_600_000
#: an announcement is looked for from so many hours before to so many hours after publication
BEFORE, AFTER = 36, 84
#: the blogs publish the same slug within so many hours of each other, but for a few that were used again
SIBLINGS = 48
#: titles that the wording model is fitted on at most, and the number of hashed features
MODEL_TITLES, MODEL_FEATURES = 20_000, 1 << 13
#: lengths of the stretches of sounds that titles are cut into; shorter ones say too little
PIECES = (3, 4)
#: pairs whose own evidence is below these log-odds are rejected by it; messages of others only lower them further
LEAST_WEIGHT = -6.0
#: letters of a name that are looked up with one of them changed
CORES = (5, 6)
#: titles and posts of a block of pairs at most; a stretch of time with more of them is dealt out to several
BLOCK_TITLES, BLOCK_POSTS = 8_000, 20_000
#: words of 64 bits in which the letter pairs of a title are marked
MARKS = 4

_DATE = r"(?:\d{4}\s?[-./년年]\s?\d{1,2}\s?[-./월月]\s?\d{1,2}|\d{1,2}[./-]\d{1,2}[./-]\d{4}|\d{1,2}\.?(?:er)? \p{L}{3,9}\.? \d{4}|\p{L}{3,9}\.? \d{1,2}, \d{4})"
_SHOWN_MARKUP = rf"(?s)</h1>\s*(?:<[^>]*>\s*)*({_DATE}[^<\n]{{0,25}})"
_HEADLINE = rf"(?m)^[ \t]*(\S[^\n]*?)[ \t]*\n\s*{_DATE}[^\n]{{0,25}}$"
_SHOWN_TEXT = rf"(?m)^[ \t]*\S[^\n]*?[ \t]*\n\s*({_DATE}[^\n]{{0,25}})$"


def shown_headline_and_date(page: str) -> tuple[Column, Column]:
    """The headline of a text dump, and the date that a page shows below its headline; null where there is none."""
    headline = F.nullif(F.regexp_extract(page, _HEADLINE, 1), F.lit(""))
    return headline, F.coalesce(F.nullif(F.regexp_extract(page, _SHOWN_MARKUP, 1), F.lit("")), F.nullif(F.regexp_extract(page, _SHOWN_TEXT, 1), F.lit("")))


def kind_of(slug: str) -> str:
    return slug.split("-")[0]


def _features(title: str) -> list[int]:
    flat = re.sub(r"\d+", "0", re.sub(r"[^\w]+", " ", ud.normalize("NFKC", title).lower()))
    flat = f" {flat.strip()} "
    grams = {flat[i : i + n] for n in (2, 3) for i in range(len(flat) - n + 1)}
    return sorted({hash_of(g) % MODEL_FEATURES for g in grams})


def hash_of(text: str) -> int:
    """64-bit FNV-1a, the same in every process."""
    h = 0xCBF29CE484222325
    for b in text.encode():
        h = ((h ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return h


def fit_wording(titles: DataFrame) -> tuple[list[str], np.ndarray]:
    """Naive Bayes of title wording by `lang|kind`, fitted on at most MODEL_TITLES titles.

    Returns the classes and their log-likelihoods by feature; its size doesn't
    depend on the data.
    """
    sample = titles.select("lang", "slug", "title").orderBy(F.xxhash64("lang", "slug")).limit(MODEL_TITLES).collect()
    counts: dict[str, np.ndarray] = {}
    kinds: dict[str, int] = {}
    for r in sample:
        kinds[kind_of(r["slug"])] = kinds.get(kind_of(r["slug"]), 0) + 1
    usual = {k for k, n in kinds.items() if n >= max(3, len(sample) // 200)}
    for r in sample:
        label = f"{r['lang']}|{kind_of(r['slug']) if kind_of(r['slug']) in usual else ''}"
        row = counts.setdefault(label, np.zeros(MODEL_FEATURES, dtype=np.float32))
        row[_features(_clean(r["title"]))] += 1
    labels = sorted(counts)
    if not labels:
        return [], np.zeros((0, MODEL_FEATURES), dtype=np.float32)
    table_ = np.stack([counts[c] for c in labels]) + 0.05
    return labels, np.log(table_ / table_.sum(axis=1, keepdims=True))


def _script_of_lang(lang: str) -> str:
    return lang if lang in ("ko", "ja") else "la"


def edits_of(own: str) -> int:
    """How many letters of a name's sounds may differ in a title."""
    return 2 if len(own) > 8 else 1 if len(own) > 4 else 0


def name_pieces(name: str) -> set[str]:
    """Stretches of sounds of which a title has one if it has the name with at most `edits_of` letters changed, added or dropped.

    Of one part more than there are edits one is left whole. Of five letters the
    middle one is in both parts, so its changes are spelled out.
    """
    return _pieces(sounds(name))


def _pieces(own: str) -> set[str]:
    edits, longest = edits_of(own), PIECES[-1]
    if len(own) < PIECES[0]:
        return set()
    if len(own) == 5:
        return {own[:3], own[2:]} | {(own[:2] + x + own[3:])[:longest] for x in ("", *LETTERS)}
    cuts = [k * len(own) // (edits + 1) for k in range(edits + 2)]
    return {own[a:b][:longest] for a, b in zip(cuts, cuts[1:])}


def plain_title(title: str) -> str:
    """title without marks and labels at its start: in brackets, or a word in capitals before a colon or exclamation mark."""
    title = re.sub(r"^\W*[A-ZÀ-Þ]{2,9}\s?[:!]\s+", "", title)
    return re.sub(r"^(?:[^\w\[【(「“„]*(?:\[[^\]]*\]|【[^】]*】|\([^)]*\)))?[^\w「“„]*", "", title) or title


@lru_cache(maxsize=50_000)
def _clean(text: str) -> str:
    """Text without entities, in one form of characters."""
    return ud.normalize("NFKC", html.unescape(text))


@lru_cache(maxsize=50_000)
def _numbers(text: str) -> frozenset[str]:
    return frozenset(x.lstrip("0") or "0" for x in re.findall(r"\d+", text))


@lru_cache(maxsize=50_000)
def _told(title: str) -> tuple[frozenset[str], frozenset[str], bool]:
    """What a title says besides its labels: letter pairs, numbers, and whether it is in Latin letters."""
    plain = plain_title(title)
    return ngrams(plain), _numbers(plain), script(plain) == "la"


@lru_cache(maxsize=50_000)
def _spoken(name: str, lang: str) -> tuple[str, ...]:
    return tuple(sounds(x) for x in readings(name, _script_of_lang(lang)))


def pair_weight(title: str, name: str, slug: str, lang: str, post_title: str | None, hours: float | None, exact: bool, likely: dict[str, float]) -> float:
    """Log-odds that title announces the post, from its own evidence."""
    w = -3.0
    # time: most announcements follow within hours; without a published time the day is known, or not even that
    if exact:
        w += 2.0 if -1 <= hours <= 14 else 1.0 if -30 <= hours <= 74 else -4.0
    elif hours is not None:
        w += 0.5 if -BEFORE - SIBLINGS <= hours <= AFTER + SIBLINGS else -3.5
    heard, spoken = sounds(title), _spoken(name, lang)
    # the reading that is heard best
    own = next((x for k in range(3) for x in spoken if (k == 0 and x in heard) or 0 < k <= edits_of(x) and contains_near(heard, x, k)), spoken[0])
    told, said, latin = _told(title)
    other = ngrams(post_title) if post_title is not None else frozenset()
    if len(own) > 2 and own in heard:
        w += 4.0 if len(own) > 3 else 3.5
    elif edits_of(own) and contains_near(heard, own, 1):
        w += 2.5
    elif edits_of(own) > 1 and contains_near(heard, own, 2):
        w += 1.5
    elif post_title is not None and len(told - other) <= (2 if latin else 1):
        # nothing but what the post's title says: the name was left out or cut off
        w -= 0.5
    else:
        # the title speaks of something else
        w -= 5.0 if post_title is not None else 3.5
    # wording: language and kind
    if likely:
        kind = f"{lang}|{kind_of(slug)}"
        mine = likely[kind] if kind in likely else likely.get(lang, -40.0)
        w += max(-1.5, 1.0 + 0.2 * mine)
    if post_title is not None:
        s = len(told & other) / max(1, min(len(told), len(other)))
        w += max(-3.0, min(3.0, 8 * (s - 0.4)))
    # numbers count where the slug states them: chapters and versions, not the number of a repeated notice
    if said:
        stated = _numbers(post_title if post_title is not None else slug)
        w += 1.0 if said <= stated else -2.0 if stated else 0.0
    return w


@lru_cache(maxsize=50_000)
def name_forms(own: str) -> frozenset[str]:
    """Forms of a name's sounds, of which `title_forms` has one if the title has them within `edits_of` letters.

    One edit: the first letters, as many as CORES says, with one dropped, with one replaced by `?`, and after `+` as
    they are, to be met by a stretch that has one more. No edit or two: the parts that are left whole.
    """
    if edits_of(own) != 1:
        return frozenset(_pieces(own))
    core = own[: CORES[-1]]
    inner = range(1, len(core) - 1)
    return frozenset([core[:i] + core[i + 1 :] for i in range(len(core))] + [core[:i] + "?" + core[i + 1 :] for i in inner] + ["+" + core])


def title_forms(heard: str) -> set[str]:
    n = len(heard)
    forms = {heard[i : i + k] for k in {*PIECES, *(c - 1 for c in CORES)} for i in range(n - k + 1)}
    for core in CORES:
        for at in range(n - core + 1):
            part = heard[at : at + core + 1]
            for i in range(1, core - 1):
                forms.add(part[:i] + "?" + part[i + 1 : core])
            if len(part) > core:
                for i in range(1, core):
                    forms.add("+" + part[:i] + part[i + 1 :])
    return forms


@lru_cache(maxsize=100_000)
def _mark(pair: str) -> int:
    return hash_of(pair) % (64 * MARKS)


def _marked(pairs: frozenset[str]) -> list[int]:
    words = [0] * MARKS
    for bit in map(_mark, pairs):
        words[bit // 64] |= 1 << bit % 64
    return words


class _Posts:
    """The posts of a block in one script, to look titles up in: by the sounds of their names, and by their titles."""

    def __init__(self, b: pd.DataFrame):
        self.no, self.first, self.last = b["no"].to_numpy(), b["first"].to_numpy(), b["last"].to_numpy()
        self.named: dict[str, list[int]] = {}
        self.forms: dict[str, list[str]] = {}
        for i, (name, lang) in enumerate(zip(b["name"], b["lang"])):
            for own in set(_spoken(name, lang)):
                if own not in self.named:
                    self.named[own] = []
                    for form in name_forms(own):
                        self.forms.setdefault(form, []).append(own)
                self.named[own].append(i)
        self.known = set(self.forms)
        titled = [(i, _clean(t)) for i, t in enumerate(b["text"]) if isinstance(t, str)]
        self.titled, self.titles = np.array([i for i, _ in titled], dtype="int64"), [t for _, t in titled]
        self.marks = ~np.array([_marked(ngrams(t)) for t in self.titles], dtype="uint64").reshape(-1, MARKS)

    def heard(self, title: str) -> list[int]:
        """Posts whose name the title has, as the weights hear it."""
        text, out = sounds(title), []
        owns = {own for form in self.known & title_forms(text) for own in self.forms[form]}
        for own in owns:
            # forms of one edit tell all of a name that is no longer than they are
            if (edits_of(own) == 1 and len(own) <= CORES[-1]) or own in text or any(contains_near(text, own, k) for k in range(1, edits_of(own) + 1)):
                out += self.named[own]
        return out

    def within(self, title: str) -> list[int]:
        """Posts whose title has three letters of this one and all that it says, but for what the weights allow."""
        told, _, latin = _told(title)
        letters, most = ngrams(plain_title(title), 3), 2 if latin else 1
        if not len(self.titled) or not letters:
            return []
        near = np.bitwise_count(self.marks & np.array(_marked(told), dtype="uint64")).sum(axis=1) <= most
        return [int(self.titled[k]) for k in np.flatnonzero(near) if len(told - ngrams(self.titles[k])) <= most and letters & ngrams(self.titles[k], 3)]


def _pairs_of_block(b: pd.DataFrame) -> pd.DataFrame:
    posts, titles = b[b["post"]], b[~b["post"]]
    own = posts["lang"].map(_script_of_lang)
    lists: dict[str, _Posts] = {}
    found: list[np.ndarray] = [np.zeros((2, 0), dtype="int64")]
    for no, ms, text in zip(titles["no"], titles["first"], titles["text"]):
        title = _clean(text)
        kind = script(title)
        if kind not in lists:
            lists[kind] = _Posts(posts[own == kind])
        at = lists[kind]
        near = np.unique(np.array(at.heard(title) + at.within(title), dtype="int64"))
        near = near[(at.first[near] <= ms) & (ms <= at.last[near])]
        found.append(np.stack([np.full(len(near), no, dtype="int64"), at.no[near]]))
    both = np.concatenate(found, axis=1)
    return pd.DataFrame({"title_no": both[0], "post_no": both[1]})


def pairs_of_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of the titles and posts of each block; a block's rows follow each other, its posts first."""
    held: list[pd.DataFrame] = []
    for b in batches:
        ends = np.flatnonzero((b[["bucket", "rows", "cols"]].diff().iloc[1:] != 0).any(axis=1).to_numpy()) + 1
        for part in (b.iloc[i:j] for i, j in zip([0, *ends], [*ends, len(b)])):
            if held and len(part) and tuple(held[-1][["bucket", "rows", "cols"]].iloc[-1]) != tuple(part[["bucket", "rows", "cols"]].iloc[0]):
                yield _pairs_of_block(pd.concat(held))
                held = []
            if len(part):
                held.append(part)
    if held:
        yield _pairs_of_block(pd.concat(held))


def candidate_pairs(posts: DataFrame, channel: DataFrame) -> DataFrame:
    """(title_no, post_no) of titles and posts in one script, at a time that allows for it, that the weights may accept.

    That is, the title has the post's name or nothing that the post's title has not; the weights of all others stay
    below -1 whatever else speaks for them. Titles and posts are brought together by time, in blocks of bounded size,
    so what is shuffled grows as the tables and not as their pairs.
    """
    width, far = (BEFORE + AFTER) * HOUR, (1 << 62)
    bucket = lambda c: F.floor(c / F.lit(width))
    at, until = F.col("at").cast("bigint"), F.col("until").cast("bigint")
    # posts without a day meet the titles of all times up to their bound, in a bucket of their own
    open_ = -far
    held = posts.select(F.lit(True).alias("post"), F.col("post_no").alias("no"), "lang", "name", F.col("post_title").alias("text"), F.coalesce(at - BEFORE * HOUR, F.lit(-far)).alias("first"), F.when(at.isNotNull(), at + AFTER * HOUR).otherwise(F.coalesce(until + AFTER * HOUR, F.lit(far))).alias("last"))
    held = held.withColumn("bucket", F.explode(F.when(F.col("first") == -far, F.array(F.lit(open_))).otherwise(F.array_distinct(F.array(bucket(F.col("first")), bucket(F.col("last")))))))
    asked = channel.select(F.lit(False).alias("post"), F.col("title_no").alias("no"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("name"), F.col("title").alias("text"), F.col("ms").cast("bigint").alias("first"), F.col("ms").cast("bigint").alias("last"))
    asked = asked.withColumn("bucket", F.explode(F.array(bucket(F.col("first")), F.lit(open_))))
    # buckets that have both, and the blocks that they are dealt out to
    counts = held.groupBy("bucket").agg(F.count("*").alias("n_posts")).join(asked.groupBy("bucket").agg(F.count("*").alias("n_titles")), "bucket")
    counts = counts.select("bucket", F.ceil(F.col("n_titles") / BLOCK_TITLES).cast("int").alias("n_rows"), F.ceil(F.col("n_posts") / BLOCK_POSTS).cast("int").alias("n_cols"))
    counts = small(checkpoint(counts))
    dealt = lambda n: F.pmod(F.xxhash64("no"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = held.join(counts, "bucket").withColumn("cols", dealt("n_cols")).withColumn("rows", each("n_rows"))
    asked = asked.join(counts, "bucket").withColumn("rows", dealt("n_rows")).withColumn("cols", each("n_cols"))
    columns = ["bucket", "rows", "cols", "post", "no", "lang", "name", "text", "first", "last"]
    both = held.select(columns).unionByName(asked.select(columns)).repartition("bucket", "rows", "cols").sortWithinPartitions("bucket", "rows", "cols", F.desc("post"))
    return both.mapInPandas(pairs_of_blocks, "title_no bigint, post_no bigint")


def announcement_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate pairs (id, lang, slug) with the log-odds of their evidence."""
    blogs = Blogs.read(table(spark, folder, "blogs"))
    lang, slug = post_key(blogs, F.col("url"))
    lang, slug = post_key(blogs, F.col("post_url"))
    og = F.regexp_extract("html", r'property="og:title"\s+content="([^"]*)"', 1)
    h1 = F.regexp_replace(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1), r"<[^>]*>", "")
    headline, shown = shown_headline_and_date("html")
    title = F.coalesce(F.nullif(F.trim(og), F.lit("")), F.nullif(F.trim(h1), F.lit("")), headline)
    titles = table(spark, folder, "html").select("page_id", F.col("post_url").alias("url"), lang.alias("lang"), slug.alias("slug"), once(title).alias("title"), shown.alias("shown"))
    titles = checkpoint(titles.filter("lang is not null and slug <> '' and title is not null").groupBy("lang", "slug").agg(F.min_by("title", "page_id").alias("title"), F.min_by("shown", "page_id").alias("shown"), F.min("url").alias("url")))
    lang, slug = post_key(blogs, F.col("url"))
    # the spellings of a post's times are gathered first, a set of at most one per snapshot: each is read once, and what
    # was changed last only where no published time is known
    listed = table(spark, folder, "all_posts").select("url", "lastmod", "published_time", lang.alias("lang"), slug.alias("slug")).filter("lang is not null and slug <> ''")
    listed = listed.groupBy("lang", "slug").agg(F.min("url").alias("url"), F.collect_set(F.nullif("published_time", F.lit(""))).alias("pubs"), F.collect_set(F.nullif("lastmod", F.lit(""))).alias("mods"))
    listed = checkpoint(listed)
    published = post_instants(listed.select("lang", "slug", "url", F.explode("pubs").alias("value")), blogs, "value", "pub").groupBy("lang", "slug").agg(F.max("pub").alias("pub"))
    published = checkpoint(published.filter("pub is not null"))
    untimed = listed.join(published, ["lang", "slug"], "left_anti").select("lang", "slug", "url", F.explode("mods").alias("value"))
    changed = post_instants(untimed, blogs, "value", "mod").groupBy("lang", "slug").agg(F.min("mod").alias("mod"))
    # without a published time the date on the page counts; without that the first change is the end of the time in which
    # the post was published, and without any time it may have been at any
    dated = titles.filter("shown is not null").select("lang", "slug", "url", "shown").join(published, ["lang", "slug"], "left_anti")
    dated = post_instants(dated, blogs, "shown", "day").select("lang", "slug", "day").filter("day is not null")
    undated = listed.select("lang", "slug").join(published, ["lang", "slug"], "left_anti").join(dated, ["lang", "slug"], "left").join(changed, ["lang", "slug"], "left")
    # when the other blogs published the slug: evidence, but no bound, as slugs are used again
    siblings = published.join(undated.filter("day is null").select("slug").distinct(), "slug", "left_semi").groupBy("slug").agg(F.collect_set("pub").alias("siblings"))
    undated = undated.join(siblings, "slug", "left").select("lang", "slug", "day", F.expr("if(day is null, mod, null)").alias("until"), F.expr("if(day is null, siblings, null)").alias("siblings"))
    posts = published.unionByName(undated, allowMissingColumns=True)
    labels, model = fit_wording(titles)

    # the rarest word of a slug is its name, of equally rare ones the longest
    words = posts.select("lang", "slug", F.explode(F.array_distinct(F.split("slug", "-"))).alias("word")).filter(r"word <> '' and not word rlike '^\\d+$'")
    usual = words.groupBy("word").agg(F.count("*").alias("n"))
    names = words.join(usual, "word").groupBy("lang", "slug").agg(F.min_by("word", F.struct("n", -F.length("word"), "word")).alias("name"))
    posts = posts.join(names, ["lang", "slug"]).join(titles.select("lang", "slug", "title"), ["lang", "slug"], "left")
    posts = posts.select("lang", "slug", "name", F.col("title").alias("post_title"), F.coalesce("pub", "day").alias("at"), F.col("pub").isNotNull().alias("exact"), "until", "siblings")
    # numbered, so that what is shuffled by key is numbers only
    posts = checkpoint(posts.withColumn("post_no", F.monotonically_increasing_id()))
    channel = channel_instants(table(spark, folder, "channel_posts").select("row_id", "id", "title", "published_at", "sort"), "ms")
    channel = channel.select("id", "title", F.coalesce("ms", F.expr("sort div 10")).alias("ms")).filter("id is not null and title is not null and ms is not null")
    channel = checkpoint(channel.withColumn("title_no", F.monotonically_increasing_id()))
    near = candidate_pairs(posts, channel)
    # by title last, so that what a title needs is calculated once
    near = near.join(posts, "post_no").join(channel, "title_no")
    # from the time of the post, else from the nearest of its siblings'
    near = near.withColumn("hours", F.coalesce(F.col("ms") - F.col("at"), F.expr("array_min(transform(siblings, s -> struct(abs(ms - s) as away, ms - s as after))).after")) / HOUR)

    def wording(title: str) -> dict[str, float]:
        """Log-likelihoods of `lang|kind` below the greatest, and of the best kind of each language under `lang`."""
        if not labels:
            return {}
        scores = model[:, _features(title)].sum(axis=1)
        own = dict(zip(labels, (scores - scores.max()).tolist()))
        for label in labels:
            lang_ = label.split("|")[0]
            own[lang_] = max(own.get(lang_, own[label]), own[label])
        return own

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, dict[str, float]] = {}
        for b in batches:
            out = []
            for title, name, slug_, lang_, post_title, hours, exact in zip(b["title"], b["name"], b["slug"], b["lang"], b["post_title"], b["hours"], b["exact"]):
                title = _clean(title)
                if title not in seen:
                    if len(seen) > 50_000:
                        seen.clear()
                    seen[title] = wording(title)
                known = _clean(post_title) if isinstance(post_title, str) else None
                out.append(pair_weight(title, name, slug_, lang_, known, None if pd.isna(hours) else hours, bool(exact), seen[title]))
            pairs = pd.DataFrame({"id": b["id"], "post": b["lang"] + "/" + b["slug"], "weight": np.array(out, dtype="float64")})
            yield pairs[pairs["weight"] >= LEAST_WEIGHT]

    return near.select("id", "title", "name", "lang", "slug", "post_title", "hours", "exact").mapInPandas(weigh, "id bigint, post string, weight double")


def p3_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Channel posts with the post that they announce and the confidence of the match."""
    marginals = match_marginals(announcement_pairs(spark, folder), "id", "post", "weight")
    found = best_match(marginals, "id", "post")
    return found.select("id", F.substring_index("post", "/", 1).alias("lang"), F.expr("substr(post, instr(post, '/') + 1)").alias("slug"), "confidence")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_matches(spark, folder).drop("confidence")
