"""Text decoded with the wrong character encoding: finding it and restoring the original.

Round trip: text is encoded again under a legacy encoding it may have been
decoded with, and strictly decoded as the intended one; this is repeated for
nested layers, and kept where a cost of garbling drops. Where only parts are
garbled, or characters were lost, the trip is taken by stretches.

A regular expression in the JVM picks the texts that may be garbled at all, so
only those reach Python.
"""

from __future__ import annotations

import re
import unicodedata as ud
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Single-byte encodings that UTF-8 is wrongly decoded with.
SINGLE_BYTE = ["cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r"]
# Multi-byte encodings that are wrongly decoded as a Western one.
MULTI_BYTE = ["cp949", "cp932", "euc_jp", "gbk", "big5"]
# First bytes of the common characters of Chinese encodings, which list them before the rare ones.
COMMON_HAN = {"gbk": ("gb2312", 0xB0, 0xD7), "big5": ("big5", 0xA4, 0xC6)}
#: fewer characters in runs are no evidence for a Chinese encoding
LEAST_HAN = 8
# Cyrillic encodings that are wrongly decoded as a Western one, and the commonest letters of their text.
CYRILLIC = ["cp1251", "koi8_r"]
COMMON_CYRILLIC = "оеаинтсрвлкмдпуяызбгчй"
# Multi-byte encodings that UTF-8 is wrongly decoded with.
WIDE = ["cp949", "cp932", "gbk"]
#: what may be garbled: lost characters, C1 controls, symbols and accented letters side by side, Cyrillic letters before symbols or letters rare in Russian, Hanja among Hangul, kanji typical of UTF-8 read as Shift JIS
SUSPECT = (
    r"[\x{80}-\x{9f}\x{fffd}]"
    r"|[\x{a0}-\x{ff}\x{152}-\x{178}\x{192}\x{2c6}-\x{2dd}\x{3a9}\x{3c0}\x{2020}-\x{2022}\x{2030}-\x{203a}\x{20ac}\x{2122}\x{2202}-\x{22ff}\x{25ca}\x{2500}-\x{25ff}\x{fb01}\x{fb02}\x{100}-\x{151}]"
    r"[\x{a0}-\x{ff}\x{152}-\x{178}\x{192}\x{2c6}-\x{2dd}\x{3a9}\x{3c0}\x{2013}-\x{203a}\x{20ac}\x{2122}\x{2202}-\x{22ff}\x{25ca}\x{2500}-\x{25ff}\x{fb01}\x{fb02}\x{100}-\x{151}]"
    r"|[\x{412}-\x{44f}][\x{a0}-\x{bf}\x{401}-\x{40f}\x{451}-\x{45f}\x{490}\x{491}\x{2013}-\x{203a}\x{20ac}\x{2116}\x{2122}]"
    r"|[\x{192}\x{201a}][\x{20}-\x{7e}\x{a0}-\x{ff}\x{152}-\x{178}\x{192}\x{2010}-\x{203a}]"
    r"|[\x{ac00}-\x{d7a3}][\x{4e00}-\x{9fff}\x{f900}-\x{faff}]|[\x{4e00}-\x{9fff}\x{f900}-\x{faff}][\x{ac00}-\x{d7a3}]|[縺繧繝].?[縺繧繝]|[銆鈥锛鐨]{2}"
)


#: the same for Python
_SUSPECT = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: "\\u" + m.group(1).zfill(4), SUSPECT))


@lru_cache(maxsize=None)
def _bytes_of(encoding: str) -> dict[int, str]:
    """Character of each byte; bytes that the encoding leaves open stand for the C1 control of that number."""
    return {n: bytes([n]).decode(encoding, "ignore") or chr(n) for n in range(256)}


@lru_cache(maxsize=None)
def _back(encoding: str) -> dict[str, int]:
    """Byte of each character; for Western text Latin-1 and its C1 controls count too, as both occur mixed."""
    table = {c: n for n, c in _bytes_of(encoding).items()}
    if encoding == "cp1252":
        table = {chr(n): n for n in range(256)} | table
    return table


def _class(encoding: str, low: int, high: int) -> str:
    return "[" + "".join(re.escape(c) for c, n in _back(encoding).items() if low <= n <= high) + "]"


@lru_cache(maxsize=None)
def _utf8_in(encoding: str) -> re.Pattern:
    """Runs of characters whose bytes are sequences of UTF-8 beyond ASCII."""
    tail = _class(encoding, 0x80, 0xBF)
    return re.compile(f"(?:{_class(encoding, 0xC2, 0xDF)}{tail}|{_class(encoding, 0xE0, 0xE0)}{_class(encoding, 0xA0, 0xBF)}{tail}|{_class(encoding, 0xE1, 0xEF)}{tail}{{2}}|{_class(encoding, 0xF0, 0xF4)}{tail}{{3}})+")


def _encode(text: str, encoding: str) -> bytes | None:
    back = _back(encoding)
    try:
        return bytes([back[c] for c in text])
    except KeyError:
        return None


@lru_cache(maxsize=50_000)
def _plausible(char: str) -> bool:
    """Whether a character beyond ASCII is one that texts of the domain have."""
    o = ord(char)
    return (
        0xA0 <= o <= 0x17F
        or 0xAC00 <= o <= 0xD7A3
        or 0x1100 <= o <= 0x11FF
        or 0x3000 <= o <= 0x33FF
        or 0x4E00 <= o <= 0x9FFF
        or 0x2010 <= o <= 0x2027
        or 0x2030 <= o <= 0x205E
        or 0x20A0 <= o <= 0x20BF
        or 0x2100 <= o <= 0x27BF
        or 0x2B00 <= o <= 0x2BFF
        or 0xFF00 <= o <= 0xFFEF
        or 0x1F000 <= o <= 0x1FAFF
        or o in (0x200B, 0x200D, 0xFE0F, 0x192, 0x2C6, 0x2DC)
    )


def _scripts(text: str) -> set[int]:
    """Blocks of which text has three different letters or more, beyond those of the domain; marks count to their letters."""
    found: dict[int, int] = {}
    for c in set(text):
        if not _plausible(c) and ud.category(c)[0] in "LM":
            found[ord(c) >> 7] = found.get(ord(c) >> 7, 0) + 1
    return {b for b, n in found.items() if n > 2}


def _undo_utf8(text: str, encoding: str) -> tuple[str, int]:
    """Text with UTF-8 in disguise decoded, and how many of its characters that took."""
    taken = 0
    runs = _utf8_in(encoding).findall(text)
    if not runs:
        return text, 0
    decoded = "".join(_encode(x, encoding).decode("utf-8", "replace") for x in runs)
    scripts = set() if all(map(_plausible, decoded)) else _scripts(decoded)

    def decode(m: re.Match) -> str:
        nonlocal taken
        raw = _encode(m.group(), encoding)
        out = raw.decode("utf-8", "replace")
        if encoding in CYRILLIC and re.search("[А-яёЁ]", text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]):
            return m.group()  # part of a Cyrillic word
        if not all(_plausible(c) or "Ͱ" <= c <= "ӿ" and len(out) > 1 or "\x80" <= c <= "\x9f" or ord(c) >> 7 in scripts and ud.category(c)[0] in "LMNP" for c in out):
            return m.group()
        # a lone pair is evidence for the commonest letters only; in other encodings it may be a drawing or quoted letter
        if encoding != "cp1252" and len(raw) == 2 and raw[0] not in ((0xC2, 0xC3, 0xC4, 0xC5) if encoding in ("mac_roman", "cp1250") else (0xC2, 0xC3)):
            return m.group()
        taken += len(m.group())
        return out

    return _utf8_in(encoding).sub(decode, text), taken


@lru_cache(maxsize=50_000)
def _own(char: str, encoding: str) -> bool:
    """Whether text in a multi-byte encoding is made of such characters."""
    if encoding == "cp949":
        return "가" <= char <= "힣"
    if encoding in COMMON_HAN:
        name, low, high = COMMON_HAN[encoding]
        try:
            raw = char.encode(name)
        except UnicodeEncodeError:
            return False
        return len(raw) == 2 and low <= raw[0] <= high
    return "ぁ" <= char <= "ゖ" or "ァ" <= char <= "ヺ" or char == "ー"


@lru_cache(maxsize=None)
def _common_hangul(char: str) -> bool:
    try:
        return len(char.encode("euc_kr")) == 2
    except UnicodeEncodeError:
        return False


@lru_cache(maxsize=None)
def _weight(char: str) -> tuple[float, float, float]:
    """Cost of a character after ASCII, after other characters, and after Hangul."""
    o = ord(char)
    if 0x80 <= o <= 0x9F or o == 0xFFFD or 0xE000 <= o <= 0xF8FF:
        return 3.0, 3.0, 3.0
    if 0xAC00 <= o <= 0xD7A3:
        return (0.05,) * 3 if _common_hangul(char) else (1.0,) * 3
    if 0x3040 <= o <= 0x30FF or 0x3000 <= o <= 0x3020 or 0x1100 <= o <= 0x11FF or 0x3130 <= o <= 0x318F:
        return 0.05, 0.05, 0.05
    if 0x4E00 <= o <= 0x9FFF:
        return 0.3, 0.3, 1.0
    if 0xC0 <= o <= 0x17F:
        return 0.3, 1.2, 1.2
    return 0.5, 1.2, 1.2


@lru_cache(maxsize=50_000)
def _letter_block(char: str) -> int:
    """Block of a letter or mark of an alphabet beyond Latin; 0 for any other character."""
    o = ord(char)
    return o >> 7 if 0x370 <= o < 0x1100 and ud.category(char)[0] in "LM" or 0x1780 <= o < 0x1880 else 0


def _cost(text: str) -> float:
    """Cost of garbling: how ill characters stand side by side, a mean over those beyond ASCII.

    Letters of one alphabet beyond Latin stand well together, but for a capital
    after a small one.
    """
    total, n, state, before = 0.0, 0, 0, ""
    for c in text:
        if c <= "\x7f":
            state = 0
        else:
            n += 1
            block = _letter_block(c) if "\u0370" <= c < "\u1880" else 0
            if block and before and block == _letter_block(before) and not (c.isupper() and before.islower()):
                total += 0.1
            elif block and not state:
                total += 0.3
            else:
                total += _weight(c)[state]
            state = 2 if "가" <= c <= "힣" else 1
        before = c
    return total / n if n else 0.0


#: two or more symbols of Korean text in a row, in the rows of punctuation, marks and lines of its encoding
_KOREAN_SYMBOLS = re.compile("(?:[¡¢¦][¡-þ]){2,}")


#: where a multi-byte text read as a Western one may be: four characters beyond ASCII in one run
_HIGH_RUN = re.compile("(?:[\x80-\u0178\u0192\u02c6\u02dc\u2013-\u203a\u20ac\u2122][\x00-\x7f]*){4}")


@lru_cache(maxsize=None)
def _western_runs() -> re.Pattern:
    """Runs of Western characters from the first beyond ASCII, which every character of these encodings starts with."""
    return re.compile(_class("cp1252", 0x80, 255) + _class("cp1252", 0, 255) + "*")


def _undo_multi(line: str, encodings: list[str]) -> tuple[str, str] | None:
    """Korean, Japanese or Chinese bytes read as Western text, line by line or in stretches of one: (restored, encoding)."""
    best = None
    for encoding in encodings:
        done = 0

        def decode(m: re.Match) -> str:
            nonlocal done
            run = m.group()
            if sum(c > "\x7f" for c in run) < 4:
                return run
            text = _encode(run, "cp1252").decode(encoding, "replace")
            own, beyond = sum(_own(c, encoding) for c in text if c > "\x7f"), sum(c > "\x7f" for c in text)
            marks = text.count("·") + (len(re.findall("[一-鿿々、。「」・：]", text)) if encoding != "cp949" else len(re.findall("[“”‘’「」…]", text)))
            if encoding in COMMON_HAN and re.search("[ぁ-ゖァ-ヺ]", text):
                return run  # Chinese has no kana
            if own >= 2 and own + marks >= 0.7 * beyond and text.count("\ufffd") <= 0.15 * beyond + 0.5 and _cost(text) + 0.2 < _cost(run):
                done += own
                return text
            return run

        text = _western_runs().sub(decode, line)
        if done and (best is None or _cost(text) < best[0]):
            best = (_cost(text), text, encoding)
    if best is None and _KOREAN_SYMBOLS.search(line):
        text = _KOREAN_SYMBOLS.sub(lambda m: m.group().encode("latin-1").decode("cp949", "replace"), line)
        if "\ufffd" not in text:
            return text, "cp949"
    return best and best[1:]


#: four or more accented Western letters in a row
_ACCENTED = re.compile("[À-ÿ¨¸£³]{4,}(?:[\\s,.!?;:-]+[À-ÿ¨¸£³]+)*")


def _undo_cyrillic(line: str) -> tuple[str, str] | None:
    """Cyrillic bytes read as Western text: (restored, encoding). Western words don't have four accented letters in a row; the encoding is the one that gives common small letters."""
    runs = _ACCENTED.findall(line)
    if sum(c > "\x7f" for r in runs for c in r) < 0.8 * sum(c > "\x7f" for c in line) or not runs:
        return None
    best = None
    for encoding in CYRILLIC:
        told = "".join(_encode(r, "cp1252").decode(encoding, "replace") for r in runs)
        letters = [c for c in told if c.isalpha()]
        score = sum(c in COMMON_CYRILLIC for c in letters) / max(1, len(letters))
        if score >= 0.6 and all("Ѐ" <= c <= "ӿ" for c in letters) and (best is None or score > best[0]):
            best = (score, encoding)
    if best is None:
        return None
    return _ACCENTED.sub(lambda m: _encode(m.group(), "cp1252").decode(best[1], "replace"), line), best[1]


def _undo_wide(line: str) -> tuple[str, str] | None:
    """A line of UTF-8 read as a Korean, Japanese or Chinese encoding, maybe with lost characters: (restored as far as possible, encoding)."""
    lossy = "�" in line
    best = None
    for encoding in WIDE:
        try:
            raw = b"".join(b"\xff" if c == "�" else b" " if c == "\u3000" else c.encode(encoding) for c in line)
        except UnicodeEncodeError:
            continue
        text = raw.decode("utf-8", "replace")
        gained = len(re.findall("[가-힣ぁ-ゖァ-ヺー一-鿿、。「」“”‘’äöüßéèêàçô…–—«»]", text))
        lost = text.count("�")
        if gained >= 2 and gained >= lost * (0.4 if lossy else 4) and (lossy or not lost) and _cost(text.replace("�", "")) + 0.15 < _cost(line):
            if best is None or lost < best[0]:
                best = (lost, text, encoding)
    return best and best[1:]


def _encodings_of(text: str) -> list[str]:
    """Multi-byte encodings that lines of text may be in. A few bytes read well in many, so Chinese, which any two bytes may be, is tried only where it reads best for the text as a whole."""
    best = _undo_multi(text, MULTI_BYTE)
    chinese = best[1] if best is not None and best[1] in COMMON_HAN else None
    if chinese is not None:
        # Chinese stands in runs, and a text has some of it
        together = sum(map(len, re.findall("[一-鿿]{2,}", best[0])))
        if together < LEAST_HAN or together < 0.6 * len(re.findall("[一-鿿]", best[0])):
            chinese = None
    return [e for e in MULTI_BYTE if e not in COMMON_HAN or e == chinese]


def _options(line: str, encodings: Callable[[], list[str]]) -> list[tuple[str, str]]:
    """What a line may have been before one wrong decoding: (text, name of the decoding)."""
    found = []
    beyond = sum(c > "\x7f" for c in line)
    for encoding in SINGLE_BYTE:
        fixed, taken = _undo_utf8(line, encoding)
        if beyond and taken >= 0.8 * beyond:
            # nearly all of a line is valid UTF-8, which other text hardly ever is
            return [(fixed, f"utf-8 as {encoding}")] if fixed != line else []
        if taken and fixed not in (f for f, _ in found):
            found.append((fixed, f"utf-8 as {encoding}"))
        if encoding == "cp1252":
            cyrillic = _undo_cyrillic(line)
            if cyrillic is not None:
                return [(cyrillic[0], f"{cyrillic[1]} as cp1252")]
    multi = _undo_multi(line, encodings()) if _HIGH_RUN.search(line) else None
    if multi is not None:
        found.append((multi[0], f"{multi[1]} as cp1252"))
    if re.search("[�가-힣縺繧繝一-鿿]", line):
        wide = _undo_wide(line)
        if wide is not None:
            found.append((wide[0], f"utf-8 as {wide[1]}"))
    return [(t, n) for t, n in found if t != line]


def _best(line: str, encodings: Callable[[], list[str]]) -> tuple[float, str, list[str]]:
    """The cheapest text that round trips lead to from line, through any number of layers: (cost, text, decodings undone).

    Each trip makes the text shorter or is the last of its kind, so there is an end.
    """
    best = (_cost(line), line, [])
    seen, waiting = {line}, [(line, [])]
    while waiting:
        text, undone = waiting.pop()
        if text.isascii():
            continue
        for fixed, name in _options(text, encodings):
            if fixed in seen:
                continue
            seen.add(fixed)
            names, cost = [*undone, name], _cost(fixed)
            if cost < best[0] or (name == "cp949 as cp1252" and not best[2]):
                best = (cost, fixed, names)
            if len(fixed) < len(text):
                waiting.append((fixed, names))
    return best


def repair(text: str) -> tuple[str, list[str], bool]:
    """(text as far as restored, decodings undone from the outermost, whether all was restored)."""
    undone: list[str] = []
    lines = text.split("\n")
    suspect = [n for n, line in enumerate(lines) if not line.isascii() and _SUSPECT.search(line)]
    whole = "\n".join(lines[n] for n in suspect)
    # asked for by few texts
    encodings = cache(lambda: _encodings_of(whole))
    for n in suspect:
        _, lines[n], names = _best(lines[n], encodings)
        undone += [x for x in names if names.count(x) > undone.count(x)]
    fixed = "\n".join(lines)
    if not undone and re.search("[�\x80-\x84\x86-\x9f]", fixed):
        # garbled for sure, but by no decoding that is known here
        return fixed, ["lost characters"], False
    return fixed, undone, "�" not in fixed


def garbled(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Documents with a passage garbled by wrong decoding, with the original text where it can be restored.

    Returns doc_id, restored (null where characters are lost for good), partly
    (the text as far as restored) and undone, the decodings taken back from the
    outermost.

    Whole texts are read, whatever their length. Null and empty texts are no
    cases, nor are foreign names, accents, symbols, full-width and half-width
    forms that stand where they were written. A null id stays null; repeated
    rows give a row each. An empty table gives an empty table. Extra columns are
    ignored.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, raw in zip(b["id"], b["text"]):
                fixed, undone, whole = repair(raw)
                if undone:
                    rows.append((i, fixed if whole else None, fixed, undone))
            yield pd.DataFrame(rows, columns=["id", "restored", "partly", "undone"]).astype({"id": "Int64"})

    suspects = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(F.col("text").rlike(SUSPECT))
    return suspects.mapInPandas(find, "id bigint, restored string, partly string, undone array<string>").withColumnRenamed("id", doc_id)
