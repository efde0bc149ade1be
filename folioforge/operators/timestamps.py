"""Timestamps in many formats and zones to one UTC instant.

One regular expression holds every format as an alternation with named groups.
A single replacement writes the groups, separated, into one string, so each
value is matched once; calendar checks and the instant are integer arithmetic.
No shuffle, no Python: the operator is a chain of projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import once

# Month names of the five languages, by month, lower case, without dots.
MONTHS: list[list[str]] = [
    ["january", "jan", "januar", "jänner", "janvier", "janv"],
    ["february", "feb", "februar", "février", "fevrier", "févr", "fevr", "fév"],
    ["march", "mar", "märz", "maerz", "mär", "mars"],
    ["april", "apr", "avril", "avr"],
    ["may", "mai"],
    ["june", "jun", "juni", "juin"],
    ["july", "jul", "juli", "juillet", "juil"],
    ["august", "aug", "août", "aout"],
    ["september", "sep", "sept", "septembre"],
    ["october", "oct", "oktober", "okt", "octobre"],
    ["november", "nov", "novembre"],
    ["december", "dec", "dezember", "dez", "décembre", "decembre", "déc"],
]
# Zone abbreviations with their offset in minutes.
ZONES: dict[str, int] = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60,
    "cet": 60, "mez": 60, "cest": 120, "mesz": 120, "eet": 120, "eest": 180,
    "kst": 540, "jst": 540,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}
# Marks of the first and the second half of the day.
AM = ["am", "a.m.", "오전", "午前"]
PM = ["pm", "p.m.", "오후", "午後"]
# Full-width forms and their ASCII forms.
WIDE = "０１２３４５６７８９：／－．，＋\u3000\u00a0\u202f\u2009\u2212"
NARROW = "0123456789:/-.,+    -"


def _alternation(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in sorted(words, key=lambda w: (-len(w), w)))


_MONTH = _alternation([w for names in MONTHS for w in names])
_HALF = _alternation(AM + PM)
_DATES = [
    r"(?<yA>\d{4})\s?[-/.]\s?(?<mA>\d{1,2})\s?[-/.]\s?(?<dA>\d{1,2})\.?",
    r"(?<yB>\d{4})\s?[년年]\s?(?<mB>\d{1,2})\s?[월月]\s?(?<dB>\d{1,2})\s?[일日]",
    r"(?<yC>\d{4})(?<mC>\d{2})(?<dC>\d{2})",
    r"(?<nA>\d{1,2})[-/.](?<nB>\d{1,2})[-/.](?<yD>\d{4})",
    rf"(?<dE>\d{{1,2}})(?:\.|er|st|nd|rd|th)?[ -](?<monE>{_MONTH})\.?[ -](?<yE>\d{{4}})",
    rf"(?<monF>{_MONTH})\.? (?<dF>\d{{1,2}})(?:st|nd|rd|th)?,? (?<yF>\d{{4}})",
]
_TIMES = [
    rf"(?<halfA>{_HALF})?\s?(?<hA>\d{{1,2}})(?::|h|시|時)\s?(?<iA>\d{{1,2}})(?:분|分)?"
    rf"(?:[:\s]\s?(?<sA>\d{{1,2}})(?:초|秒|[.,](?<fA>\d{{1,9}}))?)?(?:\s?(?<halfB>{_HALF}))?(?:\s?Uhr)?",
    r"(?<hB>\d{2})(?<iB>\d{2})(?:(?<sB>\d{2})(?:[.,](?<fB>\d{1,9}))?)?",
]
_ZONE = rf"(?:(?<off>[+-]\d{{2}}(?::?\d{{2}})?)|(?<abbr>{_alternation(list(ZONES))}))?\s?(?:[\[(](?<region>[A-Za-z_]+(?:/[A-Za-z_+\-0-9]+)+)[\])])?"
_DAY_NAME = r"(?:\p{L}{2,10}\.?,\s?)?"
_EPOCH = r"(?<epoch>\d{10}|\d{13}|\d{16}|\d{19})"
#: every format there is, as one pattern
PATTERN = (
    rf"(?iu)^(?:{_EPOCH}|{_DAY_NAME}(?:{'|'.join(_DATES)})"
    rf"(?:(?:T|,?\s?(?:at|um|à|a|-)?\s?)(?:{'|'.join(_TIMES)})\s?{_ZONE})?)$"
)
_MARK, _SEP = "\u0001", "\u0002"
#: the parts, each the one group of its kind that took part in the match
_PARTS: dict[str, list[str]] = {
    "epoch": ["epoch"],
    "y": ["yA", "yB", "yC", "yD", "yE", "yF"],
    "m": ["mA", "mB", "mC"],
    "mon": ["monE", "monF"],
    "d": ["dA", "dB", "dC", "dE", "dF"],
    "n1": ["nA"],
    "n2": ["nB"],
    "half": ["halfA", "halfB"],
    "h": ["hA", "hB"],
    "i": ["iA", "iB"],
    "s": ["sA", "sB"],
    "f": ["fA", "fB"],
    "off": ["off"],
    "abbr": ["abbr"],
    "region": ["region"],
}
_REPLACEMENT = _MARK + _SEP.join("".join(f"${{{g}}}" for g in groups) for groups in _PARTS.values())


def _lookup(pairs: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), F.lower(key))


def days_from_civil(y: str, m: str, d: str) -> str:
    """SQL for the days since 1970-01-01 of a proleptic Gregorian date; months count from March, so leap days come last."""
    yy = f"({y} - if({m} <= 2, 1, 0))"
    mm = f"(({m} + 9) % 12)"
    return f"(365 * {yy} + {yy} div 4 - {yy} div 100 + {yy} div 400 + (153 * {mm} + 2) div 5 + {d} - 1 - 719468)"


def days_in_month(y: str, m: str) -> str:
    leap = f"({y} % 4 = 0 and ({y} % 100 <> 0 or {y} % 400 = 0))"
    return f"(case when {m} = 2 then if({leap}, 29, 28) when {m} in (4, 6, 9, 11) then 30 else 31 end)"


def with_instant(df: DataFrame, value: Column, tz: Column, order: Column, out: str) -> DataFrame:
    """Add `out`, the UTC instant of `value` in epoch milliseconds (rounded down), or null if it denotes none.

    value: text or integer. Integers of 10, 13, 16 and 19 digits are epoch
    seconds, milli-, micro- and nanoseconds; 8, 12 and 14 digits are written-out
    dates. tz: IANA zone of values without zone (null: such values denote no
    instant). order: `ymd`, `mdy` or `dmy` for dates in numbers whose year comes
    last; where it is null or `ymd`, such a date counts only if just one reading
    is possible.

    Null, empty, placeholder and impossible values, and wall-clock times that
    never occurred, give null. A time that occurred twice means the first. A
    date without time is the start of that day; 24:00 is the end of it, and a
    leap second, :59:60, the start of the next minute. Rows, their number and all other
    columns stay as they are, whatever their names; an existing column `out` is
    replaced. An empty table gives an empty table.
    """
    t = "__ts_" + out
    raw = F.trim(F.regexp_replace(F.translate(value.cast("string"), WIDE, NARROW), r"\s+", " "))
    kept = df.columns if out not in df.columns else [c for c in df.columns if c != out]
    s = df.withColumns({t + "tz": tz, t + "order": order, t: once(F.regexp_replace(raw, PATTERN, _REPLACEMENT))})
    s = s.withColumn(t, F.when(F.startswith(t, F.lit(_MARK)), F.split(F.substr(t, F.lit(2)), _SEP, -1)))
    part = {k: F.nullif(F.get(t, F.lit(n)), F.lit("")) for n, k in enumerate(_PARTS)}
    num = {k: part[k].cast("bigint") for k in ("y", "m", "d", "n1", "n2", "h", "i", "s")}
    months = {w: n for n, names in enumerate(MONTHS, 1) for w in names}
    dmy = (F.col(t + "order") == "dmy") | ((F.coalesce(t + "order", F.lit("ymd")) == "ymd") & (num["n1"] > 12) & (num["n2"] <= 12))
    mdy = (F.col(t + "order") == "mdy") | ((F.coalesce(t + "order", F.lit("ymd")) == "ymd") & (num["n2"] > 12) & (num["n1"] <= 12))
    half = F.lower(part["half"])
    offset = F.when(
        part["off"].isNotNull(),
        F.when(F.startswith(part["off"], F.lit("-")), -1).otherwise(1)
        * (F.substr(part["off"], F.lit(2), F.lit(2)).cast("bigint") * 60 + F.coalesce(F.nullif(F.regexp_extract(part["off"], r"(\d\d)$", 1), F.lit("")).cast("bigint"), F.lit(0)) * F.when(F.length(part["off"]) > 3, 1).otherwise(0)),
    ).otherwise(_lookup(ZONES, part["abbr"]))
    s = s.withColumns({
        t + "epoch": part["epoch"],
        t + "y": once(num["y"]),  # keeps the layers apart: one method of generated code each, small enough to be compiled
        t + "m": F.coalesce(num["m"], _lookup(months, part["mon"]), F.when(dmy, num["n2"]).when(mdy, num["n1"])),
        t + "d": F.coalesce(num["d"], F.when(dmy, num["n1"]).when(mdy, num["n2"])),
        t + "timed": num["h"].isNotNull(),
        t + "h": F.when(half.isin(AM + PM), F.when(num["h"] <= 12, num["h"] % 12 + F.when(half.isin(PM), 12).otherwise(0))).otherwise(F.coalesce(num["h"], F.lit(0).cast("bigint"))),
        t + "i": F.coalesce(num["i"], F.lit(0).cast("bigint")),
        t + "s": F.coalesce(num["s"], F.lit(0).cast("bigint")),
        t + "ms": F.coalesce(F.substr(F.rpad(part["f"], 3, "0"), F.lit(1), F.lit(3)).cast("bigint"), F.lit(0).cast("bigint")),
        t + "off": offset,
        t + "region": F.coalesce(part["region"], F.col(t + "tz")),
    })
    y, m, d, h, i, sec = (f"`{t}{k}`" for k in ("y", "m", "d", "h", "i", "s"))
    valid = f"{y} between 1 and 9999 and {m} between 1 and 12 and {d} between 1 and {days_in_month(y, m)} and ({h} between 0 and 23 or {h} = 24 and {i} = 0 and {sec} = 0 and `{t}ms` = 0) and {i} between 0 and 59 and ({sec} between 0 and 59 or {sec} = 60 and {i} = 59)"
    local = f"(((({days_from_civil(y, m, d)} * 24 + {h}) * 60 + {i}) * 60 + {sec}) * 1000 + `{t}ms`)"
    s = s.withColumn(t + "local", once(F.expr(f"case when {valid} then {local} end")))
    # a time that occurred twice comes out as the first, one that never occurred is moved, which the way back shows
    ok_zone = F.col(t + "off").isNull() & F.col(t + "local").isNotNull()
    s = s.withColumn(t + "utc", once(F.when(ok_zone, F.to_utc_timestamp(F.timestamp_millis(t + "local"), F.col(t + "region")))))
    same = F.unix_millis(F.from_utc_timestamp(t + "utc", F.col(t + "region"))) == F.col(t + "local")
    epoch = F.expr(
        f"case length(`{t}epoch`) when 10 then cast(`{t}epoch` as bigint) * 1000 when 13 then cast(`{t}epoch` as bigint)"
        f" when 16 then cast(`{t}epoch` as bigint) div 1000 else try_cast(`{t}epoch` as bigint) div 1000000 end"
    )
    result = (
        F.when(F.col(t + "epoch").isNotNull(), epoch)
        .when(F.abs(t + "off") <= 14 * 60, F.col(t + "local") - F.col(t + "off") * 60_000)
        .when(F.col(t + "utc").isNotNull() & (same | ~F.col(t + "timed")), F.unix_millis(t + "utc"))
    )
    return s.select(*[F.col(f"`{c}`") for c in kept], once(result).alias(out))
