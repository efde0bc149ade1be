"""URL expressions. All are built-in column expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import once

#: scheme, authority, path; scheme and slashes may be missing
_PARTS = r"(?U)^\s*(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//)?([^/?#\s]*)([^?#]*)"
_LAST_SEGMENT = r"(?U)([^/\s][^/]*?)[/\s]*$"

# URL forms that the project's cleaning rule names.
SIZE_SEGMENT = r"(?i)/size/w\d+(?:h\d+)?"
PREVIEW_SEGMENT = r"(?i)(cdn\.[^/]+/image/[a-z]+/[a-z]{2})/p/"
REF_PARAMETER = r"([?&])ref=[^&#]*(&|(?=#)|$)"
EMPTY_QUERY = r"[?&](?=#|$)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a leading `www.`; '' if there is none, null for null."""
    authority = F.lower(F.regexp_extract(url, _PARTS, 1))
    return F.regexp_replace(authority, r"^(?:[^@]*@)?(?:www\.)?([^:]*)(?::\d*)?$", "$1")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 2)


def percent_decoded(text: Column) -> Column:
    """Percent-decoded as UTF-8, `+` kept; text with broken escapes stays as it is."""
    decoded = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(text, F.lit("%")), F.coalesce(decoded, text)).otherwise(text)


def slug_of(url: Column) -> Column:
    """Last non-empty path segment, percent-decoded, lower case; '' if the path has none."""
    return F.lower(percent_decoded(F.regexp_extract(path_of(url), _LAST_SEGMENT, 1)))


def strip_ref(url: Column) -> Column:
    """Drop `ref` query parameters; the rest of the query keeps its spelling.

    Two neighbouring `ref` parameters need a second pass, as a match takes the
    separator that the next one would start with.
    """
    once = F.regexp_replace(F.regexp_replace(url, REF_PARAMETER, "$1"), REF_PARAMETER, "$1")
    return F.when(F.contains(url, F.lit("ref=")), F.regexp_replace(once, EMPTY_QUERY, "")).otherwise(url)


def clean_url(url: Column) -> Column:
    """Canonical URL of an image: no ref parameter, no size segment, original instead of preview, no slash at the end."""
    sized = F.regexp_replace(strip_ref(url), SIZE_SEGMENT, "")
    return F.rtrim(F.regexp_replace(sized, PREVIEW_SEGMENT, "$1/o/"), F.lit("/"))


#: what the key of an image leaves out besides the scheme: size segment and ref parameters; preview and original of the CDN are one
_NOT_IN_KEY = r"/(?i:size)/w\d+(?i:h\d+)?|[?&](?:ref=[^&#]*&)*ref=[^&#]*(?=#|\s*$)|([?&])(?:ref=[^&#]*&)+"
_CDN_VARIANT = r"(?i)(//cdn\.[^/]+/image/[a-z]+/[a-z]{2})/[po](?=/)"


def with_image_key(df: DataFrame, url: Column, out: str) -> DataFrame:
    """Add `out`, what makes two URLs one image: the cleaned URL without scheme, host in lower case.

    Null for null; '' for a blank URL. Preview and original of the CDN are one
    image, so the key leaves that segment out. The cleaned URL is a column of
    its own, calculated once, as the key uses it three times.
    """
    cleaned = F.rtrim(F.regexp_replace(F.regexp_replace(url, _NOT_IN_KEY, "$1"), _CDN_VARIANT, "$1"), F.lit("/ "))
    df = df.withColumn("__cleaned", once(cleaned))
    df = df.withColumn("__cleaned", F.substr("__cleaned", F.instr("__cleaned", "//") + F.when(F.instr("__cleaned", "//") > 0, 2).otherwise(1)))
    host = F.substring_index("__cleaned", "/", 1)
    return df.withColumn(out, once(F.concat(F.lower(host), F.substr("__cleaned", F.length(host) + 1)))).drop("__cleaned")


def link_key(url: Column) -> Column:
    """Key of a link for matching snapshots: lower-case host and percent-decoded path without size segment and slash at the end.

    Scheme, query and port are ignored; the root path stays `/`, an empty one ''.
    """
    raw = F.lower(F.regexp_replace(F.regexp_extract(url, _PARTS, 1), r"^(?:[^@]*@)?([^:]*)(?::\d*)?$", "$1"))
    path = F.regexp_replace(percent_decoded(path_of(url)), SIZE_SEGMENT, "")
    return F.concat(raw, F.when(path == "/", path).otherwise(F.rtrim(path, F.lit("/"))))


def is_drive_host(host: Column, hosts: tuple[str, ...], suffix: str) -> Column:
    return F.lower(host).isin(*hosts) | F.endswith(F.lower(host), F.lit(suffix))


def snapshot_image_url(url: Column) -> Column:
    """URL of an archive snapshot with the mark for unchanged content after its timestamp."""
    return F.regexp_replace(url, r"(/web/\d{1,14})(?:[a-z]{2}_)?/", "$1im_/")


def original_of_snapshot(url: Column) -> Column:
    """URL that an archive snapshot was taken of; other URLs stay."""
    return F.regexp_replace(url, r"^https?://web\.archive\.org/web/\d{1,14}(?:[a-z]{2}_)?/", "")


def moved(url: Column, host: str, to_host: str, prefix: str) -> Column:
    """URL on another host below a path prefix, if it is on `host`; null otherwise."""
    return F.when(F.lower(F.regexp_extract(url, _PARTS, 1)) == host, F.concat(F.lit(f"https://{to_host}{prefix}"), path_of(url)))


def language_variant(url: Column, host: Column, suffix: Column) -> Column:
    """URL on another language's host, with a `_KO` mark before `.`, `_` or `-` replaced by that language's."""
    swapped = F.concat(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://)", 1), host, F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(.*)$", 1))
    tail = F.split(swapped, r"(?i)_ko(?=[._\-])", -1)
    return F.concat(F.get(tail, F.lit(0)), F.aggregate(F.slice(tail, 2, F.greatest(F.size(tail) - 1, F.lit(0))), F.lit(""), lambda acc, x: F.concat(acc, suffix, x)))
