"""Names of files, folders and labels, as column expressions."""

from __future__ import annotations

import urllib.parse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.url import path_of, percent_decoded

# Extensions of content types; the standard library's table depends on the machine.
MIME_EXTENSIONS = {
    "image/png": ".png", "image/jpeg": ".jpg", "image/gif": ".gif", "image/webp": ".webp", "image/bmp": ".bmp", "image/svg+xml": ".svg",
    "application/zip": ".zip", "application/x-7z-compressed": ".7z", "application/gzip": ".gz", "application/x-tar": ".tar", "application/vnd.rar": ".rar",
    "video/mp4": ".mp4", "video/webm": ".webm", "video/quicktime": ".mov", "video/x-matroska": ".mkv",
    "audio/mpeg": ".mp3", "audio/wav": ".wav", "audio/ogg": ".ogg", "audio/mp4": ".m4a", "audio/flac": ".flac", "audio/aac": ".aac",
    "text/html": ".html", "text/css": ".css",
}


def basename(url: Column) -> Column:
    """Last path segment, percent-decoded; '' if the path ends with none."""
    return percent_decoded(F.regexp_extract(F.rtrim(path_of(url), F.lit("/")), r"([^/]*)$", 1))


def suffix(name: Column) -> Column:
    """Extension with its dot, lower case; '' for names that only start with a dot."""
    return F.lower(F.regexp_extract(name, r"[^/.][^/]*?(\.[^./]+)$", 1))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=[^/])\.[^./]+$", "")


def safe_filename(name: Column, longest: int = 200) -> Column:
    """Characters that file systems refuse as `_`, cut to `longest`; `image` if nothing is left."""
    clean = F.substring(F.regexp_replace(name, r'[\\/:*?"<>|]', "_"), 1, longest)
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("image"))


def extension_of_mime(content_type: Column, default: str = ".bin") -> Column:
    kind = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    table = F.create_map(*[F.lit(x) for kv in MIME_EXTENSIONS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, kind), F.lit(default))


def disposition_filename(header: Column) -> Column:
    """File name of a Content-Disposition header: the extended form percent-decoded, else the plain one, with UTF-8 sent as Latin-1 repaired."""
    extended = F.regexp_extract(header, r"(?i)filename\*\s*=\s*[^']+''(.+)", 1)
    plain = F.trim(F.regexp_extract(header, r'(?i)filename\s*=\s*"?([^";]+)"?', 1))
    latin = ~F.regexp_like(plain, F.lit(r"[^\x00-\xff]"))
    utf8 = F.try_validate_utf8(F.encode(plain, "ISO-8859-1").cast("string"))
    return F.when(extended != "", percent_decoded(F.trim(extended))).when(latin, F.coalesce(utf8, plain)).otherwise(F.coalesce(plain, F.lit("")))


def image_filename(kind: Column, href: Column, final_url: Column, content_type: Column, disposition: Column, idx: Column, downloadable: tuple[str, ...]) -> Column:
    """File name of a downloaded image by its kind.

    Shown images take the name of the final or the first URL; linked files the
    one of the header, then those of URLs with a known extension; files of a
    drive the header's, the query's `name` or `title`, or a digest.
    """
    named = lambda c: F.nullif(c, F.lit(""))
    known = lambda u: F.when(suffix(basename(u)).isin(*downloadable), basename(u))
    numbered = F.concat(F.lit("image_"), idx.cast("string"), extension_of_mime(content_type))
    query = lambda key: named(percent_decoded(F.replace(F.regexp_extract(href, rf"[?&]{key}=([^&#]*)", 1), F.lit("+"), F.lit(" "))))
    header = named(disposition_filename(disposition))
    return (
        F.when(kind.isin("img", "og_image"), F.coalesce(named(basename(final_url)), named(basename(href)), numbered))
        .when(kind.isin("linked_direct", "linked_keyword"), F.coalesce(header, known(final_url), known(href), numbered))
        .otherwise(F.coalesce(header, query("name"), query("title"), F.concat(F.substring(F.md5(href), 1, 12), extension_of_mime(content_type))))
    )


def media_filename(url: Column, content_type: Column, disposition: Column, known: tuple[str, ...]) -> Column:
    """File name of a medium: header, URL with a known extension, else a digest with the content type's extension."""
    name = basename(url)
    return F.coalesce(F.nullif(disposition_filename(disposition), F.lit("")), F.when(suffix(name).isin(*known), name), F.concat(F.substring(F.md5(url), 1, 12), extension_of_mime(content_type, "")))


def asset_filename(url: Column) -> Column:
    """`{stem}_{8 hex digits of the URL's digest}{extension}`."""
    name = basename(url)
    return F.concat(F.coalesce(F.nullif(stem(name), F.lit("")), F.lit("asset")), F.lit("_"), F.substring(F.md5(url), 1, 8), suffix(name))


def url_slug(url: Column, longest: int = 120) -> Column:
    """Name of a page: last path segment, else the URL with other characters as `_`."""
    last = F.element_at(F.concat(F.array(F.lit("")), F.filter(F.split(path_of(url), "/"), lambda x: x != "")), -1)
    return F.substring(F.coalesce(F.nullif(last, F.lit("")), F.regexp_replace(url, r"(?U)[^\w-]", "_")), 1, longest)


def title_slug(title: Column) -> Column:
    return F.trim(F.regexp_replace(title, r"(?U)[\s\-_]+", "-"), F.lit("-"))


def date_folder(date: Column) -> Column:
    """`YYYY/MM` of a date text; a lone part as it is, `unknown` for none."""
    parts = F.split(date, "-")
    return F.when(F.size(parts) >= 2, F.concat(F.get(parts, F.lit(0)), F.lit("/"), F.get(parts, F.lit(1)))).otherwise(F.coalesce(F.nullif(date, F.lit("")), F.lit("unknown")))


# Names of weekdays, Monday first.
WEEKDAYS_KO = ("월요일", "화요일", "수요일", "목요일", "금요일", "토요일", "일요일")


def long_date_ko(date: Column) -> Column:
    """Date with its weekday in Korean, as listings show it."""
    day = F.element_at(F.array(*map(F.lit, WEEKDAYS_KO)), F.weekday(date) + 1)
    return F.concat(F.year(date).cast("string"), F.lit("년 "), F.month(date).cast("string"), F.lit("월 "), F.day(date).cast("string"), F.lit("일 "), day)


def source_tag(url: Column, tags: dict[str, str]) -> Column:
    """Mark of the place a replacement came from, by a part of its URL; '' for none. The first that fits counts."""
    out = F.lit("")
    for part, tag in reversed(tags.items()):
        out = F.when(F.contains(url, F.lit(part)), F.lit(tag)).otherwise(out)
    return out


def relative_prefix(depth: Column) -> Column:
    return F.repeat(F.lit("../"), depth)


@F.pandas_udf(T.StringType())
def url_join(base: pd.Series, ref: pd.Series) -> pd.Series:
    """RFC 3986 resolution of ref against base; null for a null on either side, ref itself where it can't be parsed."""

    def join(b: str | None, r: str | None) -> str | None:
        if b is None or r is None:
            return None
        try:
            return urllib.parse.urljoin(b, r)
        except ValueError:
            return r

    return pd.Series([join(b, r) for b, r in zip(base, ref)], dtype="object")


@F.pandas_udf(T.StringType())
def strip_ref_encoded(url: pd.Series) -> pd.Series:
    """URL without its ref parameter and with the rest of the query encoded anew, repeated keys side by side."""

    def strip(u: str | None) -> str | None:
        if u is None or "ref=" not in u:
            return u
        try:
            parts = urllib.parse.urlsplit(u)
        except ValueError:
            return u
        grouped: dict[str, list[str]] = {}
        for k, v in urllib.parse.parse_qsl(parts.query, keep_blank_values=True):
            grouped.setdefault(k, []).append(v)
        if "ref" not in grouped:
            return u
        del grouped["ref"]
        return urllib.parse.urlunsplit(parts._replace(query=urllib.parse.urlencode(grouped, doseq=True)))

    return pd.Series([strip(u) for u in url], dtype="object")
