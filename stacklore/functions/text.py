"""Column functions for text, markup fragments and URLs.

Everything is a built-in expression except `decode_entities`: Spark has no HTML entity
decoder, so that one is an Arrow-batched pandas UDF, applied to extracted fields only.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# White space as Python's str.strip() sees it: Unicode White_Space plus U+001C..U+001F.
_SPACE = r"[\s\x1c-\x1f]"
_MARKUP = r"(?s)<!--.*?-->|<[^>]*>"
# Joins text pieces for one decoding pass; U+0000 cannot be produced by an entity.
_PIECE = "\u0000"


def strip(text: Column) -> Column:
    """Drop leading and trailing Unicode white space (SQL `trim` only drops spaces)."""
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


@F.pandas_udf(StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


def decode_entities(text: Column) -> Column:
    """Replace HTML character references by the characters they stand for."""
    return _unescape(text)


def inner_text(markup: Column) -> Column:
    """Text of an element: tags and comments removed, entities decoded, ends stripped."""
    return strip(decode_entities(F.regexp_replace(markup, _MARKUP, "")))


def stripped_pieces(markup: Column) -> Column:
    """Text of an element with every text piece stripped, joined without separator."""
    pieces = F.split(F.translate(markup, _PIECE, ""), _MARKUP)
    decoded = F.split(decode_entities(F.array_join(pieces, _PIECE)), _PIECE)
    return F.array_join(F.transform(decoded, strip), "")


def open_tag(name: str, css_class: str | None = None, element_id: str | None = None) -> str:
    """Regex for an opening tag, optionally with a class token or an id."""
    if element_id is not None:
        return rf"""<{name}\b[^>]*\bid\s*=\s*["']?{element_id}["']?(?=[\s>])[^>]*>"""
    if css_class is not None:
        token = rf"""["'](?:[^"'>]*\s)?{css_class}(?:\s[^"'>]*)?["']"""
        return rf"<{name}\b[^>]*\bclass\s*=\s*{token}[^>]*>"
    return rf"<{name}\b[^>]*>"


def first_match(text: Column, pattern: str) -> Column:
    """First substring matching `pattern`, NULL when there is none."""
    return F.regexp_substr(text, F.lit(pattern))


def element_body(text: Column, name: str, css_class: str | None = None) -> Column:
    """Markup between the first `name` tag and its closing tag, NULL when absent."""
    tag = open_tag(name, css_class)
    whole = first_match(text, rf"(?s){tag}.*?</{name}\s*>")
    return F.regexp_replace(whole, rf"(?s)^{tag}|</{name}\s*>\z", "")


def attribute(tag: Column, name: str) -> Column:
    """Raw value of an attribute in the first tag of `tag`, NULL when absent."""
    opening = first_match(tag, r"^[^>]*>")
    pair = first_match(opening, rf"""(?i)(?<=\s){name}\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+)""")
    return F.regexp_replace(pair, rf"""(?i)^{name}\s*=\s*["']?|["']\z""", "")


def leading_int(text: Column) -> Column:
    """First run of digits as an integer, 0 when there is none; NULL when it does not fit."""
    digits = first_match(text, r"\d+")
    return F.when(digits.isNull(), F.lit(0)).otherwise(digits.try_cast("int"))


def from_end(text: Column, separator: str, position: int) -> Column:
    """`text.split(separator)[-position]`."""
    return F.element_at(F.split(text, rf"\Q{separator}\E"), -position)


def url_join(base: Column, href: Column) -> Column:
    """Resolve `href` against an absolute http(s) `base` URL, as browsers do."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)//", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    suffix = F.regexp_replace(F.regexp_replace(href, r"^[^?#]*", ""), r"#\z", "")
    # An empty query or fragment leaves no mark.
    suffix = F.regexp_replace(suffix, r"^\?(?=#|\z)", "")

    # Empty segments are kept in a rooted path and dropped from a merged one.
    folder = F.regexp_replace(F.concat(F.lit("/"), base_path), r"^/(?=/)|[^/]*\z", "")
    merged = F.split(F.concat(folder, path), "/")
    inner = F.filter(F.slice(merged, 2, F.size(merged) - 2), lambda s: s != "")
    relative = F.concat(F.slice(merged, 1, 1), inner, F.slice(merged, -1, 1))
    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(relative)
    walked = F.aggregate(segments, F.array().cast("array<string>"), _walk)
    # A trailing "." or ".." names a folder, which keeps its closing slash.
    folded = F.when(
        F.element_at(segments, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))
    ).otherwise(walked)
    resolved = F.regexp_replace(F.array_join(folded, "/"), r"^(?!/)", "/")

    return (
        F.when(href.isNull() | base.isNull(), F.lit(None).cast("string"))
        .when(href == "", base)
        .when(href.startswith(F.concat(scheme, F.lit("//"))), F.concat(path, suffix))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, path, suffix))
        .when(
            href.startswith("#") | href.rlike(r"^\?(#|\z)"),
            F.concat(F.regexp_replace(base, r"#.*", ""), suffix),
        )
        .when(href.startswith("?"), F.concat(origin, base_path, suffix))
        .otherwise(F.concat(origin, resolved, suffix))
    )


def _walk(path: Column, segment: Column) -> Column:
    return (
        F.when(segment == "..", F.slice(path, 1, F.greatest(F.size(path) - 1, F.lit(0))))
        .when(segment == ".", path)
        .otherwise(F.concat(path, F.array(segment)))
    )


def strip_base(url: Column, base_url: str) -> Column:
    """Make URLs below `base_url` relative to it."""
    return F.replace(url, F.lit(base_url.rstrip("/") + "/"), F.lit(""))


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def utc_timestamp(text: Column) -> Column:
    """ISO text to a UTC wall-clock timestamp; an offset shifts, no offset means UTC."""
    zoned = F.when(text.rlike(r"(?i)(z|[+-]\d{2}:?\d{2})\s*$"), text).otherwise(
        F.concat(text, F.lit("Z"))
    )
    local = zoned.cast("timestamp").cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
