"""URL parts and link resolution."""

from __future__ import annotations

from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def is_same_site(url: Column, base: Column) -> Column:
    """http(s) link with the authority of the base: case counts, and so does the port."""
    return scheme(url).isin("http", "https") & (authority(url) == authority(base))


def is_pdf_url(url: Column) -> Column:
    """Lower-cased URL up to the first ``?`` ends in ``.pdf``; a ``#fragment`` is not cut off."""
    return F.endswith(F.substring_index(F.lower(url), "?", 1), F.lit(".pdf"))


def robots_address(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), authority(url), F.lit("/robots.txt"))


def percent_decoded(text: Column) -> Column:
    """Undo percent-encoding, escape by escape; a ``+`` stays a ``+``, and so does a ``%`` without two hex digits."""
    valid = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.try_url_decode(F.replace(valid, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(text, F.lit("%")), F.coalesce(decoded, text)).otherwise(text)


def robots_target(url: Column) -> Column:
    """What crawl rules are matched against: everything behind the authority, ``/`` if that is nothing."""
    rest = F.regexp_replace(percent_decoded(url), "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.coalesce(F.nullif(without_empty_parts(rest), F.lit("")), F.lit("/"))


def without_empty_parts(path: Column) -> Column:
    """Drop a ``?`` or ``#`` that nothing follows."""
    return F.regexp_replace(F.regexp_replace(path, "#$", ""), r"\?(#|$)", "$1")


# Shapes that resolve by joining strings. Anything else (dot segments, path parameters, control characters,
# odd schemes or hosts) is left to the standard library.
_TAIL = r"(?:\?[^\x00-\x20#]+)?(?:#[^\x00-\x20]+)?$"
_PLAIN_ABSOLUTE = r"^https?://[A-Za-z0-9._-]+(?::[0-9]+)?(?:/[^\x00-\x20?#;]*)?" + _TAIL
_PLAIN_ROOTED = r"^/(?:[^/\x00-\x20?#;\\][^\x00-\x20?#;]*)?" + _TAIL
_PLAIN_RELATIVE = r"^[A-Za-z0-9_~-][^\x00-\x20?#;:]*" + _TAIL
_PLAIN_QUERY = r"^\?[^\x00-\x20#]+(?:#[^\x00-\x20]+)?$"
_PLAIN_FRAGMENT = r"^#[^\x00-\x20]+$"
_DOT_SEGMENT = r"^[^?#]*(?:^|/)\.{1,2}(?:[/?#]|$)"
_EMPTY_SEGMENT = r"^[^?#]*//"


def _join_by_library(base: pd.Series, href: pd.Series) -> pd.DataFrame:
    def join(site, link):
        if link is None:
            return None, None
        try:
            url = urljoin(site, link)
            urlsplit(url)
            return url, None
        except ValueError as problem:
            return None, f"ValueError: {problem}"

    return pd.DataFrame([join(site, link) for site, link in zip(base, href)], columns=["url", "error"])


def join_by_library(base: Column, href: Column) -> Column:
    """``struct<url, error>`` of a link of any shape; a null link gives nulls."""
    return pandas_udf(_join_by_library, "url string, error string").asNondeterministic()(base, href)


def join_plain(base: Column, href: Column) -> Column:
    """Absolute URL of a link of plain shape, null for all others."""
    root = F.regexp_extract(base, "^(https?://[^/?#]+)", 1)
    before_query = F.regexp_extract(base, "^([^?#]*)", 1)
    before_fragment = F.regexp_extract(base, "^([^#]*)", 1)
    path = F.regexp_extract(base, "^https?://[^/?#]+([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, "^(.*/)", 1), F.lit("")), F.lit("/"))
    return F.when(base.rlike(_PLAIN_ABSOLUTE), (
        F.when(href.rlike(_PLAIN_ABSOLUTE), href)
        .when(href.rlike(_PLAIN_ROOTED) & ~href.rlike(_DOT_SEGMENT), F.concat(root, href))
        .when(href.rlike(_PLAIN_FRAGMENT), F.concat(before_fragment, href))
        .when(href.rlike(_PLAIN_QUERY), F.concat(before_query, href))
        .when(href.rlike(_PLAIN_RELATIVE) & ~F.concat(path, F.lit("/"), href).rlike(_DOT_SEGMENT)
              & ~F.contains(path, F.lit("//")) & ~href.rlike(_EMPTY_SEGMENT), F.concat(root, folder, href))))
