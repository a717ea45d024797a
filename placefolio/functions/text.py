"""Scalar text functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf

from placefolio.params import MAX_BYTES, MAX_SLUG_CHARS

# The characters Python's str.strip() removes.
PYTHON_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(text: Column) -> Column:
    """Trim all white space on both ends (SQL ``trim`` takes spaces only)."""
    return F.btrim(text, F.lit(PYTHON_SPACE))


def split_param_list(text: Column) -> Column:
    """Comma list -> array of stripped, non-blank entries."""
    return F.filter(F.transform(F.split(text, ","), strip), lambda entry: entry != "")


def blank_to_default(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(strip(text), F.lit("")), F.lit(default))


def first_non_empty(*texts: Column) -> Column:
    return F.coalesce(*[F.nullif(text, F.lit("")) for text in texts])


def first_chars(text: Column, count: int | None) -> Column:
    """First ``count`` code points, all with ``None``."""
    return text if count is None else F.substring(text, 1, count)


def first_bytes(content: Column, count: int | None = MAX_BYTES) -> Column:
    """First ``count`` bytes of a binary column, all with ``None``."""
    return content if count is None else F.substring(content, 1, count)


def _decode_dropping_bad_bytes(content: pd.Series) -> pd.Series:
    return content.map(lambda raw: bytes(raw).decode("utf-8", "ignore"), na_action="ignore")


def bytes_to_text(content: Column) -> Column:
    """UTF-8 text of a binary column, invalid bytes left out.

    Valid content is only re-labelled in the JVM. Broken content goes to Python, the rest arrives there as null.
    """
    text = content.cast("string")
    valid = F.is_valid_utf8(text)
    by_python = pandas_udf(_decode_dropping_bad_bytes, "string").asNondeterministic()
    return F.when(valid, text).otherwise(by_python(F.when(~valid, content)))


def slug(url: Column) -> Column:
    """Percent-encode everything but unreserved characters, cut to a file-name length."""
    encoded = F.url_encode(url)
    for form_style, percent_style in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(form_style), F.lit(percent_style))
    return F.substring(encoded, 1, MAX_SLUG_CHARS)


def object_path(root: str, place_id: Column, filename: Column) -> Column:
    return F.concat_ws("/", F.lit(root), place_id, filename)


def object_key(path: Column) -> Column:
    """Part of a path behind ``raw/``: equal for all schemes and mount points. Null if there is none."""
    return F.when(F.contains(path, F.lit("raw/")), F.regexp_extract(path, "raw/(.*)$", 1))
