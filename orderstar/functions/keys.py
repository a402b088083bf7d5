"""Key expressions: defaults for missing keys, surrogate hash keys, integer date keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the original pipeline's for identical keys):
#   hash separator "||", unknown-member key 0, date key formats "yyyyMMdd" and "yyyyMM".
HASH_SEPARATOR = "||"
UNKNOWN_KEY = 0
DATE_KEY_FORMAT = "yyyyMMdd"
PERIOD_FORMAT = "yyyyMM"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def key_or_default(col: str | Column, default: int = UNKNOWN_KEY) -> Column:
    """``COALESCE(key, 0)``: a missing key points at the unknown member."""
    return F.coalesce(_c(col), F.lit(default))


def first_non_null(*cols: str | Column, default: int | None = None) -> Column:
    """``COALESCE(a, b, ..., default)`` across join sides."""
    parts = [_c(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def hash_key(cols: Sequence[str | Column], null_token: str | None = None) -> Column:
    """MD5 hex of ``concat_ws('||', ...)``.

    ``concat_ws`` skips NULL parts, so by default ``(1, NULL, 2)`` and ``(1, 2, NULL)`` hash alike, as in
    the original; pass ``null_token`` to encode NULLs explicitly instead.
    """
    parts = [_c(c).cast("string") for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def date_key(col: str | Column) -> Column:
    """``CAST(date_format(d, 'yyyyMMdd') AS INT)``."""
    return F.date_format(_c(col), DATE_KEY_FORMAT).cast("int")


def period_key(col: str | Column) -> Column:
    """``CAST(date_format(d, 'yyyyMM') AS INT)``."""
    return F.date_format(_c(col), PERIOD_FORMAT).cast("int")
