"""Broadcast decisions behind an explicit size check.

A side is broadcast only when a row count proves it small; beyond the bound the plan keeps its shuffle
join. The count is one job (metadata-only for a plain parquet table); deciding before planning avoids the
shuffle-write of the large side that a runtime (AQE) conversion still pays.

The count can be taken on a DataFrame that bounds the side (``sized_by``): a projection of a dimension
has exactly the dimension's rows, so every lookup derived from one dimension object shares one count.
Counts are remembered per DataFrame object (a DataFrame is an immutable plan; a re-read of changed files
is a new object and is counted again).
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Up to this many rows of narrow key columns (a few tens of MB) are broadcast ...
MAX_BROADCAST_ROWS = 2_000_000
# ... and never more than this many estimated bytes (rows x estimated row width of the broadcast side).
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# In-memory bytes per value, by type (other types: 16). The bytes of strings are measured, see ``broadcast_if_within``;
# each also takes an offset word.
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
          T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.StringType: 16}

_row_counts: weakref.WeakKeyDictionary[DataFrame, int] = weakref.WeakKeyDictionary()


def row_count(df: DataFrame) -> int:
    """``df.count()``, computed once per DataFrame object."""
    n = _row_counts.get(df)
    if n is None:
        n = df.count()
        _row_counts[df] = n
    return n


def fits(df: DataFrame, max_rows: int) -> bool:
    return row_count(df) <= max_rows


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row of ``df`` (8 bytes of row overhead plus a per-type width)."""
    return 8 + sum(_WIDTH.get(type(f.dataType), 16) for f in df.schema.fields)


def broadcast_if_within(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    sized_by: DataFrame | None = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when ``sized_by`` (default ``df``; it must have at least ``df``'s rows) has at most
    ``max_rows`` rows and those rows, with ``df``'s fixed width and the measured bytes of its strings, fit in
    ``max_bytes``; else ``df`` unchanged (the planner keeps a shuffle join)."""
    whole = df if sized_by is None else sized_by
    if whole in _row_counts or not _strings(df):
        n = row_count(whole)
        text = string_bytes(df) if n <= max_rows else 0
    else:  # rows and bytes in one pass: a dimension that is still a plan is worked out once for both
        n, text = df.agg(F.count(F.lit(1)), _text(df)).first()
        if sized_by is None:
            _row_counts[whole] = n
    small = n <= max_rows and n * row_width(df) + int(text) <= max_bytes
    return F.broadcast(df) if small else df


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _text(df: DataFrame):
    """Aggregate: the bytes of all string values."""
    each = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in _strings(df)]
    return sum(each[1:], each[0])


def string_bytes(df: DataFrame) -> int:
    """Bytes of all string values of ``df`` (one aggregate; none where it has no string column)."""
    return int(df.agg(_text(df).alias("n")).first()["n"]) if _strings(df) else 0
