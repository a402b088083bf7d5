"""Standardisation expressions: typed casts of raw text/inferred columns.

Raw files are dirty; ``CAST`` raises under ANSI mode (Spark 4 default) and returns NULL otherwise, so we
use ``try_cast`` everywhere: a value that does not parse becomes NULL and is counted by
``operators.quality.cast_failures`` instead of failing the whole job. Rows whose *key* does not parse are not
merged into one NULL key: ``operators.standardize`` sets them aside. ``VARCHAR(n)`` lengths in the
original SQL are not enforced by Spark (no truncation), so text columns are plain trimmed strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

# Kinds understood by a column spec (see operators.standardize).
MONEY = DecimalType(18, 2)

KIND_TYPES: dict[str, DataType | str] = {
    "int": "int",
    "bigint": "bigint",
    "double": "double",
    "date": "date",
    "timestamp": "timestamp",
    "money": MONEY,
    "text": "string",
}


def text(col: str | Column) -> Column:
    """``TRIM(CAST(x AS VARCHAR))`` — trims spaces only (tabs are kept), never truncates."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c.try_cast("string"))


def typed(col: str | Column, kind: str) -> Column:
    """Cast a raw column to one of ``KIND_TYPES``; unparsable values become NULL."""
    c = F.col(col) if isinstance(col, str) else col
    if kind == "text":
        return text(c)
    return c.try_cast(KIND_TYPES[kind])
