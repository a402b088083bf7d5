"""Metric expressions shared by the feature operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with NULL (not an ANSI error) when ``den`` is 0 or NULL. Keeps Spark's result type."""
    return F.try_divide(_c(num), _c(den))


def days_to_month_end(as_of_date: Column, last_date: str | Column) -> Column:
    """Recency: days from ``last_date`` to the end of ``as_of``'s month (not to ``as_of`` itself)."""
    return F.datediff(F.last_day(as_of_date), _c(last_date))


def conditional_amount(cond: Column, amount: str | Column) -> Column:
    """``CASE WHEN cond THEN amount ELSE 0 END``."""
    return F.when(cond, _c(amount)).otherwise(F.lit(0))
