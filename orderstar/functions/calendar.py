"""Calendar attribute expressions and clock-relative bounds.

The clock is always an argument (``as_of``), never ``current_date()`` inside an operator, so results are
reproducible and Catalyst folds the bound into a literal before partition pruning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderstar.functions.keys import date_key, period_key

# Weekend days in Spark's dayofweek numbering (1 = Sunday, 7 = Saturday) and the months
# flagged as quarter start (the whole first month of each quarter is flagged, as in the original).
WEEKEND_DAYS = (1, 7)
QUARTER_START_MONTHS = (1, 4, 7, 10)


def as_date_literal(value: dt.date | str | Column | None) -> Column:
    """A DATE column from a Python date / ISO string / Column; ``None`` means ``current_date()``."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)))


def as_timestamp_literal(value: dt.datetime | str | Column | None) -> Column:
    """A TIMESTAMP column; ``None`` means ``current_timestamp()``."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        # parsed by Spark in the session time zone, so it prints back unchanged whatever the zone
        return F.lit(dt.datetime.fromisoformat(value).isoformat(sep=" ")).cast("timestamp")
    return F.lit(value).cast("timestamp")


def window_start_period(as_of: dt.date | str | Column | None, months: int) -> Column:
    """First ``yyyyMM`` period of a window of ``months`` calendar months ending at ``as_of``'s month.

    ``months=3`` gives ``yyyymm(add_months(as_of, -2))``. There is deliberately no upper bound (later
    periods are included), as in the original.
    """
    return period_key(F.add_months(as_date_literal(as_of), -(months - 1)))


def calendar_attributes(date_col: str | Column, as_of: dt.date | str | Column | None) -> list[Column]:
    """The 20 calendar columns, in output order."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    today = as_date_literal(as_of)
    flag = lambda cond: F.when(cond, F.lit(1)).otherwise(F.lit(0))
    return [
        date_key(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "yyyyMM").alias("period"),
        period_key(d).alias("period_int"),
        F.concat(F.year(d), F.lit("-"), F.lpad(F.month(d).cast("string"), 2, "0")).alias("year_month"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "E").alias("day_name_short"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        flag(F.dayofweek(d).isin(*WEEKEND_DAYS)).alias("is_weekend"),
        flag(d == today).alias("is_today"),
        flag(F.month(d).isin(*QUARTER_START_MONTHS)).alias("is_quarter_start"),
        flag(F.dayofmonth(d) == 1).alias("is_month_start"),
        F.last_day(d).alias("month_end_date"),
        flag(d == F.last_day(d)).alias("is_month_end"),
    ]
