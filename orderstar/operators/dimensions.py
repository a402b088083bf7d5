"""Conformed dimensions: customer, product (each with an unknown member) and the calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstar.functions.calendar import as_date_literal, calendar_attributes
from orderstar.functions.keys import key_or_default
from orderstar.operators.dedupe import keep_first, latest_per_key
from orderstar.operators.sizing import broadcast_if_within
from orderstar.operators.standardize import (
    CUSTOMER_SPEC,
    PRODUCT_SPEC,
    parsed_rows,
    standardize_customer,
    standardize_product,
    widen_ids,
)

# The unknown ("dummy") members appended to each dimension, key 0.
CUSTOMER_UNKNOWN: Mapping[str, object] = {
    "customer_id": 0,
    "customer_name": "Sin Cliente",
    "channel": "Sin Canal",
    "actual_segment": "N/A",
    "region": "N/A",
    "comuna": "N/A",
    "entry_date": None,
    "status": None,
    "mix_credito_vs_contado_3m": None,
}
PRODUCT_UNKNOWN: Mapping[str, object] = {
    "product_id": 0,
    "product_category": "Sin Categoria",
    "product_sub_category": "Sin Subcategoria",
    "product_brand": "Sin Marca",
}

# A calendar is one row per day, and a Spark date lies in the years 1 to 9999: every calendar is within this
# bound (two narrow columns, under 100 MB), so its lookup never becomes a shuffle join on the date.
MAX_CALENDAR_DAYS = 3_652_059
# Days per partition of a generated calendar (one file for any usual range).
CALENDAR_DAYS_PER_PARTITION = 400_000


def union_unknown_member(df: DataFrame, member: Mapping[str, object]) -> DataFrame:
    """Append one literal row, typed like ``df`` (``UNION ALL`` with the dummy member)."""
    spark = df.sparkSession
    row = spark.range(0, 1, 1, 1).select(
        *[F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row)


def _finish_dimension(
    latest: DataFrame, key: str, member: Mapping[str, object], drop_null_keys: bool, sort: bool
) -> DataFrame:
    if drop_null_keys:
        # A NULL key would become 0 and collide with the unknown member (join fan-out); drop it.
        latest = latest.filter(F.col(key).isNotNull())
    else:
        latest = latest.withColumn(key, key_or_default(key))
    out = union_unknown_member(latest, member)
    # A global sort is layout only (a range shuffle); off by default.
    return out.orderBy(key) if sort else out


def dim_customer(
    bronze: DataFrame,
    tie_breakers: Sequence[str | Column] | None = None,
    drop_null_keys: bool = True,
    sort: bool = False,
    id_type: str = "int",
) -> DataFrame:
    """Latest row per customer (by ``entry_date``) plus the unknown member. Rows whose id does not parse are not
    members (see ``standardize.rejected_rows``)."""
    std = standardize_customer(parsed_rows(bronze, widen_ids(CUSTOMER_SPEC, id_type), ["customer_id"]), id_type)
    latest = latest_per_key(std, ["customer_id"], "entry_date", tie_breakers)
    return _finish_dimension(latest, "customer_id", CUSTOMER_UNKNOWN, drop_null_keys, sort)


def dim_product(
    bronze: DataFrame,
    tie_breakers: Sequence[str | Column] | None = None,
    drop_null_keys: bool = True,
    sort: bool = False,
    id_type: str = "int",
) -> DataFrame:
    """One row per product (deterministic tie-break) plus the unknown member; unparsed ids as in ``dim_customer``."""
    std = standardize_product(parsed_rows(bronze, widen_ids(PRODUCT_SPEC, id_type), ["product_id"]), id_type)
    latest = keep_first(std, ["product_id"], [], tie_breakers)
    return _finish_dimension(latest, "product_id", PRODUCT_UNKNOWN, drop_null_keys, sort)


def _to_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def calendar_days(start: dt.date | str, end: dt.date | str) -> int:
    """Rows of a calendar from ``start`` to ``end`` inclusive."""
    return max((_to_date(end) - _to_date(start)).days + 1, 0)


def dim_date(
    spark: SparkSession,
    start: dt.date | str,
    end: dt.date | str,
    as_of: dt.date | str | Column | None = None,
    sort: bool = False,
) -> DataFrame:
    """Calendar dimension, one row per day in ``[start, end]``, 20 attribute columns.

    Generated with ``spark.range`` (distributed, no driver-side list and no single-row array to explode).
    ``as_of`` drives ``is_today``; ``None`` means ``current_date()``.
    """
    n = calendar_days(start, end)
    days = spark.range(0, n, 1, max(1, -(-n // CALENDAR_DAYS_PER_PARTITION))).select(
        F.date_add(F.lit(_to_date(start)), F.col("id").cast("int")).alias("date")
    )
    out = days.select(*calendar_attributes("date", as_of))
    return out.orderBy("date") if sort else out


def calendar_range_from(dates: DataFrame, date_col: str) -> tuple[dt.date, dt.date]:
    """(first day of the first year, last day of the last year) covering ``date_col`` — one scalar job.

    Without any date it is the current year. Years beyond 9999, which Python dates cannot hold, are left out."""
    year = F.year(date_col)
    row = dates.filter((year >= 1) & (year <= 9999)).agg(F.min(year).alias("lo"), F.max(year).alias("hi")).first()
    this = dt.date.today().year
    return dt.date(row["lo"] or this, 1, 1), dt.date(row["hi"] or this, 12, 31)


def bounded_calendar(
    calendar: DataFrame, max_days: int = MAX_CALENDAR_DAYS, sized_by: DataFrame | None = None
) -> DataFrame:
    """Broadcast the calendar when its row count (or that of ``sized_by``, the calendar it was projected
    from) is within ``max_days``; otherwise leave it to the planner."""
    return broadcast_if_within(calendar, max_days, sized_by)


__all__ = [
    "CUSTOMER_UNKNOWN",
    "PRODUCT_UNKNOWN",
    "as_date_literal",
    "bounded_calendar",
    "calendar_days",
    "calendar_range_from",
    "dim_customer",
    "dim_date",
    "dim_product",
    "union_unknown_member",
]
