"""Per-customer features over a rolling window of calendar months (the gold table).

Original formulation: two scans of ``lines LEFT JOIN customer/product/calendar``, three
``COUNT(DISTINCT ...)`` in one aggregate (planned by Spark as ``Expand`` x4 rows), and a ``LAG`` window
over each customer's orders. We compute the same numbers with a plan that holds at scale:

1. window lines: ``period >= start`` is a partition filter on the fact table (pruned at the scan);
2. channel: the customer keys of the channel are counted; if they fit the broadcast bound they are
   broadcast into a left-semi join on the lines (no shuffle of lines), otherwise the semi join is applied
   after aggregation, on customer-grain rows that are already partitioned by ``customer_id``;
3. order grain: ``GROUP BY customer_id, order_id`` with map-side partial aggregation (sum, credit sum,
   promo flag, date key) — a hot order or customer collapses before the shuffle;
4. customer grain: plain ``count/sum/min/max`` (again partial + final) instead of distinct counts;
5. categories: product category looked up map-side (broadcast within the bound) -> distinct count;
6. the mean gap between consecutive orders needs no window: along a customer's orders sorted by date the
   gaps telescope, so ``AVG(datediff(d_i, d_{i-1})) = (max(d) - min(d)) / (k - 1)`` with ``k`` the number
   of dated orders (NULL when ``k < 2``; orders without a calendar date contribute no gap, exactly as
   ``LAG`` + ``AVG`` skipping NULLs). No customer's orders are ever gathered into one task.

``order_lag`` gives the previous order date itself (the original ``LAG``), computed without a per-customer
window over orders (see its docstring).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from orderstar.functions.calendar import as_date_literal, window_start_period
from orderstar.functions.metrics import conditional_amount, days_to_month_end, safe_ratio
from orderstar.operators.dimensions import bounded_calendar
from orderstar.operators.sizing import broadcast_if_within

# The channel, payment type and promo flag the original features select on, and the
# window length in calendar months.
DEFAULT_CHANNEL = "tradicional"
DEFAULT_CREDIT_TYPE = "credito"
PROMO_FLAG_VALUE = 1
WINDOW_MONTHS = 3

# Channel customer sets up to this many keys are broadcast (ints: a few tens of MB at most).
MAX_BROADCAST_CUSTOMERS = 2_000_000

FEATURE_COLUMNS = (
    "customer_id", "recencia_dias", "ventas_total_3m", "frecuencia_pedidos_3m", "ticket_promedio_3m",
    "dias_promedio_entre_pedidos", "variedad_categorias_3m", "porcentaje_pedidos_promo_3m",
    "mix_credito_vs_contado_3m",
)


@dataclass(frozen=True)
class FeatureParams:
    as_of: dt.date | str | None = None  # None = current_date()
    channel: str = DEFAULT_CHANNEL
    credit_type: str = DEFAULT_CREDIT_TYPE
    promo_value: int = PROMO_FLAG_VALUE
    months: int = WINDOW_MONTHS
    max_broadcast_customers: int = MAX_BROADCAST_CUSTOMERS

    @property
    def as_of_col(self) -> Column:
        return as_date_literal(self.as_of)


def channel_customers(dim_customer: DataFrame, channel: str) -> DataFrame:
    return dim_customer.filter(F.col("channel") == F.lit(channel)).select("customer_id")


def window_fact_lines(fact_lines: DataFrame, p: FeatureParams) -> DataFrame:
    """Fact lines of the window (``period >= start``; no upper bound, as in the original)."""
    return fact_lines.filter(F.col("period") >= window_start_period(p.as_of, p.months))


def channel_window_filter(
    fact_lines: DataFrame, dim_customer: DataFrame, p: FeatureParams
) -> DataFrame:
    """Window lines of customers in the channel (the ``WHERE`` of both original CTEs).

    ``LEFT JOIN customer ... WHERE channel = x`` is an inner join, and with unique customer keys it is a
    semi join: the lines keep their columns and never fan out.
    """
    lines = window_fact_lines(fact_lines, p)
    keys = channel_customers(dim_customer, p.channel)
    return lines.join(_semi_side(keys, p), "customer_id", "left_semi")


def _semi_side(keys: DataFrame, p: FeatureParams) -> DataFrame:
    return broadcast_if_within(keys, p.max_broadcast_customers)


def _date_lookup(dim_date: DataFrame) -> DataFrame:
    return dim_date.select(F.col("date_id").alias("order_date_id"), F.col("date").alias("order_date"))


def _order_grain(lines: DataFrame, p: FeatureParams) -> DataFrame:
    """One row per (customer, order): the order's date key, net sum, credit sum and promo flag."""
    return lines.groupBy("customer_id", "order_id").agg(
        F.max("order_date_id").alias("order_date_id"),
        F.sum("line_net_amount").alias("order_net"),
        F.sum(conditional_amount(F.col("pay_type") == F.lit(p.credit_type), "line_net_amount")).alias("order_credit"),
        F.max(F.when(F.col("promo_flag") == F.lit(p.promo_value), 1).otherwise(0)).alias("is_promo"),
    )


def _customer_grain(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    cal = bounded_calendar(_date_lookup(dim_date), sized_by=dim_date)
    dated = orders.join(cal, "order_date_id", "left")
    return dated.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        F.count("order_date").alias("dated_orders"),
        F.count("order_id").alias("frecuencia_pedidos_3m"),
        # decimal(18,2) -> the original's single SUM type decimal(28,2)
        F.sum("order_net").cast(DecimalType(28, 2)).alias("ventas_total_3m"),
        F.count(F.when(F.col("is_promo") == 1, F.col("order_id"))).alias("promo_orders"),
        F.sum("order_credit").cast(DecimalType(28, 2)).alias("credit_sales"),
    )


def _category_variety(lines: DataFrame, dim_product: DataFrame, p: FeatureParams) -> DataFrame:
    """Distinct product categories per customer (NULL category not counted).

    With a product lookup proven small, the category is looked up map-side on every line and only
    ``(customer, category)`` pairs (partially de-duplicated) are shuffled before the per-customer count.
    Beyond the bound, distinct ``(customer, product)`` pairs are formed first, so the shuffle join by
    product moves pairs, not lines (a hot product's lines collapse map-side).
    """
    pro = dim_product.select("product_id", "product_category")
    pairs = lines.select("customer_id", "product_id")
    lookup = broadcast_if_within(pro, p.max_broadcast_customers, dim_product)
    if lookup is not pro:  # broadcast: look the category up map-side on every line
        tagged = pairs.join(lookup, "product_id", "left")
    else:
        tagged = pairs.distinct().join(pro, "product_id", "left")
    return tagged.groupBy("customer_id").agg(F.count_distinct("product_category").alias("variedad_categorias_3m"))


def _prepare(
    fact_lines: DataFrame, dim_customer: DataFrame, p: FeatureParams
) -> tuple[DataFrame, DataFrame | None]:
    """Window lines, channel-filtered early when the channel's key set is small; else the keys to apply late."""
    lines = window_fact_lines(fact_lines, p).filter(F.col("customer_id").isNotNull())
    keys = channel_customers(dim_customer, p.channel)
    side = broadcast_if_within(keys, p.max_broadcast_customers)
    if side is not keys:
        return lines.join(side, "customer_id", "left_semi"), None
    return lines, keys


def customer_sales(
    fact_lines: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    p: FeatureParams,
) -> DataFrame:
    """Customer-grain aggregates of the window (the first original CTE, plus gap inputs)."""
    lines, late_keys = _prepare(fact_lines, dim_customer, p)
    per_customer = _customer_grain(_order_grain(lines, p), dim_date)
    out = per_customer.join(_category_variety(lines, dim_product, p), "customer_id", "left")
    if late_keys is not None:
        out = out.join(late_keys, "customer_id", "left_semi")
    return out.withColumn("month_end_date", F.last_day(p.as_of_col))


def customer_features(
    fact_lines: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    p: FeatureParams,
) -> DataFrame:
    """The gold feature table: one row per customer of the channel with at least one order in the window."""
    return features_of_sales(customer_sales(fact_lines, dim_customer, dim_product, dim_date, p), p)


def features_of_sales(s: DataFrame, p: FeatureParams) -> DataFrame:
    """The features from the customers' aggregates of the window (:func:`customer_sales`)."""
    gap = F.when(
        F.col("dated_orders") >= 2,
        F.datediff("last_order_date", "first_order_date").cast("double")
        / (F.col("dated_orders") - 1).cast("double"),
    )
    return s.filter(F.col("frecuencia_pedidos_3m") > 0).select(
        "customer_id",
        days_to_month_end(p.as_of_col, "last_order_date").alias("recencia_dias"),
        "ventas_total_3m",
        "frecuencia_pedidos_3m",
        safe_ratio("ventas_total_3m", "frecuencia_pedidos_3m").alias("ticket_promedio_3m"),
        gap.alias("dias_promedio_entre_pedidos"),
        F.coalesce(F.col("variedad_categorias_3m"), F.lit(0).cast("long")).alias("variedad_categorias_3m"),
        (F.col("promo_orders") / F.col("frecuencia_pedidos_3m")).alias("porcentaje_pedidos_promo_3m"),
        safe_ratio("credit_sales", "ventas_total_3m").alias("mix_credito_vs_contado_3m"),
    )


def distinct_orders(
    fact_lines: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, p: FeatureParams
) -> DataFrame:
    """Distinct ``(customer_id, order_id, order_date)`` of the window (``GROUP BY ALL`` without aggregates)."""
    lines, late_keys = _prepare(fact_lines, dim_customer, p)
    cal = bounded_calendar(_date_lookup(dim_date), sized_by=dim_date)
    out = lines.select("customer_id", "order_id", "order_date_id").distinct()
    if late_keys is not None:
        out = out.join(late_keys, "customer_id", "left_semi")
    return out.join(cal, "order_date_id", "left").select("customer_id", "order_id", "order_date")


def order_lag(
    fact_lines: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, p: FeatureParams
) -> DataFrame:
    """Each distinct order with the customer's previous order date: ``LAG(order_date)`` over the
    customer's orders sorted by date, then order id (NULL dates first).

    No window runs over a customer's orders (a customer holding a third of all orders would be one task).
    In that order the previous row of an order has the same date unless the order is the smallest order id
    of its day; the smallest one gets the customer's previous *distinct* date. So the window runs over
    distinct ``(customer, day)`` pairs only — at most one row per calendar day per customer — and a join
    on ``(customer, date)`` puts the answer on every order. NULL-dated orders sort first and get NULL, as
    does the first dated order (its predecessor, if any, is NULL-dated).
    """
    orders = distinct_orders(fact_lines, dim_customer, dim_date, p)
    days = (
        orders.filter(F.col("order_date").isNotNull())
        .groupBy("customer_id", "order_date")
        .agg(F.min("order_id").alias("first_order_id"))
    )
    w = Window.partitionBy("customer_id").orderBy("order_date")
    days = days.withColumn("prev_date", F.lag("order_date").over(w))
    j = orders.join(days, ["customer_id", "order_date"], "left")
    last_date = F.when(F.col("order_id") > F.col("first_order_id"), F.col("order_date")).otherwise(F.col("prev_date"))
    return j.select("customer_id", "order_id", "order_date", last_date.alias("last_date"))
