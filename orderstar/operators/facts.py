"""Order facts: order grain (``fact_order``) and order-line grain (``fact_order_line``).

Plan shape for the line fact (the large one):

* headers: standardise -> latest per ``order_id`` (WindowGroupLimit, one shuffle by ``order_id``);
  their customer / calendar lookups are done here, at *order* grain, which is several times smaller than
  the line grain — the lines never get shuffled by ``customer_id``.
* lines: standardise -> one per ``(order_id, line_id)``; then ``lines LEFT JOIN headers`` on
  ``order_id`` (sort-merge at scale). This shuffles lines twice. AQE splits a hot ``order_id`` on the line side
  when the headers come from a written table (``headers=``, as the medallion run does): both join inputs
  are then a sort directly over an exchange. In the one-plan form the headers reuse their dedupe
  partitioning instead, which saves their second shuffle and gives that split up; ``heavy_rows`` brings it back
  (hot orders are found first and joined by broadcast).
* the ``amount > 0 OR units > 0`` filter sits right after that join (it needs both sides, so it cannot
  go lower) and before the product lookup, so the product join sees only surviving lines.
* dimensions are joined by key only (the fact keeps the foreign key when the member exists, else NULL);
  each key set is broadcast behind a row-count check (``max_broadcast_rows``) and shuffled beyond it.
  With a broadcast customer lookup the headers keep their ``order_id`` partitioning from the dedupe, so
  the line join reuses it (headers shuffle once instead of three times).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstar.functions.keys import (
    UNKNOWN_KEY,
    date_key,
    first_non_null,
    hash_key,
    key_or_default,
    period_key,
)
from orderstar.operators.dedupe import keep_first, latest_per_key
from orderstar.operators.dimensions import bounded_calendar
from orderstar.operators.sizing import MAX_BROADCAST_ROWS, broadcast_if_within, row_count
from orderstar.operators.standardize import (
    ORDER_HEADER_SPEC,
    ORDER_LINE_SPEC,
    parsed_rows,
    standardize_order_header,
    standardize_order_line,
    widen_ids,
)
from orderstar.session import scratch_path


def latest_order_headers(
    bronze_header: DataFrame,
    tie_breakers: Sequence[str | Column] | None = None,
    id_type: str = "int",
    from_period: Column | None = None,
) -> DataFrame:
    """Standardised headers, the latest ``order_date`` per ``order_id`` (cast first, then dedupe).

    Rows whose order id does not parse, or does not fit ``id_type``, are left to ``standardize.rejected_rows``:
    they would all share the key NULL. ``from_period``: only orders whose latest date is in that month or later. Their latest
    row is one of these months, so earlier and undated rows go before the dedupe."""
    raw = parsed_rows(bronze_header, widen_ids(ORDER_HEADER_SPEC, id_type), ["order_id"])
    std = standardize_order_header(raw, id_type)
    if from_period is not None:
        std = std.filter(period_key("order_date") >= from_period)
    return latest_per_key(std, ["order_id"], "order_date", tie_breakers)


def latest_order_lines(
    bronze_detail: DataFrame,
    tie_breakers: Sequence[str | Column] | None = None,
    id_type: str = "int",
    of_orders: DataFrame | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Standardised lines, one per ``(order_id, line_id)`` (deterministic among exact-key duplicates); rows with
    an unparsed order or line id are rejects, as for headers.

    ``of_orders``: written headers that the lines will be joined with, where other orders' lines are not wanted. Within the
    broadcast bound only their lines reach the dedupe. Beyond it the lines are dealt by order, so dedupe and join share one
    shuffle and one sort (as in any join by order without ``heavy_rows``, an order's lines are then in one task); other
    orders' lines are still among the rows."""
    raw = parsed_rows(bronze_detail, widen_ids(ORDER_LINE_SPEC, id_type), ["order_id", "line_id"])
    std = standardize_order_line(raw, id_type)
    if of_orders is not None:
        wanted = of_orders.select(F.col("order_id").alias("wanted_id"))
        side = broadcast_if_within(wanted, max_broadcast_rows)
        std = std.repartition("order_id") if side is wanted else std.join(side, std["order_id"] == side["wanted_id"], "left_semi")
    return keep_first(std, ["order_id", "line_id"], [F.col("line_id").desc()], tie_breakers)


def fact_order(
    bronze_header: DataFrame,
    dim_customer: DataFrame,
    map_unmatched_to_unknown: bool = False,
    tie_breakers: Sequence[str | Column] | None = None,
    sort: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    id_type: str = "int",
    headers: DataFrame | None = None,
) -> DataFrame:
    """Order-grain fact: latest header per order, positive net amount only (filter *after* dedupe).

    ``headers``: already deduplicated headers (``bronze_header`` is then not read)."""
    if headers is None:
        headers = latest_order_headers(bronze_header, tie_breakers, id_type)
    h = headers.filter(F.col("order_net_amount") > 0)
    h = h.select(
        # The hash uses the un-defaulted values; concat_ws skips NULL parts.
        hash_key(["order_id", "customer_id", "order_date", "channel", "pay_type", "currency"]).alias("order_key"),
        key_or_default("order_id").alias("order_id"),
        key_or_default("customer_id").alias("customer_id"),
        "order_date",
        "channel",
        "pay_type",
        "currency",
        "order_net_amount",
        "order_gross_amount",
    )
    cus = broadcast_if_within(dim_customer.select(F.col("customer_id").alias("customer_key")), max_broadcast_rows, dim_customer)
    j = h.join(cus, h["customer_id"] == cus["customer_key"], "left")
    customer_key = F.col("customer_key")
    if map_unmatched_to_unknown:
        customer_key = F.coalesce(customer_key, F.lit(UNKNOWN_KEY))
    out = j.select(
        "order_key",
        "order_id",
        customer_key.alias("customer_key"),
        date_key("order_date").alias("date_key"),
        F.col("channel").alias("channel_name"),
        "pay_type",
        "currency",
        "order_net_amount",
        "order_gross_amount",
    )
    return sorted_by_ranges(out, "order_id") if sort else out


def sorted_by_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """Sorted layout for a large table: rows ranged by ``keys`` into partitions, each sorted (files in order, no
    further merge step)."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def enriched_headers(
    headers: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Order-grain lookups done once per order: customer key existence, calendar key, period."""
    h = headers.select(
        F.col("order_id").alias("h_order_id"),
        F.col("customer_id").alias("h_customer_id"),
        F.col("order_date").alias("h_order_date"),
        F.col("channel").alias("h_channel"),
        F.col("pay_type").alias("h_pay_type"),
        F.col("currency").alias("h_currency"),
        F.col("order_net_amount").alias("h_order_net_amount"),
    )
    cus = broadcast_if_within(
        dim_customer.select(F.col("customer_id").alias("cus_customer_id")), max_broadcast_rows, dim_customer
    )
    cal = bounded_calendar(
        dim_date.select(F.col("date").alias("dat_date"), F.col("date_id").alias("dat_date_id")), sized_by=dim_date
    )
    return (
        h.join(cus, h["h_customer_id"] == cus["cus_customer_id"], "left")
        .join(cal, F.col("h_order_date") == F.col("dat_date"), "left")
        .withColumn("h_period", period_key("h_order_date"))
        .drop("dat_date")
    )


def join_line_header(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """``lines LEFT JOIN headers ON order_id`` — every line survives, orphans get NULL header columns."""
    return lines.join(headers, lines["order_id"] == headers["h_order_id"], "left")


def heavy_orders(lines: DataFrame, heavy_rows: int) -> DataFrame:
    """``heavy_id`` of the orders with more than ``heavy_rows`` lines: one aggregate over the order ids, combined on the map side."""
    counts = lines.where("order_id IS NOT NULL").groupBy(F.col("order_id").alias("heavy_id")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > heavy_rows).select("heavy_id")


def join_line_header_split(lines: DataFrame, headers: DataFrame, heavy_rows: int, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``join_line_header`` for lines with hot orders: those above ``heavy_rows`` lines meet their headers in a broadcast, the rest in
    the shuffle join.

    The heavy orders and their headers are written to the scratch folder (the detection reads the order ids only, the
    header lookup prunes to the heavy ids before the dedupe). Where they are within the rows and bytes that may be
    broadcast, a heavy line goes through the shuffle under a salt of its own and matches nothing there, so it is dealt evenly and
    not read twice. Beyond the bound, or without heavy orders, the plan is the plain join."""
    spark = lines.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    heavy = written(heavy_orders(lines, heavy_rows), "heavy-orders")
    side = broadcast_if_within(heavy, max_broadcast_rows)
    if side is heavy or not row_count(heavy):
        return join_line_header(lines, headers)
    found = written(headers.join(side, headers["h_order_id"] == F.col("heavy_id"), "left_semi"), "heavy-headers")
    if broadcast_if_within(found, max_broadcast_rows) is found:
        return join_line_header(lines, headers)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = lines.join(side, lines["order_id"] == F.col("heavy_id"), "left")
    salt = F.when(F.col("heavy_id").isNotNull(), F.pmod(F.xxhash64("line_id"), F.lit(parts)) + 1).otherwise(F.lit(0).cast("long"))
    # 0 for every header; a literal would be taken out of the join's keys
    rest = headers.withColumn("__none", F.pmod(F.col("h_order_id").cast("long"), F.lit(1)))
    tagged = tagged.withColumn("__salt", salt)
    joined = tagged.join(rest, (tagged["order_id"] == rest["h_order_id"]) & (tagged["__salt"] == rest["__none"]), "left")
    hot = found.select(*(F.col(c).alias(f"__hot_{c}") for c in headers.columns))
    joined = joined.join(F.broadcast(hot), joined["heavy_id"] == F.col("__hot_h_order_id"), "left")
    return joined.select(*lines.columns, *(F.coalesce(F.col(c), F.col(f"__hot_{c}")).alias(c) for c in headers.columns))


def positive_line_filter(joined: DataFrame) -> DataFrame:
    """Keep a line when its header amount > 0 OR its units > 0 (three-valued: an orphan line survives
    only by its units)."""
    return joined.filter((F.col("h_order_net_amount") > 0) | (F.col("qty_units") > 0))


#: Declared schema of the line fact (ids are ``bigint`` when it is built with that ``id_type``).
FACT_ORDER_LINE_SCHEMA = {
    "order_line_key": "string", "order_id": "int", "line_id": "int", "product_id": "int", "customer_id": "int",
    "order_date_id": "int", "period": "int", "channel": "string", "pay_type": "string", "currency": "string",
    "promo_flag": "int", "qty_units": "int", "unit_price": "decimal(18,2)", "line_net_amount": "decimal(18,2)",
    "order_net_amount_replicated": "decimal(18,2)",
}
FACT_ORDER_LINE_COLUMNS = tuple(FACT_ORDER_LINE_SCHEMA)


def fact_order_line(
    bronze_header: DataFrame,
    bronze_detail: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    map_unmatched_to_unknown: bool = False,
    header_tie_breakers: Sequence[str | Column] | None = None,
    line_tie_breakers: Sequence[str | Column] | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    id_type: str = "int",
    headers: DataFrame | None = None,
    heavy_rows: int | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Order-line fact with hashed key, dimension keys and ``period`` (yyyyMM of the header date).

    ``headers``: already deduplicated headers, best read from a written table (``bronze_header`` is then not
    read). Each side of the line join is then a sort directly over an exchange, which lets AQE split a hot order.
    ``heavy_rows``: orders with more lines than this are joined by broadcast (``join_line_header_split``), in either form.
    ``lines``: already deduplicated lines (``bronze_detail`` is then not read)."""
    if headers is None:
        headers = latest_order_headers(bronze_header, header_tie_breakers, id_type)
    headers = enriched_headers(headers, dim_customer, dim_date, max_broadcast_rows)
    if lines is None:
        lines = latest_order_lines(bronze_detail, line_tie_breakers, id_type)
    joined = join_line_header(lines, headers) if heavy_rows is None else join_line_header_split(lines, headers, heavy_rows, max_broadcast_rows)
    kept = positive_line_filter(joined)
    pro = broadcast_if_within(dim_product.select(F.col("product_id").alias("pro_product_id")), max_broadcast_rows, dim_product)
    j = kept.join(pro, kept["product_id"] == pro["pro_product_id"], "left")

    order_id = first_non_null("h_order_id", "order_id", default=0)
    line_id = key_or_default("line_id")
    product_key, customer_key = F.col("pro_product_id"), F.col("cus_customer_id")
    if map_unmatched_to_unknown:
        product_key = F.coalesce(product_key, F.lit(UNKNOWN_KEY))
        customer_key = F.coalesce(customer_key, F.lit(UNKNOWN_KEY))
    return j.select(
        hash_key([order_id, line_id]).alias("order_line_key"),
        order_id.alias("order_id"),
        line_id.alias("line_id"),
        product_key.alias("product_id"),
        customer_key.alias("customer_id"),
        F.col("dat_date_id").alias("order_date_id"),
        F.col("h_period").alias("period"),
        F.col("h_channel").alias("channel"),
        F.col("h_pay_type").alias("pay_type"),
        F.col("h_currency").alias("currency"),
        "promo_flag",
        "qty_units",
        "unit_price",
        "line_net_amount",
        "order_net_amount_replicated",
    )
