"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL).

Every query reads the driver's tables through the fixture adapter and runs over whole tables. Output
columns are aliased identically on both sides; decimal ratios and doubles are compared rounded
(``ROUND(CAST(x AS DOUBLE), 6)``), timestamps as strings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstar.functions.calendar import as_date_literal, as_timestamp_literal
from orderstar.functions.keys import date_key, hash_key, key_or_default, period_key
from orderstar.operators import features as feat
from orderstar.operators.dedupe import keep_first, latest_per_key
from orderstar.operators.dimensions import (
    PRODUCT_UNKNOWN,
    calendar_range_from,
    dim_customer,
    dim_date,
    dim_product,
    union_unknown_member,
)
from orderstar.operators.facts import (
    FACT_ORDER_LINE_SCHEMA,
    enriched_headers,
    fact_order,
    join_line_header,
    latest_order_headers,
    latest_order_lines,
    positive_line_filter,
)
from orderstar.operators.standardize import (
    ORDER_LINE_SPEC,
    rejected_rows,
    standardize_customer,
    standardize_order_header,
    standardize_order_line,
    standardize_product,
)
from orderstar.plans import oracle as O
from orderstar.plans.fixture_build import GOLD_FACT_COLUMNS, fixture_gold_inputs, fixture_params, fixture_silver
from orderstar.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r6(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), 6)


def ts_str(col: str) -> Column:
    return F.col(col).cast("string").alias(col)


def _sql_r6(expr: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6)"


# ------------------------------------------------------------------ standardisation


@register("standardize_customer", O.with_ctes(
    [("raw_customers", O.raw_customers()), ("std_customer", O.STD_CUSTOMER)],
    "SELECT * REPLACE (CAST(entry_date AS VARCHAR) AS entry_date) FROM std_customer"))
def q_standardize_customer(spark, d):
    return standardize_customer(fx.raw_customers(spark, d)).withColumn("entry_date", F.col("entry_date").cast("string"))


@register("standardize_product", O.with_ctes(
    [("raw_products", O.raw_products()), ("std_product", O.STD_PRODUCT)], "SELECT * FROM std_product"))
def q_standardize_product(spark, d):
    return standardize_product(fx.raw_products(spark, d))


@register("standardize_order_header", O.with_ctes(
    [("raw_order_header", O.raw_order_header("dirty")), ("std_header", O.STD_HEADER)], "SELECT * FROM std_header"))
def q_standardize_order_header(spark, d):
    return standardize_order_header(fx.raw_order_header(spark, d, "dirty"))


@register("standardize_order_line", O.with_ctes(
    [("raw_order_detail", O.raw_order_detail("dirty")), ("std_line", O.STD_LINE)], "SELECT * FROM std_line"))
def q_standardize_order_line(spark, d):
    return standardize_order_line(fx.raw_order_detail(spark, d, "dirty"))


# ------------------------------------------------------------------ dedupe


@register("dedupe_customer", O.with_ctes(
    [("raw_customers", O.raw_customers("dup")), ("std_customer", O.STD_CUSTOMER), ("latest_customer", O.LATEST_CUSTOMER)],
    "SELECT * REPLACE (CAST(entry_date AS VARCHAR) AS entry_date) FROM latest_customer"))
def q_dedupe_customer(spark, d):
    std = standardize_customer(fx.raw_customers(spark, d, "dup"))
    return latest_per_key(std, ["customer_id"], "entry_date").withColumn("entry_date", F.col("entry_date").cast("string"))


@register("dedupe_product", O.with_ctes(
    [("raw_products", O.raw_products("dup")), ("std_product", O.STD_PRODUCT), ("latest_product", O.LATEST_PRODUCT)],
    "SELECT * FROM latest_product"))
def q_dedupe_product(spark, d):
    return keep_first(standardize_product(fx.raw_products(spark, d, "dup")), ["product_id"])


@register("dedupe_order_header", O.with_ctes(
    [("raw_order_header", O.raw_order_header("dup")), ("std_header", O.STD_HEADER), ("latest_header", O.LATEST_HEADER)],
    "SELECT * FROM latest_header"))
def q_dedupe_order_header(spark, d):
    return latest_order_headers(fx.raw_order_header(spark, d, "dup"))


@register("dedupe_order_line", O.with_ctes(
    [("raw_order_detail", O.raw_order_detail()), ("std_line", O.STD_LINE), ("latest_line", O.LATEST_LINE)],
    "SELECT * FROM latest_line"))
def q_dedupe_order_line(spark, d):
    return latest_order_lines(fx.raw_order_detail(spark, d))


# ------------------------------------------------------------------ keys

_HDR = [("raw_order_header", O.raw_order_header("dirty")), ("std_header", O.STD_HEADER)]
_LIN = [("raw_order_detail", O.raw_order_detail("dirty")), ("std_line", O.STD_LINE)]


@register("null_key_default", O.with_ctes(_HDR,
    "SELECT order_id, COALESCE(order_id, 0) AS order_key, COALESCE(customer_id, 0) AS customer_key FROM std_header"))
def q_null_key_default(spark, d):
    h = standardize_order_header(fx.raw_order_header(spark, d, "dirty"))
    return h.select("order_id", key_or_default("order_id").alias("order_key"), key_or_default("customer_id").alias("customer_key"))


@register("hash_key_order", O.with_ctes(_HDR,
    "SELECT order_id, md5(concat_ws('||', order_id, customer_id, order_date, channel, pay_type, currency)) AS order_key FROM std_header"))
def q_hash_key_order(spark, d):
    h = standardize_order_header(fx.raw_order_header(spark, d, "dirty"))
    return h.select("order_id", hash_key(["order_id", "customer_id", "order_date", "channel", "pay_type", "currency"]).alias("order_key"))


@register("hash_key_order_line", O.with_ctes(_LIN,
    "SELECT order_id, line_id, md5(concat_ws('||', COALESCE(order_id, 0), COALESCE(line_id, 0))) AS order_line_key FROM std_line"))
def q_hash_key_order_line(spark, d):
    li = standardize_order_line(fx.raw_order_detail(spark, d, "dirty"))
    return li.select("order_id", "line_id", hash_key([key_or_default("order_id"), key_or_default("line_id")]).alias("order_line_key"))


@register("union_dummy_member", O.with_ctes(
    [("raw_products", O.raw_products()), ("std_product", O.STD_PRODUCT)],
    "SELECT * FROM std_product UNION ALL SELECT 0, 'Sin Categoria', 'Sin Subcategoria', 'Sin Marca'"))
def q_union_dummy_member(spark, d):
    return union_unknown_member(standardize_product(fx.raw_products(spark, d)), PRODUCT_UNKNOWN)


@register("date_int_keys", O.with_ctes(_HDR,
    "SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, "
    "CAST(strftime(order_date, '%Y%m') AS INTEGER) AS period FROM std_header"))
def q_date_int_keys(spark, d):
    h = standardize_order_header(fx.raw_order_header(spark, d, "dirty"))
    return h.select("order_id", date_key("order_date").alias("date_key"), period_key("order_date").alias("period"))


# ------------------------------------------------------------------ scalar functions


@register("scalar_string", """
    SELECT c_custkey, TRIM('  ' || c_name || ' ') AS trimmed, concat_ws('||', c_custkey, NULL, c_mktsegment) AS joined,
           CAST(c_nationkey AS VARCHAR) || '-' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS padded,
           md5(c_name) AS name_md5, substr(c_mktsegment, 1, 3) AS segment_prefix
    FROM customer""")
def q_scalar_string(spark, d):
    c = fx.table(spark, d, "customer")
    return c.select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed"),
        F.concat_ws("||", F.col("c_custkey").cast("string"), F.lit(None).cast("string"), F.col("c_mktsegment")).alias("joined"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("padded"),
        F.md5("c_name").alias("name_md5"),
        F.substring("c_mktsegment", 1, 3).alias("segment_prefix"),
    )


@register("scalar_conditional", """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_priority,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS finished_amount,
           COALESCE(CASE WHEN o_orderstatus = 'O' THEN o_custkey END, o_orderkey, 0) AS first_key,
           CASE WHEN o_totalprice > 100000 OR o_orderstatus = 'P' THEN 1 ELSE 0 END AS big_or_pending
    FROM orders""")
def q_scalar_conditional(spark, d):
    o = fx.table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("is_priority"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("finished_amount"),
        F.coalesce(F.when(F.col("o_orderstatus") == "O", F.col("o_custkey")), F.col("o_orderkey"), F.lit(0)).alias("first_key"),
        F.when((F.col("o_totalprice") > 100000) | (F.col("o_orderstatus") == "P"), 1).otherwise(0).alias("big_or_pending"),
    )


@register("scalar_numeric", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS qty,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS net, l_extendedprice / l_quantity AS unit_value,
           CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice / l_discount END AS per_discount,
           CAST(l_linenumber AS BIGINT) * 1000 + CAST(l_quantity AS BIGINT) AS mixed_key
    FROM lineitem""")
def q_scalar_numeric(spark, d):
    li = fx.table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("net"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_value"),
        F.try_divide("l_extendedprice", "l_discount").alias("per_discount"),
        (F.col("l_linenumber").cast("long") * 1000 + F.col("l_quantity").cast("long")).alias("mixed_key"),
    )


@register("scalar_date", f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, strftime(o_orderdate, '%Y%m') AS period,
           year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS dd, quarter(o_orderdate) AS q,
           weekofyear(o_orderdate) AS week_of_year, dayofweek(o_orderdate) + 1 AS day_of_week,
           dayofyear(o_orderdate) AS day_of_year, strftime(o_orderdate, '%A') AS day_name,
           strftime(o_orderdate, '%a') AS day_short, last_day(CAST(o_orderdate AS DATE)) AS month_end,
           CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH AS DATE) AS two_months_back,
           datediff('day', CAST(o_orderdate AS DATE), last_day(DATE '{fx.FIXTURE_AS_OF}')) AS days_to_as_of_month_end
    FROM orders""")
def q_scalar_date(spark, d):
    o = fx.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("dt"))
    dt_ = F.col("dt")
    return o.select(
        "o_orderkey", dt_.alias("order_date"), date_key(dt_).alias("date_key"), F.date_format(dt_, "yyyyMM").alias("period"),
        F.year(dt_).alias("y"), F.month(dt_).alias("m"), F.dayofmonth(dt_).alias("dd"), F.quarter(dt_).alias("q"),
        F.weekofyear(dt_).alias("week_of_year"), F.dayofweek(dt_).alias("day_of_week"), F.dayofyear(dt_).alias("day_of_year"),
        F.date_format(dt_, "EEEE").alias("day_name"), F.date_format(dt_, "E").alias("day_short"),
        F.last_day(dt_).alias("month_end"), F.add_months(dt_, -2).alias("two_months_back"),
        F.datediff(F.last_day(as_date_literal(fx.FIXTURE_AS_OF)), dt_).alias("days_to_as_of_month_end"),
    )


# ------------------------------------------------------------------ dimensions


@register("dim_customer", O.with_ctes(
    [("raw_customers", O.raw_customers("dup")), ("std_customer", O.STD_CUSTOMER),
     ("latest_customer", O.LATEST_CUSTOMER), ("dim_customer", O.DIM_CUSTOMER)],
    "SELECT * REPLACE (CAST(entry_date AS VARCHAR) AS entry_date) FROM dim_customer"))
def q_dim_customer(spark, d):
    return dim_customer(fx.raw_customers(spark, d, "dup")).withColumn("entry_date", F.col("entry_date").cast("string"))


@register("dim_product", O.with_ctes(
    [("raw_products", O.raw_products("dup")), ("std_product", O.STD_PRODUCT),
     ("latest_product", O.LATEST_PRODUCT), ("dim_product", O.DIM_PRODUCT)],
    "SELECT * FROM dim_product"))
def q_dim_product(spark, d):
    return dim_product(fx.raw_products(spark, d, "dup"))


@register("dim_date", O.dim_date_sql("", "", fx.FIXTURE_AS_OF, range_from_orders=True))
def q_dim_date(spark, d):
    """Calendar covering the whole years of the order dates (range derived from the data)."""
    start, end = calendar_range_from(fx.table(spark, d, "orders"), "o_orderdate")
    return dim_date(spark, start, end, as_of=fx.FIXTURE_AS_OF)


# ------------------------------------------------------------------ facts

_FACT_BASE = dict(customers="clean", products="clean", header="dirty", detail="dirty")


def _joined(spark, d) -> DataFrame:
    s = fixture_silver(spark, d)
    headers = enriched_headers(latest_order_headers(s.raw_header), s.dim_customer, s.dim_date)
    return join_line_header(latest_order_lines(s.raw_detail), headers)


_JOIN_COLS = ["order_id", "line_id", "qty_units", "line_net_amount", "h_order_id", "h_customer_id",
              "h_order_date", "h_order_net_amount"]


@register("join_line_header", O.over_pipeline(f"SELECT {', '.join(_JOIN_COLS)} FROM head_join_line", "head_join_line", **_FACT_BASE))
def q_join_line_header(spark, d):
    return _joined(spark, d).select(*_JOIN_COLS)


@register("positive_line_filter", O.over_pipeline(
    f"SELECT {', '.join(_JOIN_COLS)} FROM head_join_line WHERE (h_order_net_amount > 0 OR qty_units > 0)",
    "head_join_line", **_FACT_BASE))
def q_positive_line_filter(spark, d):
    return positive_line_filter(_joined(spark, d)).select(*_JOIN_COLS)


@register("fact_order", O.over_pipeline("SELECT * FROM (" + O.FACT_ORDER + ")", "dim_customer", **_FACT_BASE))
def q_fact_order(spark, d):
    s = fixture_silver(spark, d)
    return fact_order(s.raw_header, s.dim_customer)


@register("fact_order_line", O.over_pipeline("SELECT * FROM fact_order_line", "fact_order_line", **_FACT_BASE))
def q_fact_order_line(spark, d):
    return fixture_silver(spark, d).fact_order_line


# ------------------------------------------------------------------ gold features


def _features(spark, d) -> DataFrame:
    s = fixture_gold_inputs(spark, d)
    return feat.customer_features(s.fact_order_line, s.dim_customer, s.dim_product, s.dim_date, fixture_params())


def _sales(spark, d) -> DataFrame:
    s = fixture_gold_inputs(spark, d)
    return feat.customer_sales(s.fact_order_line, s.dim_customer, s.dim_product, s.dim_date, fixture_params())


@register("channel_window_filter", O.over_pipeline(
    "SELECT order_line_key, customer_id, order_id, period, line_net_amount FROM window_lines", "window_lines"))
def q_channel_window_filter(spark, d):
    s = fixture_gold_inputs(spark, d)
    lines = feat.channel_window_filter(s.fact_order_line, s.dim_customer, fixture_params())
    return lines.select("order_line_key", "customer_id", "order_id", "period", "line_net_amount")


_SALES_COLS = ["customer_id", "last_order_date", "month_end_date", "frecuencia_pedidos_3m", "ventas_total_3m",
               "variedad_categorias_3m", "promo_orders", "credit_sales"]


@register("customer_sales_3m", O.over_pipeline(f"SELECT {', '.join(_SALES_COLS)} FROM customer_sales", "customer_sales"))
def q_customer_sales_3m(spark, d):
    return _sales(spark, d).select(*_SALES_COLS)


@register("group_by_all", O.over_pipeline(
    "SELECT customer_id, month_end_date, frecuencia_pedidos_3m, ventas_total_3m FROM customer_sales", "customer_sales"))
def q_group_by_all(spark, d):
    return _sales(spark, d).select("customer_id", "month_end_date", "frecuencia_pedidos_3m", "ventas_total_3m")


@register("distinct_orders", O.over_pipeline("SELECT * FROM distinct_orders", "distinct_orders"))
def q_distinct_orders(spark, d):
    s = fixture_gold_inputs(spark, d)
    return feat.distinct_orders(s.fact_order_line, s.dim_customer, s.dim_date, fixture_params())


@register("order_lag", O.over_pipeline("SELECT * FROM order_lag", "order_lag"))
def q_order_lag(spark, d):
    s = fixture_gold_inputs(spark, d)
    return feat.order_lag(s.fact_order_line, s.dim_customer, s.dim_date, fixture_params())


_METRICS = {
    "recency_days": ("recencia_dias", False),
    "order_frequency": ("frecuencia_pedidos_3m", False),
    "monetary_total": ("ventas_total_3m", False),
    "average_ticket": ("ticket_promedio_3m", True),
    "avg_days_between_orders": ("dias_promedio_entre_pedidos", True),
    "category_variety": ("variedad_categorias_3m", False),
    "promo_order_share": ("porcentaje_pedidos_promo_3m", True),
    "credit_mix": ("mix_credito_vs_contado_3m", True),
}


def _metric_query(col: str, rounded: bool) -> Query:
    def q(spark, d):
        f = _features(spark, d)
        return f.select("customer_id", (r6(col) if rounded else F.col(col)).alias(col))

    return q


for _key, (_col, _rounded) in _METRICS.items():
    _expr = _sql_r6(_col) if _rounded else _col
    register(_key, O.over_pipeline(f"SELECT customer_id, {_expr} AS {_col} FROM features", "features"))(
        _metric_query(_col, _rounded)
    )

_FEATURE_SQL_COLS = ", ".join(
    (f"{_sql_r6(c)} AS {c}" if c in {"ticket_promedio_3m", "dias_promedio_entre_pedidos", "porcentaje_pedidos_promo_3m",
                                     "mix_credito_vs_contado_3m"} else c)
    for c in feat.FEATURE_COLUMNS
)


def comparable_features(f: DataFrame) -> DataFrame:
    rounded = {"ticket_promedio_3m", "dias_promedio_entre_pedidos", "porcentaje_pedidos_promo_3m", "mix_credito_vs_contado_3m"}
    return f.select(*[(r6(c).alias(c) if c in rounded else F.col(c)) for c in feat.FEATURE_COLUMNS])


@register("customer_features", O.over_pipeline(f"SELECT {_FEATURE_SQL_COLS} FROM features", "features"))
def q_customer_features(spark, d):
    return comparable_features(_features(spark, d))


# ------------------------------------------------------------------ upsert
# target = customers with balance below 5000 (tracked as created 2001-01-01, updated 2001-02-01);
# source = customers with balance from 2500 on, segment and balance changed; both overlap on [2500, 5000).

from orderstar.operators import merge as M  # noqa: E402
from orderstar.operators.quality import (  # noqa: E402
    cast_failure_report,
    dimension_reconcile,
    profile,
    row_counts,
    schema_report,
    write_and_reconcile,
)
from orderstar.session import scratch_path  # noqa: E402

_T_CREATED, _T_UPDATED = "2001-01-01 00:00:00", "2001-02-01 00:00:00"
_UPSERT_KEYS = ["customer_id"]
_UPSERT_COLS = ["customer_id", "customer_name", "segment", "balance"]


def _upsert_target(spark, d, tracked: bool = True) -> DataFrame:
    c = fx.table(spark, d, "customer").filter(F.col("c_acctbal") < 5000)
    t = c.select((F.col("c_custkey") + 1).cast("int").alias("customer_id"), F.col("c_name").alias("customer_name"),
                 F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    if tracked:
        t = t.withColumn("created_ts", F.lit(_T_CREATED).cast("timestamp")).withColumn(
            "update_ts", F.lit(_T_UPDATED).cast("timestamp"))
    return t


def _upsert_source(spark, d) -> DataFrame:
    return _upsert_rows(spark, d).filter(F.col("balance") >= 2600)


def _upsert_rows(spark, d) -> DataFrame:
    c = fx.table(spark, d, "customer")
    return c.select((F.col("c_custkey") + 1).cast("int").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    F.lower("c_mktsegment").alias("segment"),
                    (F.col("c_acctbal").cast("decimal(18,2)") + 100).cast("decimal(18,2)").alias("balance"))


def _tracked_out(df: DataFrame) -> DataFrame:
    return df.select(*_UPSERT_COLS, ts_str("created_ts"), ts_str("update_ts"))


_SQL_T = f"""SELECT CAST(c_custkey + 1 AS INTEGER) AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
    CAST(c_acctbal AS DECIMAL(18,2)) AS balance, TIMESTAMP '{_T_CREATED}' AS created_ts, TIMESTAMP '{_T_UPDATED}' AS update_ts
    FROM customer WHERE c_acctbal < 5000"""
_SQL_S = """SELECT CAST(c_custkey + 1 AS INTEGER) AS customer_id, c_name AS customer_name, lower(c_mktsegment) AS segment,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) + 100 AS DECIMAL(18,2)) AS balance FROM customer WHERE c_acctbal >= 2500"""
_NOW = O.FIXTURE_NOW_SQL


def _merge_sql(legacy: bool) -> str:
    created_old = "CAST(NULL AS TIMESTAMP)" if legacy else "t.created_ts"
    t_created = "CAST(NULL AS VARCHAR)" if legacy else "CAST(t.created_ts AS VARCHAR)"
    t_updated = "CAST(NULL AS VARCHAR)" if legacy else "CAST(t.update_ts AS VARCHAR)"
    return O.with_ctes([("t", _SQL_T), ("s", _SQL_S)], f"""
    SELECT t.customer_id, t.customer_name, t.segment, t.balance, {t_created} AS created_ts, {t_updated} AS update_ts
    FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.customer_id = t.customer_id)
    UNION ALL
    SELECT s.customer_id, s.customer_name, s.segment, s.balance,
           CAST(CASE WHEN t.customer_id IS NOT NULL THEN {created_old} ELSE {_NOW} END AS VARCHAR) AS created_ts,
           CAST({_NOW} AS VARCHAR) AS update_ts
    FROM s LEFT JOIN t ON s.customer_id = t.customer_id""")


@register("upsert_bootstrap", O.with_ctes([("s", _SQL_S.split(" WHERE ")[0])],
    f"SELECT *, CAST({_NOW} AS VARCHAR) AS created_ts, CAST({_NOW} AS VARCHAR) AS update_ts FROM s"))
def q_upsert_bootstrap(spark, d):
    """First load of the whole table, through a target path that does not exist yet."""
    base = scratch_path(spark, "bootstrap")
    return _tracked_out(M.upsert_parquet(spark, _upsert_rows(spark, d), f"{base}/none", f"{base}/v1", _UPSERT_KEYS, now=fx.FIXTURE_NOW))


@register("upsert_legacy_target", _merge_sql(legacy=True))
def q_upsert_legacy_target(spark, d):
    return _tracked_out(M.upsert(_upsert_target(spark, d, tracked=False), _upsert_source(spark, d), _UPSERT_KEYS,
                                 now=fx.FIXTURE_NOW))


@register("upsert_new_keys", O.with_ctes([("t", _SQL_T), ("s", _SQL_S)],
    "SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.customer_id = s.customer_id)"))
def q_upsert_new_keys(spark, d):
    return M.new_rows(_upsert_source(spark, d), _upsert_target(spark, d), _UPSERT_KEYS)


@register("upsert_existing_keys", O.with_ctes([("t", _SQL_T), ("s", _SQL_S)],
    "SELECT * FROM s WHERE EXISTS (SELECT 1 FROM t WHERE t.customer_id = s.customer_id)"))
def q_upsert_existing_keys(spark, d):
    return M.existing_rows(_upsert_source(spark, d), _upsert_target(spark, d), _UPSERT_KEYS)


@register("upsert_untouched", O.with_ctes([("t", _SQL_T), ("s", _SQL_S)],
    "SELECT customer_id, customer_name, segment, balance, CAST(created_ts AS VARCHAR) AS created_ts, "
    "CAST(update_ts AS VARCHAR) AS update_ts FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.customer_id = t.customer_id)"))
def q_upsert_untouched(spark, d):
    return _tracked_out(M.untouched_rows(_upsert_target(spark, d), _upsert_source(spark, d), _UPSERT_KEYS))


@register("upsert_merge", _merge_sql(legacy=False))
def q_upsert_merge(spark, d):
    """Target written as parquet, merged, published to a new version path, read back."""
    base = scratch_path(spark, "upsert")
    _upsert_target(spark, d).write.parquet(f"{base}/v1")
    merged = M.upsert_parquet(spark, _upsert_source(spark, d), f"{base}/v1", f"{base}/v2", _UPSERT_KEYS,
                              now=fx.FIXTURE_NOW)
    return _tracked_out(merged)


@register("upsert_partitioned", _merge_sql(legacy=False))
def q_upsert_partitioned(spark, d):
    """The target partitioned by segment; the batch changes the segment of its keys, so keys move partition."""
    path = f"{scratch_path(spark, 'upsert_partitioned')}/target"
    _upsert_target(spark, d).write.partitionBy("segment").parquet(path)
    M.upsert_partitions(spark, _upsert_source(spark, d), path, _UPSERT_KEYS, ["segment"], now=fx.FIXTURE_NOW)
    return _tracked_out(spark.read.parquet(path))


@register("upsert_merge_shuffled", _merge_sql(legacy=False))
def q_upsert_merge_shuffled(spark, d):
    """The merge beyond the broadcast bound."""
    merged = M.upsert(_upsert_target(spark, d), _upsert_source(spark, d), _UPSERT_KEYS, now=fx.FIXTURE_NOW, max_broadcast_rows=0)
    return _tracked_out(merged)


# ------------------------------------------------------------------ keys that do not parse


def _lines_with_bad_ids(spark, d) -> DataFrame:
    """Order lines whose ids are text: ``A<id>`` on returned lines, beyond INT on line 7."""
    x = fx.raw_order_detail(spark, d, "dirty")
    order = F.col("order_id").cast("string")
    bad = F.when(F.col("qty_units") == 0, F.concat(F.lit("A"), order)).when(F.col("line_id") == 7, F.concat(F.lit("9"), F.lpad(order, 10, "0")))
    return x.withColumn("order_id", bad.otherwise(order))


_BAD_LINES = f"""SELECT * REPLACE (CASE WHEN qty_units = 0 THEN 'A' || CAST(order_id AS VARCHAR)
                                  WHEN line_id = 7 THEN '9' || lpad(CAST(order_id AS VARCHAR), 10, '0')
                                  ELSE CAST(order_id AS VARCHAR) END AS order_id) FROM ({O.raw_order_detail("dirty")})"""


@register("reject_unparsed_lines", O.with_ctes([("bad", _BAD_LINES)],
    "SELECT order_id, line_id, line_net_amount FROM bad WHERE qty_units = 0 OR line_id = 7"))
def q_reject_unparsed_lines(spark, d):
    rejected = rejected_rows(_lines_with_bad_ids(spark, d), ORDER_LINE_SPEC, ["order_id", "line_id"])
    return rejected.select("order_id", "line_id", "line_net_amount")


@register("cast_failure_report", O.with_ctes([("bad", _BAD_LINES)], " UNION ALL ".join(
    f"SELECT '{out}' AS column_name, count(*) FILTER ({raw} IS NOT NULL AND "
    f"TRY_CAST({raw} AS {'INTEGER' if kind == 'int' else 'DECIMAL(18,2)'}) IS NULL) AS failures, "
    f"{out in ('order_id', 'line_id')} AS is_key, {out not in ('order_id', 'line_id')} OR failures = 0 AS ok FROM bad"
    for out, raw, kind in ORDER_LINE_SPEC)))
def q_cast_failure_report(spark, d):
    return cast_failure_report(_lines_with_bad_ids(spark, d), ORDER_LINE_SPEC, ["order_id", "line_id"])


_BIG = 3_000_000_000


@register("dedupe_bigint_ids", O.with_ctes(
    [("raw_order_header", f"SELECT * REPLACE (order_id + {_BIG} AS order_id) FROM ({O.raw_order_header('dup')})"),
     ("std_header", O.STD_HEADER.replace("TRY_CAST(order_id AS INTEGER)", "order_id")), ("latest_header", O.LATEST_HEADER)],
    "SELECT * FROM latest_header"))
def q_dedupe_bigint_ids(spark, d):
    big = fx.raw_order_header(spark, d, "dup").withColumn("order_id", F.col("order_id").cast("bigint") + F.lit(_BIG))
    h = latest_order_headers(big, id_type="bigint")
    return h.withColumn("customer_id", F.col("customer_id").cast("int"))


# ------------------------------------------------------------------ sources and sinks

from orderstar.sources.files import ingest_csv, read_csv_tree, read_parquet  # noqa: E402
from orderstar.sources.writers import write_partitioned  # noqa: E402


@register("parquet_scan", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity >= 45")
def q_parquet_scan(spark, d):
    li = read_parquet(spark, f"{d.rstrip('/')}/lineitem.parquet")
    return li.filter(F.col("l_quantity") >= 45).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@register("sql_over_views", O.with_ctes(_HDR,
    "SELECT channel, pay_type, COUNT(*) AS order_count, SUM(order_net_amount) AS net_amount FROM std_header GROUP BY channel, pay_type"))
def q_sql_over_views(spark, d):
    h = standardize_order_header(fx.raw_order_header(spark, d, "dirty"))
    return spark.sql(
        "SELECT channel, pay_type, COUNT(*) AS order_count, SUM(order_net_amount) AS net_amount "
        "FROM {h} GROUP BY channel, pay_type", h=h)


@register("csv_ingest", O.with_ctes(_HDR, "SELECT * FROM std_header"))
def q_csv_ingest(spark, d):
    path = fx.stage_csv(fx.raw_order_header(spark, d, "dirty"), scratch_path(spark, "raw_orders_header"))
    return standardize_order_header(ingest_csv(spark, path))


@register("csv_ingest_recursive", O.with_ctes(_HDR, "SELECT * FROM std_header"))
def q_csv_ingest_recursive(spark, d):
    """Header files at depth 0, 1 and 2 below the root, plus a non-matching (gzip) file that is skipped."""
    root = scratch_path(spark, "raw_tree")
    h = fx.raw_order_header(spark, d, "dirty")
    y = F.coalesce(F.year("order_date"), F.lit(1995))
    fx.stage_csv(h.filter(y >= 1999), f"{root}/l1/l2", mode="append")
    fx.stage_csv(h.filter((y >= 1997) & (y < 1999)), f"{root}/l1", mode="append")
    fx.stage_csv(h.filter(y < 1997), root, mode="append")
    fx.stage_csv(fx.raw_customers(spark, d), f"{root}/l1", mode="append", compression="gzip")
    return standardize_order_header(read_csv_tree(spark, root, "*.csv"))


@register("bronze_audit_columns", """
    SELECT CAST(o_orderkey + 1 AS INTEGER) AS order_id, TRUE AS has_ingestion_ts,
           CAST(year(o_orderdate) AS VARCHAR) AS source_year FROM orders""")
def q_bronze_audit_columns(spark, d):
    root = scratch_path(spark, "raw_audit")
    h = fx.raw_order_header(spark, d)
    fx.stage_csv(h.withColumn("y", F.year("order_date")), root, ["y"])
    b = ingest_csv(spark, root, "*.csv", now=fx.FIXTURE_NOW)
    return b.select(F.col("order_id").try_cast("int").alias("order_id"),
                    F.col("ingestion_timestamp").isNotNull().alias("has_ingestion_ts"),
                    F.regexp_extract("source_file", r"y=([0-9]+)", 1).alias("source_year"))


@register("partitioned_write", O.over_pipeline("SELECT * FROM fact_order_line", "fact_order_line"))
def q_partitioned_write(spark, d):
    path = scratch_path(spark, "fact_order_line")
    write_partitioned(fixture_silver(spark, d).fact_order_line, path, ["period"])
    from orderstar.operators.facts import FACT_ORDER_LINE_COLUMNS
    return read_parquet(spark, path).select(*FACT_ORDER_LINE_COLUMNS)


@register("partition_pruned_scan", O.over_pipeline(
    f"SELECT order_line_key, order_id, period, line_net_amount FROM fact_order_line WHERE period >= {O.WINDOW_START}",
    "fact_order_line"))
def q_partition_pruned_scan(spark, d):
    path = scratch_path(spark, "fact_order_line")
    write_partitioned(fixture_silver(spark, d).fact_order_line, path, ["period"])
    start = feat.window_start_period(fx.FIXTURE_AS_OF, feat.WINDOW_MONTHS)
    return (read_parquet(spark, path).filter(F.col("period") >= start)
            .select("order_line_key", "order_id", "period", "line_net_amount"))


# ------------------------------------------------------------------ data quality


@register("dq_row_counts", """
    SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer UNION ALL
    SELECT 'orders', COUNT(*) FROM orders UNION ALL
    SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL
    SELECT 'part', COUNT(*) FROM part""")
def q_dq_row_counts(spark, d):
    return row_counts({t: fx.table(spark, d, t) for t in ("customer", "orders", "lineitem", "part")})


@register("dq_dimension_reconcile", O.with_ctes(
    [("raw_customers", O.raw_customers("dup")), ("std_customer", O.STD_CUSTOMER),
     ("latest_customer", O.LATEST_CUSTOMER), ("dim_customer", O.DIM_CUSTOMER),
     ("r", """SELECT (SELECT COUNT(*) FROM raw_customers) AS rows_in,
                     (SELECT COUNT(DISTINCT TRY_CAST(customer_id AS INTEGER)) FROM raw_customers) AS distinct_keys,
                     (SELECT COUNT(*) FROM raw_customers WHERE TRY_CAST(customer_id AS INTEGER) IS NULL) AS null_keys,
                     (SELECT COUNT(*) FROM dim_customer WHERE customer_id = 0) AS unknown_members,
                     (SELECT COUNT(*) FROM dim_customer) AS rows_out""")],
    """SELECT rows_in, distinct_keys, null_keys, rows_in - distinct_keys - null_keys AS duplicates_removed,
              unknown_members, rows_out, rows_out = distinct_keys + 1 AS ok FROM r"""))
def q_dq_dimension_reconcile(spark, d):
    raw = fx.raw_customers(spark, d, "dup")
    return dimension_reconcile(raw, dim_customer(raw), "customer_id", max_null_keys=None)


@register("dq_write_reconcile", O.with_ctes(
    [("raw_customers", O.raw_customers("dup")), ("std_customer", O.STD_CUSTOMER),
     ("latest_customer", O.LATEST_CUSTOMER), ("dim_customer", O.DIM_CUSTOMER)],
    "SELECT COUNT(*) AS rows_written, COUNT(*) AS rows_read, TRUE AS ok FROM dim_customer"))
def q_dq_write_reconcile(spark, d):
    return write_and_reconcile(dim_customer(fx.raw_customers(spark, d, "dup")), scratch_path(spark, "dim_customer"))


def _profile_sql(table: str, columns: dict[str, bool]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS "count",
        {f"ROUND(AVG({c}), 6)" if number else "CAST(NULL AS DOUBLE)"} AS mean,
        {f"ROUND(STDDEV_SAMP({c}), 6)" if number else "CAST(NULL AS DOUBLE)"} AS stddev,
        CAST(MIN({c}) AS VARCHAR) AS "min", CAST(MAX({c}) AS VARCHAR) AS "max" FROM {table}"""
        for c, number in columns.items())


_LINE_COLS = {c: c not in ("l_returnflag", "l_linestatus", "l_shipdate") for c in (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate")}
_NATION_COLS = {"n_nationkey": True, "n_name": False, "n_regionkey": True}


@register("dq_profile", _profile_sql("lineitem", _LINE_COLS) + " UNION ALL " + _profile_sql("nation", _NATION_COLS))
def q_dq_profile(spark, d):
    p = profile(fx.table(spark, d, "lineitem").select(*_LINE_COLS)).unionByName(profile(fx.table(spark, d, "nation").select(*_NATION_COLS)))
    return p.select("column_name", "count", r6("mean").alias("mean"), r6("stddev").alias("stddev"), "min", "max")


_SCHEMA_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS declared, TRUE AS ok, count({c}) AS present FROM fact_order_line"
    for c, t in FACT_ORDER_LINE_SCHEMA.items())


@register("dq_schema_check", O.over_pipeline(_SCHEMA_SQL, "fact_order_line"))
def q_dq_schema_check(spark, d):
    """The line fact's columns against its declared schema, and how many values of each are present."""
    fact = fixture_silver(spark, d).fact_order_line
    counts = profile(fact).select("column_name", F.col("count").alias("present"))
    return schema_report(fact, FACT_ORDER_LINE_SCHEMA).join(F.broadcast(counts), "column_name")


@register("clock_defaults", "SELECT count(*) AS orders, TRUE AS today_once, TRUE AS stamped_now FROM orders")
def q_clock_defaults(spark, d):
    """Without a given clock the calendar and the audit stamp use the session's current date and time."""
    o = fx.table(spark, d, "orders")
    stamped = o.withColumn("at", as_timestamp_literal(None)).agg(
        F.count(F.lit(1)).alias("orders"), (F.max(F.abs(F.unix_timestamp("at") - F.unix_timestamp(F.current_timestamp()))) < 60).alias("stamped_now"))
    days = dim_date(spark, "2020-01-01", "2120-12-31").filter("is_today = 1")
    today = days.agg(((F.count(F.lit(1)) == 1) & (F.min("date") == F.current_date())).alias("today_once"))
    return stamped.join(F.broadcast(today)).select("orders", "today_once", "stamped_now")


# ------------------------------------------------------------------ gold over a long window
# 40 months up to mid 1999, a calendar that ends in 1998 (later orders have no calendar day), duplicates in customers,
# products and headers: many customers have three or more orders, some on one day.

_LONG = {"as_of": "1999-06-15", "months": 40, "calendar_end": "1998-12-31"}
_LONG_VARIANT = {"customers": "dup", "products": "dup", "header": "dirty_dup"}
# none of the queries over it reads the lines' hash key, the widest column
_LONG_COLUMNS = tuple(c for c in GOLD_FACT_COLUMNS if c != "order_line_key")


def _long_inputs(spark, d, **bounds):
    p = replace(fixture_params(), as_of=_LONG["as_of"], months=_LONG["months"], **bounds)
    return fixture_gold_inputs(spark, d, p, _LONG_COLUMNS, calendar=(fx.FIXTURE_CALENDAR[0], _LONG["calendar_end"]), **_LONG_VARIANT), p


def _long_sql(select: str, upto: str) -> str:
    return O.at_window(O.over_pipeline(select, upto, **_LONG_VARIANT), **_LONG)


def _long_features(spark, d, **bounds) -> DataFrame:
    s, p = _long_inputs(spark, d, **bounds)
    return comparable_features(feat.customer_features(s.fact_order_line, s.dim_customer, s.dim_product, s.dim_date, p))


register("customer_features_long", _long_sql(f"SELECT {_FEATURE_SQL_COLS} FROM features", "features"))(_long_features)
register("customer_features_long_shuffled", ORACLE["customer_features_long"])(
    lambda spark, d: _long_features(spark, d, max_broadcast_customers=0))


def _long_query(operator, **bounds):
    def q(spark, d):
        s, p = _long_inputs(spark, d, **bounds)
        return operator(s.fact_order_line, s.dim_customer, s.dim_date, p)

    return q


for _suffix, _bounds in (("", {}), ("_shuffled", {"max_broadcast_customers": 0})):
    register(f"distinct_orders_long{_suffix}", _long_sql("SELECT * FROM distinct_orders", "distinct_orders"))(_long_query(feat.distinct_orders, **_bounds))
    register(f"order_lag_long{_suffix}", _long_sql("SELECT * FROM order_lag", "order_lag"))(_long_query(feat.order_lag, **_bounds))


# ------------------------------------------------------------------ end to end


_DUP = {"customers": "dup", "products": "dup", "header": "dirty_dup"}


@register("medallion_end_to_end", O.over_pipeline(f"SELECT {_FEATURE_SQL_COLS} FROM features", "features", **_DUP))
def q_medallion_end_to_end(spark, d):
    """Raw CSV landing zone -> bronze -> silver -> gold, through files; returns the gold table."""
    from orderstar.plans.medallion import run_medallion

    root = scratch_path(spark, "medallion")
    fx.stage_landing_zone(spark, d, f"{root}/raw", **_DUP)
    res = run_medallion(spark, f"{root}/raw", root, fixture_params(), calendar=fx.FIXTURE_CALENDAR,
                        now=fx.FIXTURE_NOW, layout=fx.FIXTURE_LAYOUT)
    return comparable_features(res.gold)


from orderstar.plans import incremental  # noqa: E402, F401 - registers its queries
