"""Adapter from the driver's TPC-H-like tables to the four raw inputs the pipeline expects.

The raw inputs are customers, products, order headers and order lines. Ids get ``+1`` because the
fixture keys start at 0, which is the unknown member's key. The SQL twin of every function here lives
in ``orderstar.plans.oracle`` and must produce the same values.

Variants add the cases the clean fixtures lack, by projection only (no row is dropped):

* ``dup``   — the table is unioned with an altered, older copy of itself (duplicate keys; some copy
  rows get a NULL key);
* ``dirty_dup`` — both, for order headers;
* ``dirty`` — order headers with NULL customer, NULL date, non-positive amount, or an id that no line
  references (its lines become orphans); order lines with zero units or an unknown product;
* ``hot`` — a third of all order lines moved to one order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from orderstar.sources.files import path_state

MONEY = DecimalType(18, 2)

# Fixed values for the fixture parameters (see FIXTURES.md).
FIXTURE_CHANNEL = "BUILDING"
FIXTURE_CREDIT_TYPE = "1-URGENT"
FIXTURE_AS_OF = "2001-08-01"
FIXTURE_CALENDAR = ("1995-01-01", "2001-12-31")
FIXTURE_NOW = "2001-08-01 12:00:00"


#: The driver's tables that the raw inputs are made from.
TABLES = ("customer", "nation", "region", "part", "orders", "lineitem")

# One DataFrame per (session, file and its state) is reused: the file listing and footer read behind
# ``spark.read.parquet`` happen once per session instead of once per query.
# (Kept on the session object itself, so they go with it.)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per_session = spark.__dict__.setdefault("_orderstar_tables", {})
    state = path_state(spark, path)
    if path not in per_session or per_session[path][0] != state:
        per_session[path] = (state, spark.read.parquet(path))
    return per_session[path][1]


def _id(col: str) -> Column:
    return (F.col(col) + 1).cast("int")


def raw_customers(spark: SparkSession, sf_dir: str, variant: str = "clean") -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation (25 rows) and region (5 rows) are fixed-size reference tables: safe to broadcast.
    geo = n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"], "left").select("n_nationkey", "n_name", "r_name")
    j = c.join(F.broadcast(geo), c["c_nationkey"] == geo["n_nationkey"], "left")

    def project(copy: bool) -> DataFrame:
        base = "1989-01-01" if copy else "1990-01-01"
        cid = _id("c_custkey")
        if copy:
            cid = F.when(F.col("c_nationkey") == 0, F.lit(None).cast("int")).otherwise(cid)
        return j.select(
            cid.alias("customer_id"),
            (F.concat(F.col("c_name"), F.lit(" (old)")) if copy else F.col("c_name")).alias("customer_name"),
            F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("canal"),
            F.substring("c_mktsegment", 1, 1).alias("segmento_actual"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("comuna"),
            F.concat(
                F.date_add(F.lit(base).cast("date"), (F.col("c_custkey") % 3650).cast("int")).cast("string"),
                F.lit(" 08:30:00"),
            ).alias("fecha_alta"),
            F.when(F.col("c_custkey") % 3 == 0, "inactivo").otherwise("activo").alias("estado"),
            ((F.col("c_custkey") % 100).cast("double") / 100).alias("mix_credito_vs_contado_3m"),
        )

    out = project(False)
    return out.unionByName(project(True)) if variant == "dup" else out


def raw_products(spark: SparkSession, sf_dir: str, variant: str = "clean") -> DataFrame:
    p = table(spark, sf_dir, "part")

    def project(copy: bool) -> DataFrame:
        pid = _id("p_partkey")
        if copy:
            pid = F.when(F.col("p_size") == 1, F.lit(None).cast("int")).otherwise(pid)
        return p.select(
            pid.alias("product_id"),
            F.col("p_type").alias("product_category"),
            F.col("p_name").alias("sub_category"),
            (F.concat(F.col("p_brand"), F.lit("-b")) if copy else F.col("p_brand")).alias("brand"),
        )

    out = project(False)
    return out.unionByName(project(True)) if variant == "dup" else out


def raw_order_header(spark: SparkSession, sf_dir: str, variant: str = "clean") -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    amount = F.col("o_totalprice").cast(MONEY)
    order_id, customer_id = _id("o_orderkey"), _id("o_custkey")
    order_date = F.col("o_orderdate").cast("date")
    if variant in ("dirty", "dirty_dup"):
        order_id = F.when((status == "P") & (prio == "1-URGENT"), -order_id).otherwise(order_id)
        customer_id = F.when((status == "O") & (prio == "2-HIGH"), F.lit(None).cast("int")).otherwise(customer_id)
        order_date = F.when((status == "F") & (prio == "4-NOT SPECIFIED"), F.lit(None).cast("date")).otherwise(order_date)
        amount = F.when((status == "F") & (prio == "5-LOW"), -amount).otherwise(amount)

    def project(copy: bool) -> DataFrame:
        return o.select(
            order_id.alias("order_id"),
            customer_id.alias("customer_id"),
            (F.date_sub(order_date, 30) if copy else order_date).alias("order_date"),
            status.alias("canal"),
            prio.alias("tipo_pago"),
            F.when(prio == "1-URGENT", 1).otherwise(0).alias("flag_promo_pedido"),
            (amount + F.lit(1) if copy else amount).cast(MONEY).alias("order_net_amount"),
            amount.alias("order_gross_amount"),
            F.lit("CLP").alias("currency"),
        )

    out = project(False)
    return out.unionByName(project(True)) if variant in ("dup", "dirty_dup") else out


def raw_order_detail(spark: SparkSession, sf_dir: str, variant: str = "clean", amounts: bool = True) -> DataFrame:
    """The order lines. ``amounts=False``: ``unit_price`` and ``order_net_amount_replicated``, which come from two other
    tables, are NULL, for readers that want neither. They are functions of the product and the order, so which other values
    the first row of an ``(order_id, line_id)`` has does not depend on them."""
    li = table(spark, sf_dir, "lineitem")
    if amounts:
        p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
        o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
        j = li.join(p, li["l_partkey"] == p["p_partkey"], "left").join(o, li["l_orderkey"] == o["o_orderkey"], "left")
    else:
        none = F.lit(None).cast("double")
        j = li.withColumn("p_retailprice", none).withColumn("o_totalprice", none)
    qty = F.col("l_quantity").cast("int")
    product_id = _id("l_partkey")
    if variant == "dirty":
        qty = F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(qty)
        product_id = F.when(
            (F.col("l_linestatus") == "O") & (F.col("l_discount") == 0.1), -product_id
        ).otherwise(product_id)
    order_id, line_id = _id("l_orderkey"), F.col("l_linenumber")
    if variant == "hot":  # a third of all lines belong to one order
        order_id = F.when(F.col("l_partkey") % 3 == 0, F.lit(1)).otherwise(order_id)
        line_id = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("int")
    return j.select(
        order_id.alias("order_id"),
        line_id.alias("line_id"),
        product_id.alias("product_id"),
        qty.alias("qty_units"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        F.col("l_discount").cast(MONEY).alias("discount_amount"),
        F.when(F.col("l_discount") >= 0.08, 1).otherwise(0).alias("promo_flag"),
        F.col("l_extendedprice").cast(MONEY).alias("line_net_amount"),
        F.col("o_totalprice").cast(MONEY).alias("order_net_amount_replicated"),
    )


# ---------------------------------------------------------------- staged raw files (landing zone)

# Layout of a staged fixture landing zone: Spark names its output files ``part-*.csv``, so each family
# gets its own folder and is read recursively with ``*.csv``.
FIXTURE_LAYOUT = {
    "customer": ("customers.csv", None),
    "product": ("products.csv", None),
    "orders_header": ("orders_header", "*.csv"),
    "orders_detail": ("orders_detail", "*.csv"),
}


def stage_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
              compression: str | None = None) -> str:
    """Write ``df`` as header CSV files (one per task; nothing passes through the driver)."""
    w = df.write.mode(mode).option("header", True)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def stage_landing_zone(spark: SparkSession, sf_dir: str, root: str, customers: str = "clean",
                       products: str = "clean", header: str = "dirty", detail: str = "dirty") -> str:
    """Raw CSV files for the four sources under ``root`` (headers nested one folder deep by year)."""
    stage_csv(raw_customers(spark, sf_dir, customers), f"{root}/customers.csv")
    stage_csv(raw_products(spark, sf_dir, products), f"{root}/products.csv")
    h = raw_order_header(spark, sf_dir, header)
    stage_csv(h.withColumn("y", F.coalesce(F.year("order_date"), F.lit(0))), f"{root}/orders_header", ["y"])
    stage_csv(raw_order_detail(spark, sf_dir, detail), f"{root}/orders_detail")
    return root
