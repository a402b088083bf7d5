"""Registered queries of the incremental operators: monthly state, mergeable distinct counts, batches, hot orders, content checks.

Imported at the end of ``plans.registry``, whose helpers it uses."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstar.operators import features as feat
from orderstar.operators.bitsets import bit_state, count_bits, dense_ids, merge_bits
from orderstar.operators.dedupe import latest_parquet
from orderstar.operators.dimensions import dim_customer, dim_date
from orderstar.operators.facts import FACT_ORDER_LINE_COLUMNS, fact_order, fact_order_line
from orderstar.operators.monthly import features_from_months, refresh_months
from orderstar.operators.merge import prepare_partitions, recover_partitions
from orderstar.operators.quality import file_audit, order_report, write_and_reconcile_content
from orderstar.operators.sizing import broadcast_if_within
from orderstar.operators.standardize import ORDER_HEADER_SPEC, parsed_rows, standardize_order_header
from orderstar.plans import oracle as O
from orderstar.plans.fixture_build import fixture_gold_inputs, fixture_params, fixture_silver
from orderstar.plans.increments import run_increment
from orderstar.plans.medallion import run_medallion
from orderstar.plans.registry import _DUP, _FEATURE_SQL_COLS, _HDR, _UPSERT_KEYS, _merge_sql, _tracked_out, _upsert_source, _upsert_target, comparable_features, register
from orderstar.session import scratch_path
from orderstar.sources import fixtures as fx
from orderstar.sources.files import ingest_csv
from orderstar.sources.ledger import ingest_new, preflight, read_bronze
from orderstar.sources.writers import write_partitioned, write_table

# ------------------------------------------------------------------ features from a monthly state

#: Three runs, a month apart; each sees the months up to its own.
MONTHLY_RUNS = ("2001-06-15", "2001-07-15", "2001-08-01")


def _month(day: str) -> int:
    return int(day[:4]) * 100 + int(day[5:7])


def _monthly_sql() -> str:
    runs = []
    for i, day in enumerate(MONTHLY_RUNS):
        sql = O.at_window(O.over_pipeline(f"SELECT '{day}' AS run, {_FEATURE_SQL_COLS} FROM features", "features"), day, feat.WINDOW_MONTHS, fx.FIXTURE_CALENDAR[1])
        runs.append(f"SELECT * FROM ({sql.replace('WHERE f.period >=', f'WHERE f.period <= {_month(day)} AND f.period >=')}) r{i}")
    return " UNION ALL ".join(runs)


@register("features_from_months", _monthly_sql())
def q_features_from_months(spark, d) -> DataFrame:
    """The fact grows by a month at a time; every run adds the state of the new months and merges its window."""
    last = replace(fixture_params(), as_of=MONTHLY_RUNS[-1], months=feat.WINDOW_MONTHS + len(MONTHLY_RUNS) - 1)
    s = fixture_gold_inputs(spark, d, last)
    root = scratch_path(spark, "months")
    out, have = [], 0
    for day in MONTHLY_RUNS:
        new = s.fact_order_line.where((F.col("period") > have) & (F.col("period") <= _month(day)))
        write_partitioned(new, f"{root}/fact", ["period"], dynamic_overwrite=True)
        have = _month(day)
        p = replace(fixture_params(), as_of=day)
        refresh_months(spark, f"{root}/fact", f"{root}/state", s.dim_date, p)
        features = features_from_months(spark, f"{root}/state", s.dim_customer, s.dim_product, p)
        out.append(comparable_features(features).withColumn("run", F.lit(day)))
    return out[0].unionByName(out[1]).unionByName(out[2])


# ------------------------------------------------------------------ distinct counts that merge


def _two_loads(lines: DataFrame) -> list[DataFrame]:
    """Two disjoint loads: an order's lines (so its order, customer and products) fall into both."""
    first = F.col("order_line_key") < "8"
    return [lines.where(first), lines.where(~first)]


@register("distinct_from_loads", O.over_pipeline(
    "SELECT cus_customer_id AS customer_id, COUNT(DISTINCT order_id) AS orders, "
    "COUNT(DISTINCT CASE WHEN promo_flag = 1 THEN order_id END) AS promo_orders, "
    "COUNT(DISTINCT product_category) AS categories FROM window_lines GROUP BY cus_customer_id", "window_lines"))
def q_distinct_from_loads(spark, d) -> DataFrame:
    """Per customer, from the written bits of two loads; a category keeps its number from the first load on."""
    s, p = fixture_gold_inputs(spark, d), fixture_params()
    root = scratch_path(spark, "bits")
    products = s.dim_product.select("product_id", "product_category")
    numbers, states = None, []
    for i, load in enumerate(_two_loads(feat.channel_window_filter(s.fact_order_line, s.dim_customer, p))):
        lines = load.join(broadcast_if_within(products, sized_by=s.dim_product), "product_id", "left")
        path = f"{root}/categories-{i}"
        dense_ids(lines, "product_category", numbers).write.parquet(path)
        numbers = spark.read.parquet(path)
        lines = lines.join(broadcast_if_within(numbers), "product_category", "left")
        promo = F.when(F.col("promo_flag") == p.promo_value, F.col("order_id"))
        bits = bit_state(lines, ["customer_id"], {"orders": F.col("order_id"), "promo_orders": promo, "categories": F.col("id")})
        bits.write.parquet(f"{root}/load={i}")
        states.append(spark.read.parquet(f"{root}/load={i}"))
    return count_bits(merge_bits(states, ["customer_id"]), ["customer_id"], ["orders", "promo_orders", "categories"])


@register("distinct_by_month_from_loads", O.over_pipeline(
    f"SELECT period, pay_type, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers, "
    f"COUNT(DISTINCT product_id) AS products FROM fact_order_line WHERE period >= {O.WINDOW_START} GROUP BY ALL", "fact_order_line"))
def q_distinct_by_month_from_loads(spark, d) -> DataFrame:
    """Per month and payment type, from the written bitmaps of two loads."""
    s, keys = fixture_gold_inputs(spark, d), ["period", "pay_type"]
    sets = {"orders": F.col("order_id"), "customers": F.col("customer_id"), "products": F.col("product_id")}
    root, states = scratch_path(spark, "bitmaps"), []
    for i, load in enumerate(_two_loads(s.fact_order_line)):
        bit_state(load, keys, sets, wide=True).write.parquet(f"{root}/load={i}")
        states.append(spark.read.parquet(f"{root}/load={i}"))
    return count_bits(merge_bits(states, keys, wide=True), keys, list(sets), wide=True)


# ------------------------------------------------------------------ hot orders


@register("fact_order_line_hot", O.over_pipeline("SELECT * FROM fact_order_line", "fact_order_line", detail="hot"))
def q_fact_order_line_hot(spark, d) -> DataFrame:
    """The one-plan line fact with one order that holds a third of all lines."""
    s = fixture_silver(spark, d, detail="hot")
    return fact_order_line(s.raw_header, s.raw_detail, s.dim_customer, s.dim_product, s.dim_date, heavy_rows=500)


# ------------------------------------------------------------------ the latest row per key, batch by batch


@register("latest_from_batches", O.with_ctes(
    [("raw_order_header", O.raw_order_header("dup")), ("std_header", O.STD_HEADER), ("latest_header", O.LATEST_HEADER)],
    "SELECT * FROM latest_header"))
def q_latest_from_batches(spark, d) -> DataFrame:
    """Three batches of headers (by day of the month, so an order's versions fall into different ones), merged one after the other
    into the written winners."""
    raw = parsed_rows(fx.raw_order_header(spark, d, "dup"), ORDER_HEADER_SPEC, ["order_id"])
    headers = standardize_order_header(raw)
    root, path = scratch_path(spark, "latest"), None
    deal = F.coalesce(F.dayofmonth("order_date") % 3, F.lit(0))
    for i in (1, 0, 2):
        out = f"{root}/v{i}"
        winners = latest_parquet(spark, headers.where(deal == i), path, out, ["order_id"], "order_date")
        path = out
    return winners


# ------------------------------------------------------------------ content of a write


_HALF = "CAST(SUM(CAST('0x' || substr(md5(row), {a}, 15) AS HUGEINT)) AS VARCHAR)"
_ROW = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    for c in ("order_key", "order_id", "customer_key", "date_key", "channel_name", "pay_type", "currency", "order_net_amount", "order_gross_amount"))


@register("dq_content_reconcile", O.over_pipeline(f"""
    SELECT COUNT(*) AS rows_written, COUNT(*) AS rows_read, {_HALF.format(a=1)} || ':' || {_HALF.format(a=17)} AS content_written,
           content_written AS content_read, TRUE AS ok
    FROM (SELECT {_ROW} AS row FROM ({O.FACT_ORDER}))""", "dim_customer", customers="clean", products="clean", header="dirty", detail="dirty"))
def q_dq_content_reconcile(spark, d) -> DataFrame:
    """The order fact written by channel; what was written and what is read back, by content."""
    s = fixture_silver(spark, d)
    return write_and_reconcile_content(fact_order(s.raw_header, s.dim_customer), scratch_path(spark, "fact_order"), partition_by=["channel_name"])


# ------------------------------------------------------------------ new files only


@register("bronze_increment", O.with_ctes(_HDR, "SELECT * FROM std_header"))
def q_bronze_increment(spark, d) -> DataFrame:
    """Header files arrive three times (at other depths of the landing zone); every run loads the new ones."""
    root = scratch_path(spark, "landing")
    headers = fx.raw_order_header(spark, d, "dirty")
    year = F.coalesce(F.year("order_date"), F.lit(1995))
    for place, part in (("", year < 1997), ("/b", (year >= 1997) & (year < 1999)), ("/b/c", year >= 1999)):
        fx.stage_csv(headers.where(part), f"{root}/raw{place}", mode="append")
        ingest_new(spark, f"{root}/raw", f"{root}/bronze", "*.csv", now=fx.FIXTURE_NOW)
    return standardize_order_header(read_bronze(spark, f"{root}/bronze"))


@register("bronze_increment_counts", """
    SELECT i AS "load", count(*) FILTER (part = i) AS rows_written, count(*) FILTER (part = i) AS rows_read, TRUE AS ok
    FROM (SELECT CASE WHEN year(o_orderdate) < 1997 THEN 1 WHEN year(o_orderdate) < 1999 THEN 2 ELSE 3 END AS part FROM orders),
         (SELECT unnest([1, 2, 3]) AS i) GROUP BY i""")
def q_bronze_increment_counts(spark, d) -> DataFrame:
    """What each of three runs has loaded."""
    root = scratch_path(spark, "landing-counts")
    headers, year = fx.raw_order_header(spark, d), F.year("order_date")
    reports = []
    for name, part in (("a", year < 1997), ("b", (year >= 1997) & (year < 1999)), ("c", year >= 1999)):
        fx.stage_csv(headers.where(part), f"{root}/raw/{name}")
        reports.append(ingest_new(spark, f"{root}/raw", f"{root}/bronze", "*.csv", now=fx.FIXTURE_NOW).select("load", "rows_written", "rows_read", "ok"))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


# ------------------------------------------------------------------ recovery


@register("upsert_partitioned_recovered", _merge_sql(legacy=False))
def q_upsert_partitioned_recovered(spark, d) -> DataFrame:
    """An upsert of partitions that stopped after its commit, finished by the next start."""
    path = f"{scratch_path(spark, 'upsert_recovered')}/target"
    _upsert_target(spark, d).write.partitionBy("segment").parquet(path)
    prepare_partitions(spark, _upsert_source(spark, d), path, _UPSERT_KEYS, ["segment"], now=fx.FIXTURE_NOW)
    recover_partitions(spark, path)
    return _tracked_out(spark.read.parquet(path))


@register("medallion_resumed", O.over_pipeline(f"SELECT {_FEATURE_SQL_COLS} FROM features", "features", **_DUP))
def q_medallion_resumed(spark, d) -> DataFrame:
    """A run whose gold layer was for another channel, resumed: bronze and silver stay, gold is written anew."""
    root, p = scratch_path(spark, "medallion-resumed"), fixture_params()
    fx.stage_landing_zone(spark, d, f"{root}/raw", **_DUP)
    options = {"calendar": fx.FIXTURE_CALENDAR, "now": fx.FIXTURE_NOW, "layout": fx.FIXTURE_LAYOUT, "resume": True}
    run_medallion(spark, f"{root}/raw", root, replace(p, channel="MACHINERY"), **options)
    return comparable_features(run_medallion(spark, f"{root}/raw", root, p, **options).gold)


# ------------------------------------------------------------------ written layout


@register("sorted_outputs", O.over_pipeline(f"""
    SELECT 'dim_customer' AS table_name, COUNT(*) AS "rows", 0 AS inversions, 0 AS overlaps, TRUE AS ok FROM dim_customer
    UNION ALL SELECT 'dim_date', COUNT(*), 0, 0, TRUE FROM dim_date
    UNION ALL SELECT 'fact_order', COUNT(*), 0, 0, TRUE FROM ({O.FACT_ORDER})""", "dim_date", customers="dup", products="clean", header="dirty", detail="dirty"))
def q_sorted_outputs(spark, d) -> DataFrame:
    """The sorted layouts, written and proved from their files."""
    root = scratch_path(spark, "sorted")
    s = fixture_silver(spark, d, customers="dup")
    tables = {
        "dim_customer": (dim_customer(s.raw_customers, sort=True), "customer_id"),
        "dim_date": (dim_date(spark, *fx.FIXTURE_CALENDAR, as_of=fx.FIXTURE_AS_OF, sort=True), "date"),
        "fact_order": (fact_order(s.raw_header, s.dim_customer, sort=True), "order_id"),
    }
    reports = []
    for name, (df, key) in tables.items():
        write_table(df, f"{root}/{name}")
        reports.append(order_report(spark, f"{root}/{name}", [key]).select(F.lit(name).alias("table_name"), "rows", "inversions", "overlaps", "ok"))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@register("partition_file_audit", O.over_pipeline(
    "SELECT period, COUNT(*) AS \"rows\", 0 AS files_over, 0 AS strays, TRUE AS ok FROM fact_order_line GROUP BY period", "fact_order_line"))
def q_partition_file_audit(spark, d) -> DataFrame:
    """The line fact in files of at most 500 rows: no file is larger, and every folder holds its own month."""
    path = scratch_path(spark, "audited")
    write_partitioned(fixture_silver(spark, d).fact_order_line, path, ["period"], max_records_per_file=500)
    own = F.floor(F.col("order_date_id") / 100) == F.col("period")
    return file_audit(spark, path, "period", own, 500).select("period", "rows", "files_over", "strays", "ok")


# ------------------------------------------------------------------ pre-flight


@register("source_preflight", """
    SELECT 'customer' AS source, TRUE AS ok, COUNT(*) AS "rows" FROM customer UNION ALL
    SELECT 'orders_header', TRUE, COUNT(*) FROM orders UNION ALL
    SELECT 'orders_detail', FALSE, 0""")
def q_source_preflight(spark, d) -> DataFrame:
    """A landing zone without detail files: found and missing sources as rows, and the rows of those that are there."""
    root = scratch_path(spark, "preflight")
    fx.stage_csv(fx.raw_customers(spark, d), f"{root}/customers.csv")
    fx.stage_csv(fx.raw_order_header(spark, d), f"{root}/orders_header")
    layout = {name: fx.FIXTURE_LAYOUT[name] for name in ("customer", "orders_header", "orders_detail")}
    report = preflight(spark, root, layout)
    there = [r["source"] for r in report.where("ok").collect()]
    counts = [ingest_csv(spark, f"{root}/{layout[n][0]}", layout[n][1]).agg(F.count(F.lit(1)).alias("rows")).withColumn("source", F.lit(n)) for n in there]
    return report.join(counts[0].unionByName(counts[1]), "source", "left").select("source", "ok", F.coalesce("rows", F.lit(0)).alias("rows"))


# ------------------------------------------------------------------ the whole run by increments


def stage_increment(spark, d, raw_root: str, i: int, customers="dup", products="dup", header="dirty_dup", detail="dirty", compression: str | None = None) -> None:
    """The i-th of two arrivals: versions of a customer, product or order and lines of one order come with different ones. The
    files of headers and lines may be compressed."""
    mine = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(2)) == i
    c, p = fx.raw_customers(spark, d, customers), fx.raw_products(spark, d, products)
    h, li = fx.raw_order_header(spark, d, header), fx.raw_order_detail(spark, d, detail)
    fx.stage_csv(c.where(mine("customer_name")), f"{raw_root}/customers.csv", mode="append")
    fx.stage_csv(p.where(mine("brand", "sub_category")), f"{raw_root}/products.csv", mode="append")
    fx.stage_csv(h.where(mine("order_id", "order_date")), f"{raw_root}/orders_header", mode="append", compression=compression)
    fx.stage_csv(li.where(mine("order_id", "line_id")), f"{raw_root}/orders_detail", mode="append", compression=compression)


def _increments(spark, d, root: str):
    p, result = fixture_params(), None
    layout = fx.FIXTURE_LAYOUT | {n: (n, "*.csv.gz") for n in ("orders_header", "orders_detail")}
    for i in range(2):
        stage_increment(spark, d, f"{root}/raw", i, compression="gzip")
        result = run_increment(spark, f"{root}/raw", root, p, fx.FIXTURE_CALENDAR, now=fx.FIXTURE_NOW, layout=layout)
    return result


@register("medallion_increments", O.over_pipeline(f"SELECT {_FEATURE_SQL_COLS} FROM features", "features", **_DUP))
def q_medallion_increments(spark, d) -> DataFrame:
    """The gold features after two arrivals of files, each merged into what is written."""
    return comparable_features(_increments(spark, d, scratch_path(spark, "increments")).gold)


@register("fact_from_increments", O.over_pipeline("SELECT * FROM fact_order_line", "fact_order_line", **_DUP))
def q_fact_from_increments(spark, d) -> DataFrame:
    """The line fact after two arrivals of files."""
    result = _increments(spark, d, scratch_path(spark, "increments-fact"))
    return spark.read.parquet(result.fact_path).select(*FACT_ORDER_LINE_COLUMNS)
