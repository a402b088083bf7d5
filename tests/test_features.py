"""Gold features against a brute-force twin: the literal formulation (``COUNT(DISTINCT ...)`` and a
``LAG`` window over every customer's orders) run in Spark SQL on a hand-made fact with ties on one day,
orders outside the calendar, lines before the window, other channels and a zero total."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from orderstar.operators.dimensions import dim_date
from orderstar.operators.features import (
    FEATURE_COLUMNS,
    FeatureParams,
    channel_window_filter,
    customer_features,
    distinct_orders,
    order_lag,
)

P = FeatureParams(as_of="2001-08-01", channel="tradicional", credit_type="credito")
M = Decimal


def _fact(spark):
    # (order_id, line_id, product_id, customer_id, order_date_id, period, pay_type, promo_flag, amount)
    data = [
        (10, 1, 1, 1, 20010605, 200106, "credito", 1, M("100.00")),
        (10, 2, 2, 1, 20010605, 200106, "contado", 0, M("50.00")),
        (11, 1, 1, 1, 20010605, 200106, "contado", 0, M("20.00")),   # same day as order 10
        (8, 1, 2, 1, 20010605, 200106, "contado", 0, M("5.00")),     # same day, smaller id
        (12, 1, 3, 1, 20010710, 200107, "credito", 0, M("30.00")),   # product without category
        (13, 1, 2, 1, None, 200201, "contado", 0, M("10.00")),       # date outside the calendar
        (9, 1, 1, 1, 20010401, 200104, "credito", 1, M("999.00")),   # before the window
        (20, 1, 1, 2, 20010801, 200108, "credito", 0, M("0.00")),    # zero total
        (30, 1, 1, 3, 20010615, 200106, "credito", 0, M("70.00")),   # other channel
        (50, 1, 1, 5, 20010601, 200106, "contado", 1, M("1.00")),
        (51, 1, 2, 5, 20010611, 200106, "credito", 0, M("2.00")),
        (52, 1, 2, 5, 20010701, 200107, "credito", 1, M("3.00")),
        (53, 1, 2, 5, None, 200109, "credito", 0, M("4.00")),
        (60, 1, 1, None, 20010615, 200106, "credito", 0, M("8.00")),  # no customer
    ]
    schema = ("order_id int, line_id int, product_id int, customer_id int, order_date_id int, period int, "
              "pay_type string, promo_flag int, line_net_amount decimal(18,2)")
    return spark.createDataFrame(data, schema)


def _dims(spark):
    dc = spark.createDataFrame([(0, "Sin Canal"), (1, "tradicional"), (2, "tradicional"), (3, "moderno"),
                                (4, "tradicional"), (5, "tradicional")], "customer_id int, channel string")
    dp = spark.createDataFrame([(0, "Sin Categoria"), (1, "c1"), (2, "c2"), (3, None)],
                               "product_id int, product_category string")
    dd = dim_date(spark, "2001-01-01", "2001-12-31", as_of=P.as_of)
    return dc, dp, dd


LITERAL = """
WITH l AS (
  SELECT f.*, p.product_category, d.date AS order_date
  FROM fact f
  LEFT JOIN cus c ON f.customer_id = c.customer_id
  LEFT JOIN pro p ON f.product_id = p.product_id
  LEFT JOIN dat d ON f.order_date_id = d.date_id
  WHERE c.channel = 'tradicional' AND f.period >= 200106
), agg AS (
  SELECT customer_id, MAX(order_date) AS last_date, COUNT(DISTINCT order_id) AS freq,
         SUM(line_net_amount) AS total, COUNT(DISTINCT product_category) AS variety,
         COUNT(DISTINCT CASE WHEN promo_flag = 1 THEN order_id END) AS promo,
         SUM(CASE WHEN pay_type = 'credito' THEN line_net_amount ELSE 0 END) AS credit
  FROM l GROUP BY customer_id
), o AS (
  SELECT DISTINCT customer_id, order_id, order_date FROM l
), lag AS (
  SELECT *, LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS last_date FROM o
), gap AS (
  SELECT customer_id, AVG(datediff(order_date, last_date)) AS gap FROM lag GROUP BY customer_id
)
SELECT a.customer_id, datediff(last_day(DATE'2001-08-01'), a.last_date) AS recencia_dias,
       a.total AS ventas_total_3m, a.freq AS frecuencia_pedidos_3m,
       try_divide(a.total, a.freq) AS ticket_promedio_3m, g.gap AS dias_promedio_entre_pedidos,
       a.variety AS variedad_categorias_3m, a.promo / a.freq AS porcentaje_pedidos_promo_3m,
       try_divide(a.credit, a.total) AS mix_credito_vs_contado_3m
FROM agg a LEFT JOIN gap g ON a.customer_id = g.customer_id
WHERE a.freq > 0
"""


def _norm(v):
    if isinstance(v, (float, Decimal)):
        return round(float(v), 6)
    return v


def _table(df, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())


@pytest.fixture()
def views(spark):
    f, (dc, dp, dd) = _fact(spark), _dims(spark)
    for name, df in (("fact", f), ("cus", dc), ("pro", dp), ("dat", dd)):
        df.createOrReplaceTempView(name)
    return f, dc, dp, dd


@pytest.mark.parametrize("max_bcast", [2_000_000, 0])  # broadcast semi join, and the late semi join beyond the bound
def test_customer_features_match_literal(spark, views, max_bcast):
    f, dc, dp, dd = views
    p = FeatureParams(as_of=P.as_of, channel=P.channel, credit_type=P.credit_type, max_broadcast_customers=max_bcast)
    ours = customer_features(f, dc, dp, dd, p)
    assert tuple(ours.columns) == FEATURE_COLUMNS
    expected = spark.sql(LITERAL)
    got, want = _table(ours, FEATURE_COLUMNS), _table(expected, FEATURE_COLUMNS)
    assert got == want
    by_id = {r[0]: r for r in got}
    assert sorted(by_id) == [1, 2, 5]
    assert by_id[2][8] is None  # credit mix over a zero total is NULL, not an error
    assert by_id[5][5] == 15.0  # gaps 10 and 20 days


def test_order_lag_matches_window(spark, views):
    f, dc, dp, dd = views
    got = _table(order_lag(f, dc, dd, P), ["customer_id", "order_id", "order_date", "last_date"])
    want = _table(spark.sql(LITERAL.split("), gap AS")[0] + ") SELECT * FROM lag"),
                  ["customer_id", "order_id", "order_date", "last_date"])
    assert got == want
    d = {(r[0], r[1]): r[3] for r in got}
    assert d[(1, 8)] is None and d[(1, 10)] == dt.date(2001, 6, 5) and d[(1, 12)] == dt.date(2001, 6, 5)
    assert d[(1, 13)] is None  # NULL dates sort first and get no predecessor


def test_order_lag_hot_customer_many_ties(spark):
    """One customer holding most orders, many on the same days: still equal to the literal window."""
    rows = []
    for i in range(600):
        day = 1 + (i * 7) % 25
        rows.append((1000 + i, 1, 1, 1, 20010600 + day, 200106, "contado", 0, M("1.00")))
    rows += [(5000 + i, 1, 1, 2, 20010700 + 1 + i % 9, 200107, "contado", 0, M("1.00")) for i in range(30)]
    schema = ("order_id int, line_id int, product_id int, customer_id int, order_date_id int, period int, "
              "pay_type string, promo_flag int, line_net_amount decimal(18,2)")
    f = spark.createDataFrame(rows, schema).repartition(5)
    dc, dp, dd = _dims(spark)
    for name, df in (("fact", f), ("cus", dc), ("pro", dp), ("dat", dd)):
        df.createOrReplaceTempView(name)
    cols = ["customer_id", "order_id", "order_date", "last_date"]
    want = _table(spark.sql(LITERAL.split("), gap AS")[0] + ") SELECT * FROM lag"), cols)
    assert _table(order_lag(f, dc, dd, P), cols) == want
    feats = _table(customer_features(f, dc, dp, dd, P), FEATURE_COLUMNS)
    assert feats == _table(spark.sql(LITERAL), FEATURE_COLUMNS)


def test_window_and_channel_filter(spark, views):
    f, dc, dp, dd = views
    lines = channel_window_filter(f, dc, P)
    assert sorted({r["customer_id"] for r in lines.collect()}) == [1, 2, 5]
    assert all(r["period"] >= 200106 for r in lines.collect())
    orders = distinct_orders(f, dc, dd, P)
    assert orders.count() == spark.sql(LITERAL.split("), lag AS")[0] + ") SELECT * FROM o").count()


def test_feature_totals_add_up(spark, views):
    """Line -> features: monetary totals and order counts reconcile with the channel's window lines."""
    from pyspark.sql import functions as F

    f, dc, dp, dd = views
    feats = customer_features(f, dc, dp, dd, P)
    lines = channel_window_filter(f, dc, P)
    got = feats.agg(F.sum("ventas_total_3m").alias("t"), F.sum("frecuencia_pedidos_3m").alias("n")).first()
    want = lines.agg(F.sum("line_net_amount").alias("t"),
                     F.count_distinct("customer_id", "order_id").alias("n")).first()
    assert (got["t"], got["n"]) == (want["t"], want["n"])


def test_channel_filter_is_a_semi_join(spark, views):
    f, dc, dp, dd = views
    lines = channel_window_filter(f, dc, P)
    plan = spark._jvm.PythonSQLUtils.explainString(lines._jdf.queryExecution(), "formatted")
    assert "LeftSemi" in plan and "LeftOuter" not in plan
