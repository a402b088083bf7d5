"""Unit tests on tiny literal DataFrames: the cases the driver's tables lack (duplicate and NULL keys,
orphan lines, non-positive amounts, dates outside the calendar, zero denominators, ties)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderstar.functions.keys import date_key, hash_key, key_or_default, period_key
from orderstar.operators.dedupe import keep_first, latest_per_key
from orderstar.operators.dimensions import calendar_range_from, dim_customer, dim_date, dim_product
from orderstar.operators.facts import (
    FACT_ORDER_LINE_COLUMNS,
    fact_order,
    fact_order_line,
    positive_line_filter,
)
from orderstar.operators.standardize import standardize_order_header
from tests.conftest import rows

D = dt.date

CUSTOMER_COLS = ("customer_id customer_name canal segmento_actual region comuna fecha_alta estado "
                 "mix_credito_vs_contado_3m").split()
HEADER_COLS = ("order_id customer_id order_date canal tipo_pago flag_promo_pedido order_net_amount "
               "order_gross_amount currency").split()
LINE_COLS = ("order_id line_id product_id qty_units unit_price discount_amount promo_flag line_net_amount "
             "order_net_amount_replicated").split()
PRODUCT_COLS = "product_id product_category sub_category brand".split()


def raw(spark, cols, data):
    """A raw (bronze-like) table: every value a string, as read from CSV."""
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in data],
                                 ", ".join(f"{c} string" for c in cols))


# ------------------------------------------------------------------ dedupe


def test_latest_per_key_is_deterministic_across_partitionings(spark):
    df = spark.createDataFrame(
        [(1, D(2020, 1, 1), "a"), (1, D(2021, 1, 1), "b"), (1, None, "c"), (2, None, "e"), (2, None, "d")],
        "k int, ts date, v string")
    for n in (1, 3, 7):
        out = rows(latest_per_key(df.repartition(n), ["k"], "ts"), "k")
        # latest date wins; among equal (NULL) dates the remaining columns break the tie
        assert [(r["k"], r["v"]) for r in out] == [(1, "b"), (2, "d")]


def test_keep_first_exact_duplicates_keeps_one(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 1, "x"), (1, 2, "y"), (None, 1, "z"), (None, 1, "z")],
                               "o int, l int, v string")
    out = rows(keep_first(df, ["o", "l"], [F.col("l").desc()]), "o", "l")
    assert [(r["o"], r["l"]) for r in out] == [(None, 1), (1, 1), (1, 2)]


# ------------------------------------------------------------------ keys


def test_key_expressions(spark):
    df = spark.createDataFrame([(1, None, 2, D(2023, 1, 5)), (1, 2, None, None)], "a int, b int, c int, d date")
    out = df.select(
        hash_key(["a", "b", "c"]).alias("h"),
        hash_key(["a", "b", "c"], null_token="~").alias("h_tok"),
        F.md5(F.lit("1||2")).alias("expected"),
        key_or_default("b").alias("b0"),
        date_key("d").alias("dk"),
        period_key("d").alias("pk"),
    ).collect()
    # concat_ws skips NULLs: (1, NULL, 2) and (1, 2, NULL) share a key unless NULLs are encoded
    assert out[0]["h"] == out[1]["h"] == out[0]["expected"]
    assert out[0]["h_tok"] != out[1]["h_tok"]
    assert [r["b0"] for r in out] == [0, 2]
    assert (out[0]["dk"], out[0]["pk"], out[1]["dk"]) == (20230105, 202301, None)


# ------------------------------------------------------------------ dimensions


def test_dim_customer_latest_row_drops_null_keys_and_adds_unknown(spark):
    data = [
        (1, "Ana", "tradicional ", "A", "RM", "Stgo", "2020-01-01 08:00:00", "activo", None),
        (1, "Ana B", " tradicional", "B", "RM", "Stgo", "2021-01-01 08:00:00", "activo", "0.5"),
        (2, "Beto", "moderno", "A", "V", "Vina", "2019-05-05 08:00:00", "activo", "x"),
        (None, "Nadie", "moderno", "A", "V", "Vina", "2019-05-05 08:00:00", "activo", None),
        ("bad", "Malo", "moderno", "A", "V", "Vina", "not a date", "activo", None),
    ]
    dim = dim_customer(raw(spark, CUSTOMER_COLS, data))
    out = rows(dim, "customer_id")
    assert [r["customer_id"] for r in out] == [0, 1, 2]
    assert out[0]["customer_name"] == "Sin Cliente" and out[0]["channel"] == "Sin Canal"
    assert out[1]["customer_name"] == "Ana B" and out[1]["channel"] == "tradicional"  # trimmed
    assert out[1]["mix_credito_vs_contado_3m"] == 0.5 and out[2]["mix_credito_vs_contado_3m"] is None
    assert out[1]["entry_date"] == dt.datetime(2021, 1, 1, 8, 0)


def test_dim_product_one_row_per_product(spark):
    data = [(5, "cat b", "s", "x"), (5, "cat a", "s", "x"), (6, None, None, None)]
    out = rows(dim_product(raw(spark, PRODUCT_COLS, data)), "product_id")
    assert [(r["product_id"], r["product_category"]) for r in out] == [(0, "Sin Categoria"), (5, "cat a"), (6, None)]


def test_dim_date_attributes(spark):
    cal = dim_date(spark, "2022-12-31", "2023-04-01", as_of="2023-01-03")
    assert cal.count() == 92
    r = {x["date"]: x for x in cal.collect()}
    jan1 = r[D(2023, 1, 1)]
    assert (jan1["date_id"], jan1["week_of_year"], jan1["day_of_week"], jan1["day_name"], jan1["day_name_short"]) == (
        20230101, 52, 1, "Sunday", "Sun")
    assert (jan1["is_weekend"], jan1["is_month_start"], jan1["is_quarter_start"], jan1["period"]) == (1, 1, 1, "202301")
    assert r[D(2023, 1, 3)]["is_today"] == 1 and r[D(2023, 1, 2)]["is_today"] == 0
    # the whole first month of a quarter is flagged, the second is not
    assert r[D(2023, 1, 20)]["is_quarter_start"] == 1 and r[D(2023, 2, 1)]["is_quarter_start"] == 0
    assert r[D(2023, 2, 28)]["is_month_end"] == 1 and r[D(2023, 2, 28)]["month_end_date"] == D(2023, 2, 28)
    assert r[D(2023, 1, 1)]["year_month"] == "2023-01" and r[D(2023, 4, 1)]["quarter"] == 2


def test_calendar_range_from_data(spark):
    df = spark.createDataFrame([(D(1996, 3, 4),), (D(1998, 7, 1),), (None,)], "d date")
    assert calendar_range_from(df, "d") == (D(1996, 1, 1), D(1998, 12, 31))


# ------------------------------------------------------------------ facts


def _headers(spark):
    return raw(spark, HEADER_COLS, [
        # order 1: latest version (by date) has a non-positive amount -> the order leaves fact_order
        (1, 1, "2001-06-02", "tradicional", "credito", 1, "-5.00", "10.00", "CLP"),
        (1, 1, "2001-06-01", "tradicional", "credito", 1, "10.00", "10.00", "CLP"),
        (2, 2, "2001-07-01", "moderno", "contado", 0, "20.00", "20.00", "CLP"),
        (3, None, "2001-07-15", "moderno", "contado", 0, "30.00", "30.00", "CLP"),  # unknown customer
        (4, 9, "2030-01-01", "moderno", "contado", 0, "40.00", "40.00", "CLP"),  # date outside the calendar
    ])


def _lines(spark):
    return raw(spark, LINE_COLS, [
        (1, 1, 5, 0, "1.00", "0", 0, "7.00", "10.00"),   # header amount <= 0 and no units -> dropped
        (1, 2, 5, 3, "1.00", "0", 0, "3.00", "10.00"),   # units > 0 -> kept
        (2, 1, 6, 1, "1.00", "0", 1, "20.00", "20.00"),
        (2, 1, 6, 1, "1.00", "0", 1, "20.00", "20.00"),  # exact duplicate line
        (3, 1, 99, 0, "1.00", "0", 0, "30.00", "30.00"),  # unknown product
        (4, 1, 5, 2, "1.00", "0", 0, "40.00", "40.00"),
        (77, 1, 5, 0, "1.00", "0", 0, "1.00", None),     # orphan, no units -> dropped
        (78, 1, 5, 4, "1.00", "0", 0, "2.00", None),     # orphan with units -> kept, no period
    ])


def _dims(spark):
    dc = dim_customer(raw(spark, CUSTOMER_COLS, [
        (1, "A", "tradicional", "a", "r", "c", "2020-01-01 00:00:00", "activo", None),
        (2, "B", "moderno", "a", "r", "c", "2020-01-01 00:00:00", "activo", None)]))
    dp = dim_product(raw(spark, PRODUCT_COLS, [(5, "c5", "s", "b"), (6, "c6", "s", "b")]))
    dd = dim_date(spark, "2001-01-01", "2001-12-31", as_of="2001-08-01")
    return dc, dp, dd


def test_fact_order_filters_after_dedupe(spark):
    dc, _, _ = _dims(spark)
    out = rows(fact_order(_headers(spark), dc), "order_id")
    assert [r["order_id"] for r in out] == [2, 3, 4]
    # a NULL customer is defaulted to 0 (the unknown member) before the lookup; an unknown id stays NULL
    assert [r["customer_key"] for r in out] == [2, 0, None]
    mapped = rows(fact_order(_headers(spark), dc, map_unmatched_to_unknown=True), "order_id")
    assert [r["customer_key"] for r in mapped] == [2, 0, 0]


def test_fact_order_line_semantics(spark):
    dc, dp, dd = _dims(spark)
    f = fact_order_line(_headers(spark), _lines(spark), dc, dp, dd)
    assert tuple(f.columns) == FACT_ORDER_LINE_COLUMNS
    out = {(r["order_id"], r["line_id"]): r for r in f.collect()}
    assert sorted(out) == [(1, 2), (2, 1), (3, 1), (4, 1), (78, 1)]
    assert out[(1, 2)]["period"] == 200106 and out[(1, 2)]["order_date_id"] == 20010602
    assert out[(3, 1)]["customer_id"] is None and out[(3, 1)]["product_id"] is None
    assert out[(4, 1)]["order_date_id"] is None and out[(4, 1)]["period"] == 203001  # outside the calendar
    orphan = out[(78, 1)]
    assert orphan["period"] is None and orphan["customer_id"] is None and orphan["channel"] is None
    assert orphan["order_line_key"] == hash_key_value(78, 1)


def hash_key_value(order_id: int, line_id: int) -> str:
    import hashlib

    return hashlib.md5(f"{order_id}||{line_id}".encode()).hexdigest()


def test_positive_line_filter_three_valued(spark):
    df = spark.createDataFrame(
        [(1, None, 0), (2, None, 5), (3, Decimal("-1.00"), 0), (4, Decimal("10.00"), 0), (5, Decimal("0.00"), None)],
        "id int, h_order_net_amount decimal(18,2), qty_units int")
    assert sorted(r["id"] for r in positive_line_filter(df).collect()) == [2, 4]


def test_standardize_try_cast_makes_nulls_not_errors(spark):
    h = standardize_order_header(raw(spark, HEADER_COLS, [("x", "1", "2001-13-45", " a ", "b", "y", "1,5", "", "CLP")]))
    r = h.collect()[0]
    assert (r["order_id"], r["order_date"], r["flag_promo_pedido"], r["order_net_amount"], r["channel"]) == (
        None, None, None, None, "a")


def test_null_period_goes_to_default_partition(spark, tmp_root):
    from orderstar.sources.writers import write_partitioned

    dc, dp, dd = _dims(spark)
    f = fact_order_line(_headers(spark), _lines(spark), dc, dp, dd)
    write_partitioned(f, tmp_root, ["period"])
    back = spark.read.parquet(tmp_root)
    assert back.filter(F.col("period").isNull()).count() == 1
    assert back.count() == 5


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.sampled_from(["a", "b", None])),
                     min_size=1, max_size=25),
       parts=st.integers(1, 6), seed=st.integers(0, 10_000))
def test_dedupe_properties(spark, data, parts, seed):
    """One row per key; the survivor does not depend on input order or partition count."""
    import random

    shuffled = list(data)
    random.Random(seed).shuffle(shuffled)
    a = spark.createDataFrame(data, "k int, ts int, v string")
    b = spark.createDataFrame(shuffled, "k int, ts int, v string").repartition(parts)
    ra = rows(latest_per_key(a, ["k"], "ts"), "k")
    rb = rows(latest_per_key(b, ["k"], "ts"), "k")
    assert ra == rb
    assert [r["k"] for r in ra] == sorted({k for k, _, _ in data})
    for r in ra:  # the survivor carries its key's latest timestamp
        assert r["ts"] == max(t for k, t, _ in data if k == r["k"])
