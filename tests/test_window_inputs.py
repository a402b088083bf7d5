"""What the gold queries read: only the window's orders reach the dedupe and the joins of the lines."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from orderstar.operators.facts import latest_order_headers, latest_order_lines
from orderstar.operators.features import window_fact_lines
from orderstar.plans.fixture_build import GOLD_FACT_COLUMNS, fixture_gold_inputs, fixture_params, fixture_silver
from orderstar.sources import fixtures as fx
from tests.conftest import SF_SMALL
from tests.test_operators import HEADER_COLS, LINE_COLS, raw


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_headers_from_a_month_are_the_late_ones_of_all(spark):
    def header(order_id, day, amount):
        return (order_id, 1, day, "c", "p", 0, amount, amount, "CLP")

    bronze = raw(spark, HEADER_COLS, [
        header(1, "2001-05-31", 1), header(1, "2001-06-01", 2), header(2, "2001-05-31", 3), header(3, None, 4), header(3, "2001-07-02", 5),
        header(4, None, 6), header(None, "2001-06-02", 7), header("x", "2001-06-02", 8), header(5, "2001-06-03", 10), header(5, "2001-06-03", 9),
    ])
    late = latest_order_headers(bronze, from_period=F.lit(200106))
    every = latest_order_headers(bronze).where("order_date >= DATE '2001-06-01'")
    assert sorted(map(str, late.collect())) == sorted(map(str, every.collect()))
    assert {r["order_id"] for r in late.collect()} == {None, 1, 3, 5}


@pytest.mark.parametrize("bound", [10, 0])
def test_lines_of_wanted_orders(spark, tmp_root, bound):
    def line(order_id, line_id, product_id):
        return (order_id, line_id, product_id, 1, 1, 0, 0, 1, 1)

    bronze = raw(spark, LINE_COLS, [line(1, 1, 9), line(1, 1, 8), line(1, None, 7), line(2, 1, 1), line(None, 1, 1), line(3, 1, 1), line(3, 2, 1)])
    spark.createDataFrame([(1,), (3,), (4,), (None,)], "order_id int").write.parquet(f"{tmp_root}/orders")
    wanted = spark.read.parquet(f"{tmp_root}/orders")
    lines = latest_order_lines(bronze, of_orders=wanted, max_broadcast_rows=bound)
    joined = lines.join(wanted, "order_id").select("order_id", "line_id", "product_id")
    assert sorted(map(str, map(tuple, joined.collect()))) == sorted(map(str, [(1, 1, 8), (1, None, 7), (3, 1, 1), (3, 2, 1)]))
    if bound:  # the other orders' lines are gone before the dedupe
        assert lines.where("order_id = 2 OR order_id IS NULL").count() == 0


def test_gold_inputs_are_the_window_of_the_fact_without_other_lookups(spark):
    p = replace(fixture_params(), months=7)
    gold = fixture_gold_inputs(spark, SF_SMALL, p, header="dirty_dup").fact_order_line.select(*GOLD_FACT_COLUMNS)
    fact = window_fact_lines(fixture_silver(spark, SF_SMALL, header="dirty_dup").fact_order_line, p).select(*GOLD_FACT_COLUMNS)
    assert gold.count() > 0
    assert gold.exceptAll(fact).count() == 0 and fact.exceptAll(gold).count() == 0
    plain = fx.raw_order_detail(spark, SF_SMALL, "dirty", amounts=False)
    assert "Join" not in _plan(plain) and plain.columns == fx.raw_order_detail(spark, SF_SMALL, "dirty").columns
