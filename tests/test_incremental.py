"""Incremental operators: what is merged from parts equals what is computed at once."""

from __future__ import annotations

import itertools
import os
import random
import shutil
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderstar.operators import features as feat
from orderstar.operators.bitsets import bit_members, bit_state, count_bits, dense_ids, merge_bits
from orderstar.operators.dedupe import latest_parquet, latest_per_key, merge_latest
from orderstar.operators.facts import enriched_headers, heavy_orders, join_line_header, join_line_header_split, latest_order_headers, latest_order_lines
from orderstar.operators.merge import replace_rows
from orderstar.operators.monthly import features_from_months, refresh_months, state_paths
from orderstar.operators.quality import content_report, content_state, write_and_reconcile_content
from orderstar.plans import increments
from orderstar.plans.fixture_build import fixture_gold_inputs, fixture_params, fixture_silver
from orderstar.plans.incremental import stage_increment
from orderstar.sources import fixtures as fx
from orderstar.sources.files import partition_values
from orderstar.sources.writers import write_partitioned
from tests.conftest import SF_SMALL, rows


def same(a, b, *order):
    return rows(a, *order) == rows(b.select(*a.columns), *order)


# ------------------------------------------------------------------ monthly state


def test_months_merge_to_the_features_and_old_months_are_not_read(spark, tmp_root):
    wide = replace(fixture_params(), as_of="2001-08-01", months=14)
    s = fixture_gold_inputs(spark, SF_SMALL, wide)
    fact, state = f"{tmp_root}/fact", f"{tmp_root}/state"
    held = 0
    for day in ("2001-01-20", "2001-02-20", "2001-08-01"):
        month = int(day[:4]) * 100 + int(day[5:7])
        write_partitioned(s.fact_order_line.where((F.col("period") > held) & (F.col("period") <= month)), fact, ["period"], dynamic_overwrite=True)
        p = replace(fixture_params(), as_of=day, months=8)
        new = refresh_months(spark, fact, state, s.dim_date, p)
        assert new == [m for m in partition_values(spark, s.root + "/fact_order_line", "period") if (held or feat_start(spark, p)) < m <= month or m == feat_start(spark, p) and not held]
        assert refresh_months(spark, fact, state, s.dim_date, p) == []
        whole = feat.customer_features(s.fact_order_line.where(F.col("period") <= month), s.dim_customer, s.dim_product, s.dim_date, p)
        merged = features_from_months(spark, state, s.dim_customer, s.dim_product, p)
        got, want = rows(merged, "customer_id"), rows(whole, "customer_id")
        assert got == want and len(got) > 5
        # the months read so far are gone: a later run that needed them would fail or give less
        for m in partition_values(spark, fact, "period"):
            shutil.rmtree(f"{fact}/period={m}")
        held = month


def feat_start(spark, p):
    return spark.range(1).select(feat.window_start_period(p.as_of, p.months)).first()[0]


def test_changed_month_is_redone_and_parameters_keep_apart(spark, tmp_root):
    p = fixture_params()
    s = fixture_gold_inputs(spark, SF_SMALL, p)
    fact, state = f"{tmp_root}/fact", f"{tmp_root}/state"
    write_partitioned(s.fact_order_line.where("order_id % 2 = 0"), fact, ["period"])
    assert refresh_months(spark, fact, state, s.dim_date, p)
    write_partitioned(s.fact_order_line, fact, ["period"])
    months = partition_values(spark, fact, "period")
    assert refresh_months(spark, fact, state, s.dim_date, p, changed=months[:1]) == months[:1]
    refresh_months(spark, fact, state, s.dim_date, p, changed=months[1:])
    want = feat.customer_features(s.fact_order_line, s.dim_customer, s.dim_product, s.dim_date, p)
    assert same(features_from_months(spark, state, s.dim_customer, s.dim_product, p), want, "customer_id")
    other = replace(p, credit_type="2-HIGH")
    assert state_paths(state, other) != state_paths(state, p) and refresh_months(spark, fact, state, s.dim_date, other) == months
    want = feat.customer_features(s.fact_order_line, s.dim_customer, s.dim_product, s.dim_date, other)
    assert same(features_from_months(spark, state, s.dim_customer, s.dim_product, other), want, "customer_id")
    shuffled = replace(p, max_broadcast_customers=0)
    want = feat.customer_features(s.fact_order_line, s.dim_customer, s.dim_product, s.dim_date, p)
    assert same(features_from_months(spark, state, s.dim_customer, s.dim_product, shuffled), want, "customer_id")


# ------------------------------------------------------------------ bits


@pytest.mark.parametrize("wide", [False, True])
def test_bits_count_what_count_distinct_counts(spark, wide):
    rng = random.Random(7)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(0, 200), rng.randint(30_000, 40_000), 2**40 + rng.randint(0, 99)]), rng.randint(0, 5)) for _ in range(3000)]
    if not wide:
        data += [("a", -rng.randint(1, 70), 1) for _ in range(50)]
    df = spark.createDataFrame(data, "k string, x long, y int")
    # overlapping loads: rows of the second are also in the first
    loads = [df.where("y < 4"), df.where("y > 1")]
    state = merge_bits([bit_state(part, ["k"], {"x": F.col("x"), "y": F.col("y")}, wide) for part in loads], ["k"], wide)
    want = df.groupBy("k").agg(F.count_distinct("x").alias("x"), F.count_distinct("y").alias("y"))
    assert same(count_bits(state, ["k"], ["x", "y"], wide), want, "k")
    if not wide:
        members = bit_members(state.where("of = 'x'"))
        assert same(members.select("k", "id"), df.where("x IS NOT NULL").select("k", F.col("x").alias("id")).distinct(), "k", "id")


def test_dense_ids_stay(spark):
    first = dense_ids(spark.createDataFrame([("b",), ("d",), (None,), ("b",)], "c string"), "c")
    assert {r.c: r.id for r in first.collect()} == {"b": 0, "d": 1}
    second = dense_ids(spark.createDataFrame([("a",), ("d",), ("e",)], "c string"), "c", first)
    assert {r.c: r.id for r in second.collect()} == {"b": 0, "d": 1, "a": 2, "e": 3}


# ------------------------------------------------------------------ hot orders


def test_hot_order_is_dealt_evenly(spark):
    s = fixture_silver(spark, SF_SMALL, detail="hot")
    headers = enriched_headers(latest_order_headers(s.raw_header), s.dim_customer, s.dim_date)
    lines = latest_order_lines(s.raw_detail)
    assert [r.heavy_id for r in heavy_orders(lines, 1000).collect()] == [1]
    keys = ["order_id", "line_id"]
    plain, split = join_line_header(lines, headers), join_line_header_split(lines, headers, 1000)
    assert same(split, plain, *keys)
    assert split.where("order_id = 1 AND h_order_id IS NULL").count() == plain.where("order_id = 1 AND h_order_id IS NULL").count()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        even, uneven = tasks(join_line_header_split(lines, headers, 1000)), tasks(join_line_header(lines, headers))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert even[-1] <= 2 * even[len(even) // 2] < uneven[-1]
    # beyond the broadcast bound, and without heavy orders, it is the plain join
    assert same(join_line_header_split(lines, headers, 1000, max_broadcast_rows=0), plain, *keys)
    assert same(join_line_header_split(lines, headers, 10**9), plain, *keys)


# ------------------------------------------------------------------ latest per key, batch by batch


def test_batches_in_any_order_give_the_winners_of_one_dedupe(spark, tmp_root):
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice(["u", None]), rng.choice([None, "2001-01-01", "2001-01-02"]), rng.randint(0, 3)) for _ in range(120)]
    df = spark.createDataFrame(data, "a int, b string, t string, v int").withColumn("t", F.col("t").cast("date"))
    deal = F.pmod(F.xxhash64("a", "b", "t", "v"), F.lit(3))
    want = latest_per_key(df, ["a", "b"], "t")
    for n, order in enumerate(itertools.permutations(range(3))):
        batches = [df.where(deal == i) for i in order]
        if n:
            winners = latest_per_key(batches[0], ["a", "b"], "t")
            for batch in batches[1:]:
                winners = merge_latest(winners, batch, ["a", "b"], "t", max_broadcast_rows=0 if n % 2 else 1000)
        else:
            path = None
            for i, batch in enumerate(batches):
                winners = latest_parquet(spark, batch, path, f"{tmp_root}/v{i}", ["a", "b"], "t")
                path = f"{tmp_root}/v{i}"
        assert same(winners, want, "a", "b")


# ------------------------------------------------------------------ content


def test_one_changed_value_fails_the_reconcile(spark, tmp_root):
    df = spark.createDataFrame([(1, "a", None, 1.5, [1], b"x"), (2, None, "b", None, None, None), (2, None, "b", None, None, None), (3, "-", "1:a", 0.0, [], b"")], "i int, s string, t string, d double, l array<int>, b binary")
    ok = write_and_reconcile_content(df.repartition(3), f"{tmp_root}/t").first()
    assert ok["ok"] and ok["rows_read"] == 4 and ok["content_written"] == ok["content_read"]
    went_in = df.agg(*content_state(df)).first().asDict()
    report = lambda back: content_report(went_in, back).first()
    assert report(df.orderBy(F.desc("i")).coalesce(1))["ok"]
    one = F.col("i") == 3
    for c, value in (("s", F.lit("_")), ("s", F.lit(None)), ("t", F.lit("1:b")), ("d", F.lit(0.5)), ("l", F.array(F.lit(0))), ("b", F.lit(None).cast("binary"))):
        bad = report(df.withColumn(c, F.when(one, value).otherwise(F.col(c))))
        assert not bad["ok"] and bad["rows_read"] == 4, c
    assert not report(df.distinct())["ok"]
    # the same number of rows: one lost, another twice
    assert not report(df.distinct().unionByName(df.where(one)))["ok"]
    # values moved between columns
    assert not report(df.withColumn("s2", F.when(F.col("i") == 2, F.col("t")).otherwise(F.col("s"))).withColumn("t", F.when(F.col("i") == 2, F.col("s")).otherwise(F.col("t"))).drop("s").withColumnRenamed("s2", "s").select(*df.columns))["ok"]
    parts = write_and_reconcile_content(df.withColumn("p", F.lit(7).cast("long")), f"{tmp_root}/p", partition_by=["p"]).first()
    assert parts["ok"] and os.path.isdir(f"{tmp_root}/p/p=7")


def test_a_table_written_anew_is_read_anew(spark, tmp_root):
    spark.range(3).write.parquet(f"{tmp_root}/part.parquet")
    assert fx.table(spark, tmp_root, "part").count() == 3 and fx.table(spark, tmp_root, "part") is fx.table(spark, tmp_root, "part")
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_root}/part.parquet")
    assert fx.table(spark, tmp_root, "part").count() == 5


def test_increments_give_the_run_over_all_files(spark, tmp_root, monkeypatch):
    """Two arrivals with versions, members and lines of the same orders in both; the second run stops before it is recorded."""
    p = fixture_params()
    run = lambda: increments.run_increment(spark, f"{tmp_root}/raw", tmp_root, p, fx.FIXTURE_CALENDAR, now=fx.FIXTURE_NOW, layout=fx.FIXTURE_LAYOUT)
    stage_increment(spark, SF_SMALL, f"{tmp_root}/raw", 0)
    first = run()
    assert first.affected_orders > 1000 and rows(first.gold)
    stage_increment(spark, SF_SMALL, f"{tmp_root}/raw", 1)
    real = increments.put_record

    def stops(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(increments, "put_record", stops)
    with pytest.raises(KeyboardInterrupt):
        run()
    monkeypatch.setattr(increments, "put_record", real)
    second = run()
    assert second.affected_orders > 0 and all(r.first()["files_new"] == 0 for n, r in second.reports.items() if not n.startswith("casts"))
    s = fixture_silver(spark, SF_SMALL, customers="dup", products="dup", header="dirty_dup")
    fact = spark.read.parquet(second.fact_path)
    assert same(s.fact_order_line, fact, "order_id", "line_id", "order_line_key")
    want = feat.customer_features(s.fact_order_line, s.dim_customer, s.dim_product, s.dim_date, p)
    assert same(second.gold, want, "customer_id")
    third = run()
    assert (third.affected_orders, third.months) == (0, []) and same(third.gold, want, "customer_id")


def test_replace_rows(spark, tmp_root):
    """Keys with several rows, keys that go for good, keys that change partition."""
    path = f"{tmp_root}/t"
    make = lambda data: spark.createDataFrame(data, "k int, n int, p int")
    gone = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k int")
    held = lambda: sorted((r.k, r.n, -1 if r.p is None else r.p) for r in spark.read.parquet(path).collect())
    assert replace_rows(spark, make([(1, 1, 1), (1, 2, 1), (2, 1, 2), (3, 1, None), (4, 1, 9)]), gone(1), path, ["k"], ["p"]) == {(1,), (2,), (None,), (9,)}
    untouched = os.listdir(f"{path}/p=2")
    assert replace_rows(spark, make([(1, 7, 1), (3, 1, 4), (3, 2, 4)]), gone(1, 3, 4), path, ["k"], ["p"]) == {(1,), (None,), (9,), (4,)}
    assert held() == [(1, 7, 1), (2, 1, 2), (3, 1, 4), (3, 2, 4)] and os.listdir(f"{path}/p=2") == untouched
    assert sorted(x for x in os.listdir(path) if x.startswith("p=")) == ["p=1", "p=2", "p=4"]


def test_replaced_partitions_are_few_files_and_moved(spark, tmp_root):
    """Many tasks with rows of every partition: a file a partition and not one a task; several pieces; nothing staged is left."""
    path = f"{tmp_root}/t"
    make = lambda i, n: spark.range(i, n, 1, 16).selectExpr("cast(id AS int) AS k", "cast(id % 5 AS int) AS p", "repeat('x', 3) AS v").select("k", "v", "p")
    files = lambda: {str(f.relative_to(path)) for f in Path(path).rglob("*.parquet")}
    none = spark.range(0).selectExpr("cast(id AS int) AS k")
    assert replace_rows(spark, make(0, 2000), none, path, ["k"], ["p"]) == {(p,) for p in range(5)}
    assert len(files()) == 5
    gone = spark.range(1000, 2000).selectExpr("cast(id AS int) AS k")
    assert replace_rows(spark, [make(3000, 3100), make(3100, 3500)], gone, path, ["k"], ["p"]) == {(p,) for p in range(5)}
    assert len(files()) <= 15 and not any("_upsert" in f for f in files())
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [*range(1000), *range(3000, 3500)]


def test_increments_in_rounds_leave_only_what_is_read(spark, tmp_root, monkeypatch):
    """Affected orders joined in several rounds; batches, lists of orders and superseded winners are gone afterwards."""
    monkeypatch.setattr(increments, "ROUND_ORDERS", 500)
    p = fixture_params()
    for i in range(2):
        stage_increment(spark, SF_SMALL, f"{tmp_root}/raw", i, header="dirty", customers="clean", products="clean")
        result = increments.run_increment(spark, f"{tmp_root}/raw", tmp_root, p, fx.FIXTURE_CALENDAR, now=fx.FIXTURE_NOW, layout=fx.FIXTURE_LAYOUT)
        assert result.affected_orders > 500
    s = fixture_silver(spark, SF_SMALL, header="dirty")
    assert same(s.fact_order_line, spark.read.parquet(result.fact_path), "order_id", "line_id", "order_line_key")
    left = {str(f.relative_to(f"{tmp_root}/silver")) for v in (1, 2) for f in Path(f"{tmp_root}/silver/v{v}").glob("*")} | {str(f.relative_to(f"{tmp_root}/silver")) for f in Path(f"{tmp_root}/silver").glob("v*/batch/*")}
    assert left == {"v1/batch", "v1/rejects", "v1/batch/customer", "v1/batch/product", "v2/batch", "v2/rejects", *(f"v2/{n}" for n in fx.FIXTURE_LAYOUT)}
