"""A run reads and works out large inputs as often as needed, not once for every question asked of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderstar.operators.dedupe import keep_first, merge_first
from orderstar.operators.merge import replace_rows
from orderstar.operators.quality import cast_failure_report, has_key_failures, settled
from orderstar.operators.standardize import PRODUCT_SPEC
from tests.test_operators import PRODUCT_COLS, raw


def test_a_large_batch_is_merged_by_one_dedupe(spark, tmp_root):
    def table(name, data):
        spark.createDataFrame(data, "k int, d int, v string").write.parquet(f"{tmp_root}/{name}")
        return spark.read.parquet(f"{tmp_root}/{name}")

    winners = table("winners", [(1, 5, "a"), (2, 5, "b"), (None, 1, "c")])
    batch = table("batch", [(1, 6, "d"), (1, 4, "e"), (2, 4, "f"), (3, None, "g"), (None, 2, "h"), (None, 2, "i")])
    latest = [F.col("d").desc_nulls_last()]
    large, small = (merge_first(winners, batch, ["k"], latest, max_broadcast_rows=n) for n in (0, 100))
    assert "Join" not in large._jdf.queryExecution().optimizedPlan().toString()
    every = keep_first(winners.unionByName(batch), ["k"], latest)
    assert set(large.collect()) == set(small.collect()) == set(every.collect())


def test_settled_reports_tell_rejects_without_another_read(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(data):
        df = raw(spark, PRODUCT_COLS, data)
        return spark.createDataFrame(df.rdd.map(lambda r: (seen.add(1), r)[1]), df.schema)

    sources = {"good": counted([(1, "c", "s", "b"), (None, "c", "s", "b")]), "bad": counted([("x", "c", "s", "b")])}
    reports = settled({n: cast_failure_report(df, PRODUCT_SPEC, ["product_id"]) for n, df in sources.items()})
    assert not has_key_failures(reports["good"]) and has_key_failures(reports["bad"])
    assert [r["ok"] for r in reports["bad"].where("is_key").collect()] == [False]
    assert seen.value == 3


def test_replaced_rows_are_worked_out_once(spark, tmp_root):
    seen = spark.sparkContext.accumulator(0)

    def rows(data):
        return spark.createDataFrame(spark.sparkContext.parallelize(data, 1).map(lambda r: (seen.add(1), r)[1]), "id int, v string, part int")

    path, gone = f"{tmp_root}/target", spark.createDataFrame([(1,), (4,)], "id int")
    assert replace_rows(spark, rows([(1, "a", 1), (2, "b", 1), (3, "c", 2)]), gone, path, ["id"], ["part"]) == {(1,), (2,)}
    assert seen.value == 3
    assert replace_rows(spark, rows([(1, "d", 3), (4, "e", 2)]), gone, path, ["id"], ["part"]) == {(1,), (2,), (3,)}
    assert seen.value == 5
    assert set(map(tuple, spark.read.parquet(path).select("id", "v", "part").collect())) == {(2, "b", 1), (3, "c", 2), (1, "d", 3), (4, "e", 2)}
