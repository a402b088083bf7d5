"""Spark helpers of the text operators: written hand-offs and connected components."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstar.session import scratch_path


#: Removes the shuffle files of a query when it ends (its results are then in the written table).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared scratch folder and read it back: cuts the lineage, so a lost
    executor repeats only what follows. Shuffle files go as soon as the write has ended; the session's setting
    is restored."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes written hand-offs (of :func:`stage`) whose successors are wholly written: nothing reads them again."""
    for df in tables:
        files = df.inputFiles()
        if files:
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed but lies at the same path (a local
    session, a shared folder); elsewhere the entry has no effect."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, (root, env.get("PYTHONPATH"))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of ``links (a, b)``: ``(node, component)`` for every node of a link, the component
    being its smallest node.

    Large-star / small-star rounds until the edges stop changing. Each half round is a minimum per node
    (combined on the map side) and a join of the written minima, whose large partitions Spark can split,
    so a node with very many links is no single task. The edges are written after each half round; only
    their count and a hash sum reach the driver.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-cc"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}-cc-low")
        edges = stage(
            both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{name}-cc-large"
        )
        low = stage(edges.groupBy("a").agg(F.min("b").alias("m")), f"{name}-cc-low")
        near = edges.join(low, "a")
        edges = stage(
            near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).distinct(),
            f"{name}-cc-small",
        )
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    tops = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops)
