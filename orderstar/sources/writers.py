"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the original bounds fact files at 500,000 rows.
MAX_RECORDS_PER_FILE = 500_000

#: Removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files behind; the session's setting is restored. Only for writes whose plan is not run again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Full write of a parquet table."""
    df.write.mode(mode).parquet(path)


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of one value of ``columns`` together, while AQE splits large values into tasks of the advisory size."""
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str],
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    mode: str = "overwrite",
    rebalance: bool = True,
    dynamic_overwrite: bool = False,
) -> None:
    """Hive-partitioned parquet write with bounded files.

    ``rebalance=True`` adds a ``REBALANCE(partition columns)`` hint: rows of one partition value are
    brought together (few files per directory instead of one per task and value) while AQE splits a
    large partition value into several tasks of the advisory size — no single task gets a whole month.
    ``dynamic_overwrite=True`` replaces only the partition values present in ``df``.
    """
    if rebalance:
        df = rebalanced(df, partition_columns)
    writer = (
        df.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_columns)
    )
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
