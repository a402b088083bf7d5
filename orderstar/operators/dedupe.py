"""Keep one row per key (``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``).

Spark plans ``row_number() ... = 1`` as ``WindowGroupLimit`` (Partial before the shuffle, Final after),
so duplicates of a hot key are cut to one row per map task *before* they are shuffled: a key holding a
third of all rows costs one row per input partition in the exchange, not a third of the data.

The original orders by columns that are constant within the key (e.g. ``PARTITION BY product_id ORDER
BY product_id``), which picks an arbitrary row that can differ between two executions of the same plan.
We always append explicit tie-breakers — by default every remaining column, ascending with NULLs first —
so the survivor is a function of the data alone, independent of partitioning and retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderstar.operators.sizing import MAX_BROADCAST_ROWS, broadcast_if_within
from orderstar.session import scratch_path

_RN = "__orderstar_rn"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    tie_breakers: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One row per ``keys``: the first under ``order_by`` then ``tie_breakers``.

    ``order_by`` entries are Columns with a direction (e.g. ``F.col("d").desc()``); plain names sort
    ascending. ``tie_breakers=None`` means all columns that are not keys, ascending, NULLs first.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys]
    ordering = [_as_col(c) for c in order_by] + [_as_col(c).asc_nulls_first() if isinstance(c, str) else c
                                                 for c in tie_breakers]
    if not ordering:
        ordering = [F.lit(1)]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def merge_first(
    winners: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    tie_breakers: Sequence[str | Column] | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``keep_first`` over all batches so far, from the winners of the earlier ones and one new batch.

    The order with its tie-breakers is total, so the winner of a key among all rows is the winner among the earlier winner and the
    batch: the result does not depend on how rows are dealt into batches, nor on the batches' order. Only the batch and
    the winners of its keys are shuffled; other winners pass an anti join on the map side. Beyond the broadcast bound these joins
    would shuffle all winners twice, so there one dedupe over both shuffles everything once. NULL keys are one key, as in
    ``keep_first``. ``batch`` is read several times: pass a written or small one."""
    cols = winners.columns
    new = keep_first(batch.select(*cols), keys, order_by, tie_breakers)
    touched = new.select(*(F.col(k).alias(f"__{k}") for k in keys))
    side = broadcast_if_within(touched, max_broadcast_rows)
    if side is touched:
        return keep_first(winners.unionByName(batch.select(*cols)), keys, order_by, tie_breakers)
    same = F.lit(True)
    for k in keys:
        same = same & winners[k].eqNullSafe(F.col(f"__{k}"))
    rivals = winners.join(side, same, "left_semi").unionByName(new)
    return winners.join(side, same, "left_anti").unionByName(keep_first(rivals, keys, order_by, tie_breakers))


def merge_latest(
    winners: DataFrame, batch: DataFrame, keys: Sequence[str], ts_col: str, tie_breakers: Sequence[str | Column] | None = None, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """``latest_per_key`` over all batches so far (see :func:`merge_first`)."""
    return merge_first(winners, batch, keys, [F.col(ts_col).desc_nulls_last()], tie_breakers, max_broadcast_rows)


def latest_parquet(
    spark: SparkSession, batch: DataFrame, winners_path: str | None, output_path: str, keys: Sequence[str], ts_col: str,
    tie_breakers: Sequence[str | Column] | None = None, max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Merges a batch into the written winners (None: the first batch) and writes the new winners to a new path. The batch's own
    winners are written to the scratch folder first, so the batch is read once."""
    staged = scratch_path(spark, "latest-batch")
    latest_per_key(batch, keys, ts_col, tie_breakers).write.parquet(staged)
    new = spark.read.schema(batch.schema).parquet(staged)
    if winners_path is not None:
        winners = spark.read.schema(batch.schema).parquet(winners_path)
        new = merge_latest(winners, new, keys, ts_col, tie_breakers, max_broadcast_rows)
    new.write.mode("errorifexists").parquet(output_path)
    return spark.read.schema(batch.schema).parquet(output_path)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    tie_breakers: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The row with the greatest ``ts_col`` per key (NULL timestamps last)."""
    return keep_first(df, keys, [F.col(ts_col).desc_nulls_last()], tie_breakers)
