"""Data-quality reports, returned as small DataFrames (one row per check) rather than prints / raises.

Every report is a single aggregation over the inputs (no collect of data to the driver); ``assert_ok``
turns a report into an exception when a pipeline wants the original fail-fast behaviour.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NumericType, VariantType

from orderstar.functions.clean import typed


class QualityError(AssertionError):
    pass


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each named DataFrame — one count aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dimension_reconcile(
    bronze: DataFrame,
    dim: DataFrame,
    key: str,
    unknown_key: int = 0,
    raw_key: str | None = None,
    strict: bool = False,
    max_null_keys: int | None = 0,
    id_type: str = "int",
) -> DataFrame:
    """Rows in, distinct keys, NULL keys, duplicates removed, unknown members, rows out, ok.

    ``null_keys`` counts the source rows without a usable key (missing, unparsed or too large for
    ``id_type``): they are not in the dimension, so ``ok`` allows ``max_null_keys`` of them at most (``None``: any).
    Besides, ``ok`` needs ``rows_out = distinct non-NULL keys + 1`` (the original required
    ``rows_out - 1 = rows_in``, which fails as soon as a duplicate is removed; ``strict=True`` applies that
    original rule). One pass over the union of both inputs.
    """
    raw_key = raw_key or key
    side = "__side"
    both = bronze.select(typed(raw_key, id_type).alias("k"), F.lit(0).alias(side)).unionByName(
        dim.select(F.col(key).cast(id_type).alias("k"), F.lit(1).alias(side))
    )
    b, d = F.col(side) == 0, F.col(side) == 1
    agg = both.agg(
        F.count(F.when(b, 1)).alias("rows_in"),
        F.count_distinct(F.when(b, F.col("k"))).alias("distinct_keys"),
        F.count(F.when(b & F.col("k").isNull(), 1)).alias("null_keys"),
        F.count(F.when(d, 1)).alias("rows_out"),
        F.count(F.when(d & (F.col("k") == unknown_key), 1)).alias("unknown_members"),
    )
    return agg.select(
        "rows_in",
        "distinct_keys",
        "null_keys",
        (F.col("rows_in") - F.col("distinct_keys") - F.col("null_keys")).alias("duplicates_removed"),
        "unknown_members",
        "rows_out",
        (
            (F.col("rows_out") - 1 == F.col("rows_in") if strict else F.col("rows_out") == F.col("distinct_keys") + 1)
            & (F.lit(True) if max_null_keys is None else F.col("null_keys") <= max_null_keys)
        ).alias("ok"),
    )


def write_and_reconcile(df: DataFrame, path: str, mode: str = "errorifexists", **write_options) -> DataFrame:
    """Write ``df`` as parquet counting rows on the way (``observe``, no second execution), read it back
    and report ``(rows_written, rows_read, ok)``."""
    obs = Observation("orderstar_write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode)
    partition_by = write_options.pop("partitionBy", None)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for k, v in write_options.items():
        writer = writer.option(k, v)
    writer.parquet(path)
    written = int(obs.get["rows"])
    back = df.sparkSession.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("rows_read")).select(
        F.lit(written).cast("long").alias("rows_written"),
        "rows_read",
        (F.col("rows_read") == F.lit(written)).alias("ok"),
    )


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """One string per row that no other row's values give: every value with its length in bytes, ``-`` for NULL."""
    types = dict(df.dtypes)
    parts = []
    for c in columns or df.columns:
        x = F.col("`" + c.replace("`", "``") + "`")
        if types[c] == "binary":
            x = F.hex(x)
        elif any(t in types[c] for t in ("<", "variant")):
            x = F.when(x.isNotNull(), F.to_json(F.struct(x.alias("v"))))
        else:
            x = x.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")))
    return F.concat(*parts)


def content_state(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Aggregates that tell the rows of ``df`` as a multiset: their count and the sums of two 60-bit halves of the MD5 of each row.
    Independent of order and partitioning, combined on the map side, and mergeable by addition."""
    digest = F.md5(row_text(df, columns))
    halves = [F.sum(F.conv(F.substring(digest, a, 15), 16, 10).cast("decimal(38,0)")) for a in (1, 17)]
    return [F.count(F.lit(1)).alias("rows"), *(F.coalesce(h, F.lit(0).cast("decimal(38,0)")).alias(n) for h, n in zip(halves, ("low", "high")))]


def content_report(written: Mapping[str, object], back: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(rows_written, rows_read, content_written, content_read, ok)``: the state of the rows that went in (``content_state``'s
    values) against the rows of ``back``."""
    text = ":".join(str(written[n]) for n in ("low", "high"))
    read = back.agg(*content_state(back, columns))
    content = F.concat_ws(":", F.col("low").cast("string"), F.col("high").cast("string"))
    out = read.select(F.lit(int(written["rows"])).cast("long").alias("rows_written"), F.col("rows").alias("rows_read"), F.lit(text).alias("content_written"), content.alias("content_read"))
    return out.withColumn("ok", (F.col("rows_written") == F.col("rows_read")) & (F.col("content_written") == F.col("content_read")))


def write_and_reconcile_content(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = (), **write_options) -> DataFrame:
    """Writes ``df`` while its content is observed (no second execution), reads it back and compares the content: a lost,
    repeated or changed row, also one with a single changed value, gives ``ok = false``. Partition columns are read back as
    text from folder names and cast to their own type first."""
    obs = Observation("orderstar_content")
    writer = df.observe(obs, *content_state(df)).write.mode(mode).options(**write_options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    back = df.sparkSession.read.parquet(path)
    back = back.select(*(F.col(f"`{n}`").cast(t).alias(n) for n, t in df.dtypes))
    return content_report(obs.get, back)


def order_report(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``(rows, inversions, overlaps, ok)`` of a written table that should be sorted by ``keys`` (NULLs first), read as files in the
    order of their names: rows that come before their predecessor in the file, and files that begin before an earlier one
    ends. Within a file by the rows' places in it, between files from each one's least and greatest key only."""
    key = F.struct(*(F.col(k) for k in keys))
    rows = spark.read.parquet(path).select(key.alias("k"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    back = F.lag("k").over(Window.partitionBy("file").orderBy("at")) > F.col("k")
    files = rows.withColumn("back", back).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("back"), 1)).alias("inversions"), F.min("k").alias("low"), F.max("k").alias("high")
    )
    # a row per file; longer numbers sort after shorter ones
    before = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("overlap", F.max("high").over(before) > F.col("low"))
    out = files.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("inversions"), F.lit(0)).alias("inversions"), F.count(F.when(F.col("overlap"), 1)).alias("overlaps"))
    return out.withColumn("ok", (F.col("inversions") == 0) & (F.col("overlaps") == 0))


def file_audit(spark: SparkSession, path: str, partition: str, belongs: Column, max_rows: int) -> DataFrame:
    """Per folder of ``partition``: ``(partition, rows, largest_file, files_over, strays, ok)``, from the files' names and rows:
    the rows of its largest file, the files above ``max_rows``, and the rows that do not belong there (``belongs`` is
    false; NULL counts as belonging)."""
    rows = spark.read.parquet(path).select(partition, F.col("_metadata.file_path").alias("file"), F.when(~belongs, 1).alias("stray"))
    files = rows.groupBy(partition, "file").agg(F.count(F.lit(1)).alias("n"), F.count("stray").alias("strays"))
    out = files.groupBy(partition).agg(
        F.sum("n").alias("rows"), F.max("n").alias("largest_file"), F.count(F.when(F.col("n") > max_rows, 1)).alias("files_over"), F.sum("strays").alias("strays")
    )
    return out.withColumn("ok", (F.col("files_over") == 0) & (F.col("strays") == 0))


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long-form column profile ``(column_name, count, mean, stddev, min, max)``, like ``describe()``.

    One aggregation over ``df`` covers every column (or ``columns``; an unknown name raises). ``min`` and ``max`` are
    taken in the column's own type and given as text, so large integers and decimals stay exact; ``mean``
    and ``stddev`` are NULL for columns that are not numeric, ``min`` and ``max`` for types without an order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    chosen = list(types if columns is None else columns)
    if unknown := [c for c in chosen if c not in types]:
        raise ValueError(f"no such columns: {unknown}")
    if not chosen:
        raise ValueError("a profile needs at least one column")
    aggs = []
    for i, c in enumerate(chosen):
        x = F.col("`" + c.replace("`", "``") + "`")
        number = x.cast("double") if isinstance(types[c], NumericType) else F.lit(None).cast("double")
        ordered = not isinstance(types[c], (MapType, VariantType))
        low, high = (F.min(x).cast("string"), F.max(x).cast("string")) if ordered else (F.lit(None).cast("string"),) * 2
        aggs += [F.count(x).alias(f"n{i}"), F.avg(number).alias(f"a{i}"), F.stddev_samp(number).alias(f"s{i}"), low.alias(f"lo{i}"), high.alias(f"hi{i}")]
    rows = [
        F.struct(F.lit(c).alias("column_name"), *(F.col(f"{p}{i}").alias(n) for p, n in (("n", "count"), ("a", "mean"), ("s", "stddev"), ("lo", "min"), ("hi", "max"))))
        for i, c in enumerate(chosen)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def cast_failures(raw: DataFrame, spec: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Per standardised column, how many non-NULL raw values did not parse (became NULL)."""
    aggs = [
        F.count(F.when(F.col(r).isNotNull() & typed(r, kind).isNull() & F.lit(kind != "text"), 1)).alias(out)
        for out, r, kind in spec
    ]
    return raw.agg(*aggs)


def schema_report(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """``(column_name, declared, ok)``: each declared column against the type ``df`` has; columns that are not declared
    are listed with a NULL declaration and fail."""
    types = dict(df.dtypes)
    rows = [(c, t, types.get(c) == t) for c, t in declared.items()] + [(c, None, False) for c in types if c not in declared]
    parts = [F.struct(F.lit(c).alias("column_name"), F.lit(t).cast("string").alias("declared"), F.lit(ok).alias("ok")) for c, t, ok in rows]
    return df.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def cast_failure_report(raw: DataFrame, spec: Sequence[tuple[str, str, str]], keys: Sequence[str] = (), max_key_failures: int = 0) -> DataFrame:
    """``(column_name, failures, is_key, ok)`` per standardised column: ``ok`` is false where a key column has more
    than ``max_key_failures`` values that did not parse (their rows are rejected, not loaded)."""
    wide = cast_failures(raw, spec)
    rows = F.array(*(F.struct(F.lit(out).alias("column_name"), F.col(out).alias("failures"), F.lit(out in keys).alias("is_key")) for out, _, _ in spec))
    return wide.select(F.explode(rows).alias("r")).select("r.*", (~F.col("r.is_key") | (F.col("r.failures") <= max_key_failures)).alias("ok"))


def settled(reports: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Reports of one layout, worked out in one job: each as a table of its rows (a handful), so that reading it again does not
    read its source again."""
    named = [df.select(F.lit(name).alias("report"), "*") for name, df in reports.items()]
    union = named[0]
    for part in named[1:]:
        union = union.unionByName(part)
    found = union.collect()
    return {name: df.sparkSession.createDataFrame([tuple(r)[1:] for r in found if r["report"] == name], df.schema) for name, df in reports.items()}


def has_key_failures(report: DataFrame) -> bool:
    """Whether a ``cast_failure_report`` counts a key that did not parse (without one there are no rejected rows)."""
    return not report.where("is_key AND failures > 0").isEmpty()


def assert_ok(report: DataFrame, column: str = "ok") -> None:
    """Raise ``QualityError`` if any report row is not ok (collects the report — a handful of rows)."""
    bad = report.filter(~F.col(column)).limit(5).collect()
    if bad:
        raise QualityError(f"data-quality check failed: {[r.asDict() for r in bad]}")


def assert_all_ok(reports: Mapping[str, DataFrame], column: str = "ok") -> None:
    """``assert_ok`` for many reports in one Spark job: their ``(report, ok)`` rows are unioned, so the
    report aggregates run as parallel stages of that job instead of one job each."""
    if not reports:
        return
    parts = [df.select(F.lit(name).alias("report"), F.col(column).alias("ok"), F.to_json(F.struct("*")).alias("row"))
             for name, df in reports.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    bad = union.filter(~F.col("ok")).limit(5).collect()
    if bad:
        raise QualityError(f"data-quality check failed: {[(r['report'], r['row']) for r in bad]}")
