"""Raw file readers (CSV, parquet) and bronze audit columns.

* CSV columns are read as strings (no ``inferSchema`` pass over the data); typing happens in standardisation with
  ``try_cast``. Spark maps CSV columns by position, so every file's header is checked against the schema
  (``enforceSchema=false``): a file with other or reordered columns fails the read instead of swapping values. ``schema=`` gives an explicit schema (also no pass);
  ``infer_schema=True`` restores inference when wanted.
* Many files: ``recursiveFileLookup`` + ``pathGlobFilter`` read every matching file at any depth (a
  ``**`` inside a Hadoop glob only spans one level).
* A read that matches no file raises ``FileNotFoundError`` (Spark cannot take a header from nothing, on any
  Hadoop file system; no list of paths is built in the driver, no local ``os.path`` checks).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderstar.functions.calendar import as_timestamp_literal


def _no_files(path: str, pattern: str | None = None) -> FileNotFoundError:
    where = f"{path} (files matching {pattern!r})" if pattern else path
    return FileNotFoundError(f"no input files found: {where}")


def _reader(spark: SparkSession, infer_schema: bool, schema: StructType | str | None, options: dict):
    r = spark.read.option("header", True).option("enforceSchema", False).options(**options)
    # an explicit schema needs no pass over the data; otherwise strings, or inference when asked
    return r.schema(schema) if schema is not None else r.option("inferSchema", infer_schema)


def _load(spark: SparkSession, path: str, infer_schema: bool, schema, options: dict, pattern: str | None = None) -> DataFrame:
    try:
        if schema is not None:
            # with a schema Spark accepts an empty match: taking the first file's header shows that there is one
            _reader(spark, False, None, options).csv(path)
        return _reader(spark, infer_schema, schema, options).csv(path)
    except AnalysisException as e:
        if any(s in (e.getCondition() or "") for s in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise _no_files(path, pattern) from e
        raise


def read_csv(
    spark: SparkSession, path: str, infer_schema: bool = False, schema: StructType | str | None = None, **options
) -> DataFrame:
    """One CSV file (or directory) with a header row."""
    return _load(spark, path, infer_schema, schema, options)


def read_csv_tree(
    spark: SparkSession,
    root: str,
    file_pattern: str,
    infer_schema: bool = False,
    schema: StructType | str | None = None,
    **options,
) -> DataFrame:
    """Every CSV under ``root`` (any depth) whose file name matches ``file_pattern``, e.g.
    ``"*orders_header*.csv"``; all of them need the same header."""
    tree = {"recursiveFileLookup": True, "pathGlobFilter": file_pattern}
    return _load(spark, root, infer_schema, schema, options | tree, file_pattern)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table (hive partition columns are discovered and typed, e.g. ``period`` as int)."""
    return spark.read.parquet(path)


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """The values of an integer partition column, from the folder names alone (none where the path does not exist). The table's
    layout bounds them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = (s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())
    return sorted(int(n.split("=", 1)[1]) for n in names if re.fullmatch(rf"{re.escape(column)}=-?[0-9]+", n))


def path_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Number, bytes and latest modification time of the files of a table (a file, or a folder of files): tells whether it was
    written anew."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return 0, 0, 0
    found = [s for s in files.listStatus(place) if s.isFile()]
    return len(found), sum(s.getLen() for s in found), max((s.getModificationTime() for s in found), default=0)


def with_audit_columns(
    df: DataFrame,
    now: dt.datetime | str | Column | None = None,
    ingestion_column: str = "ingestion_timestamp",
    source_column: str = "source_file",
) -> DataFrame:
    """Add the load time and the file each row came from (``_metadata.file_path``)."""
    return df.withColumn(ingestion_column, as_timestamp_literal(now)).withColumn(
        source_column, F.col("_metadata.file_path")
    )


def ingest_csv(
    spark: SparkSession,
    path: str,
    file_pattern: str | None = None,
    now: dt.datetime | str | Column | None = None,
    infer_schema: bool = False,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Bronze ingest: CSV file (or every matching file under a folder) plus audit columns."""
    raw = (
        read_csv_tree(spark, path, file_pattern, infer_schema, schema)
        if file_pattern
        else read_csv(spark, path, infer_schema, schema)
    )
    return with_audit_columns(raw, now)
