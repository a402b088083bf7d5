"""Sources and sinks: raw CSV / parquet readers, audit columns, parquet writers, fixture adapter."""

from orderstar.sources.files import (
    ingest_csv,
    read_csv,
    read_csv_tree,
    read_parquet,
    with_audit_columns,
)
from orderstar.sources.writers import MAX_RECORDS_PER_FILE, write_partitioned, write_table

__all__ = [
    "MAX_RECORDS_PER_FILE",
    "ingest_csv",
    "read_csv",
    "read_csv_tree",
    "read_parquet",
    "with_audit_columns",
    "write_partitioned",
    "write_table",
]
