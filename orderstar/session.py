"""Session helpers: a local session for tests / bench, and the shared scratch folder.

Scratch data (lineage cuts, staged raw files, table versions written by the registered queries) goes
under the folder the cluster names in ``spark.checkpoint.dir``. Only on a local master, when that is unset,
a temporary folder of the process is used.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: str | None = None


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "orderstar") -> SparkSession:
    """Local session used by tests and ``bench.py`` (never called by library operators)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = None
    try:
        value = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - key unknown to this session
        value = None
    if not value:
        try:
            value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            value = None
    if not value:
        try:
            value = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001
            value = None
    return value or None


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir`` if set.

    A local master has no other machine, so there (tests, bench) a temporary folder of this process serves.
    On a cluster a folder of the driver's machine would lose the executors' files: without
    ``spark.checkpoint.dir`` this raises. The session's settings are never changed.
    """
    root = _configured_checkpoint_dir(spark)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share (master is {master!r})")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="orderstar-scratch-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder (never reused, never deleted here)."""
    return f"{scratch_root(spark)}/orderstar/{name}-{uuid.uuid4().hex[:12]}"
