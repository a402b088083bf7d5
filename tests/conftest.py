"""Shared fixtures: one local Spark session for the whole run, with a scratch checkpoint folder.

The library reads ``spark.checkpoint.dir`` from the session; only here (tests) is one created, because
the local session has none.
"""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from orderstar.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="orderstar-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderstar-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder under the session's scratch folder."""
    from orderstar.session import scratch_path

    return scratch_path(spark, "test")


def rows(df, *order):
    """Collected rows as dicts, sorted by ``order`` columns (NULLs first)."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[c] is not None, r[c]) for c in order))
    return out
