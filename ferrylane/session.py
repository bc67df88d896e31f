"""Session settings the engine relies on, and where it may write scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    # A task that lands ranked rows meets few batches, one after the other, so it can keep their
    # files open instead of sorting; past this many open files Spark sorts what is left.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings: UTC, failing casts, adaptive plans, TIME columns."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only with a local master; on a cluster a
    missing setting is an error, because executors could not see the folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ferrylane-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root."""
    return f"{scratch_root(spark)}/ferrylane/{label}-{uuid.uuid4().hex}"


def column_names(ddl: str) -> list[str]:
    """The column names of a flat DDL text."""
    return [column.split()[0] for column in ddl.split(", ")]


def local_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]], ddl: str) -> DataFrame:
    """A handful of rows as a frame. Arrow hands them to the JVM without a Python worker."""
    if not rows:
        return spark.createDataFrame([], ddl)
    names = column_names(ddl)
    return spark.createDataFrame(pa.Table.from_pylist([{n: row.get(n) for n in names} for row in rows]), ddl)
