"""What the operators share: settings, written intermediate tables, free column names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylane.operators.ranking import planned_bytes, ranges_for
from ferrylane.session import configure, scratch_path
from ferrylane.storage import delete, join_path

#: Python workers get rows in batches of at most so many rows and bytes, so that very long texts can't fill them.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings and small Arrow batches."""
    configure(spark)
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


class Workspace:
    """A folder in shared storage for the tables that one call writes and reads back.

    Writing cuts the lineage: what an executor that is lost had worked out need not be worked out again.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = prepare(spark)
        self.path = scratch_path(spark, label)
        self._steps = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._steps += 1
        path = join_path(self.path, f"{self._steps:03d}-{name}")
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._ferrylane_path = path
        return saved

    def drop(self, *saved: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for df in saved:
            delete(self.spark, df._ferrylane_path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(column: str = "text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def ranges_of(df: DataFrame, range_bytes: int = 64 << 20) -> list[int]:
    """To give to ``repartitionByRange`` first: how many ranges of ``range_bytes`` the files read need, where that is more
    than the session's shuffle partitions; nothing else, so that the planner may put small ranges together."""
    wanted = ranges_for(planned_bytes(df), range_bytes) or 0
    return [wanted] if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []


Batches = Iterator[pa.RecordBatch]


def batch_map(rows: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Batches], Batches]:
    """One result batch for each batch."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield rows(batch)

    return run
