"""Landing batches as Parquet, and checking that what was read has arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane import schemas as S
from ferrylane import storage
from ferrylane.functions import keys as K
from ferrylane.operators.batching import BATCH
from ferrylane.storage import VersionedTable


class LandingMismatch(RuntimeError):
    """A batch is missing from the landing area, or does not hold the rows read."""


def land(
    batched: DataFrame, path: str, keys: Sequence[str] = (), whole: bool = False, clustered: bool = True
) -> str:
    """Write ``batch_index=`` partitions under ``path``, Snappy-compressed.

    Batches that are written replace those already there; others stay, unless
    ``whole`` replaces everything. Ranked rows already lie batch by batch and in
    key order, so they are written where they are: no shuffle and no sort. For
    rows in any order pass ``clustered=False``: the write is rebalanced, so that a
    batch fills few files and an outsized one is split, and sorted by ``keys``.
    """
    if not clustered:
        batched = batched.hint("rebalance", BATCH).sortWithinPartitions(BATCH, *K.columns(keys))
    (
        batched.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", "snappy")
        .partitionBy(BATCH)
        .parquet(path)
    )
    return path


def read_landed(spark: SparkSession, path: str, schema: T.StructType, batches: range | None = None) -> DataFrame:
    """Landed rows with their batch index. With ``batches`` only their folders are listed, and each has to be there."""
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
    if batches is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(*[storage.join_path(path, f"{BATCH}={index}") for index in batches])


def batch_counts(batched: DataFrame) -> DataFrame:
    """(batch_index, rows). Over a landing area this reads file footers only."""
    return batched.groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"))


def reconcile(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Compare (batch_index, rows) frames: ``ok``, ``missing``, ``short`` or ``unexpected``."""
    e = expected.select(BATCH, F.col("rows").alias("rows_expected"))
    a = landed.select(BATCH, F.col("rows").alias("rows_landed"))
    state = (
        F.when(F.col("rows_landed").isNull(), "missing")
        .when(F.col("rows_expected").isNull(), "unexpected")
        .when(F.col("rows_landed") < F.col("rows_expected"), "short")
        .when(F.col("rows_landed") > F.col("rows_expected"), "unexpected")
        .otherwise("ok")
    )
    return e.join(a, BATCH, "full_outer").withColumn("state", state)


def require_landed(reconciled: DataFrame) -> None:
    """Raise unless every batch is ``ok``; the message names the first few that are not."""
    bad = reconciled.where(F.col("state") != "ok")
    shown = bad.orderBy(BATCH).take(5)
    if shown:
        listed = "; ".join(
            f"batch {r[BATCH]} {r['state']} ({r['rows_landed']} of {r['rows_expected']} rows)" for r in shown
        )
        raise LandingMismatch(f"{bad.count()} batch(es) did not land: {listed}")


class LandingArea:
    """A table's landed batches, and a manifest of those that were found complete.

    The manifest (batch_index, rows, run_id) lies in the area itself, under a name that scans pass over,
    so that emptying the area empties it too. It is replaced only once the whole area has been reconciled.
    """

    MANIFEST = "batch_index bigint, rows bigint, run_id string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._manifest = VersionedTable(spark, storage.join_path(path, "_manifest"))

    def manifest(self) -> DataFrame:
        """The batches known to be complete; none before the first run."""
        if not self._manifest.exists():
            return self.spark.createDataFrame([], self.MANIFEST)
        return self._manifest.read(self.MANIFEST)

    def holds(self, first: int) -> bool:
        """Whether every batch before ``first`` is in the manifest."""
        return self.manifest().where(F.col(BATCH).between(0, first - 1)).count() == first

    def write(self, batched: DataFrame | None, first: int) -> None:
        """Land a run that starts at batch ``first``: earlier batches stay, later ones of an earlier run go.

        Without rows (None) the area keeps the earlier batches alone.
        """
        if batched is not None:
            land(batched, self.path, whole=first == 0)

    def verify(self, expected: DataFrame, schema: T.StructType, first: int, run_id: str) -> None:
        """Reconcile the whole area with what this run wrote (batch_index, rows) and the earlier batches in the manifest.

        Batches that neither knows are removed first: an earlier run that was cut otherwise left them.
        What is found complete becomes the manifest.
        """
        earlier = self.manifest().where(F.col(BATCH) < first)
        wanted = earlier.unionByName(expected.select(F.col(BATCH).cast("bigint"), F.col("rows").cast("bigint"), F.lit(run_id).alias("run_id")))
        low, high = wanted.agg(F.min(BATCH), F.max(BATCH)).first()
        self._remove_others(low, high)
        if low is not None:
            require_landed(reconcile(wanted.select(BATCH, "rows"), batch_counts(read_landed(self.spark, self.path, schema))))
        self._manifest.replace(wanted.coalesce(1))

    def _remove_others(self, low: int | None, high: int | None) -> None:
        """Batches of a run are numbered without gaps, so those of no run lie outside a range."""
        for name in storage.folders(self.spark, self.path):
            if name.startswith(f"{BATCH}="):
                index = name.partition("=")[2]
                if low is None or not index.isdigit() or not low <= int(index) <= high:
                    storage.delete(self.spark, storage.join_path(self.path, name))


def strip_column(spark: SparkSession, path: str, column: str, cleaned_path: str) -> str:
    """Write the landed batches without one column, and return where they now are.

    The files being read stay as they are; the caller publishes the new path.
    When the column is not there the old path is returned.
    """
    if not storage.exists(spark, path):
        raise FileNotFoundError(f"cannot strip {column!r}: {path} does not exist")
    landed = spark.read.parquet(path)
    if column not in landed.columns:
        return path
    return land(landed.drop(column), cleaned_path, whole=True)


def transfer_accounting(manifest: DataFrame) -> DataFrame:
    """Per table: objects found, copied, skipped and failed, errors by code, and the verdict.

    SUCCESS needs every found object copied or skipped, none failed and no
    error; anything else is PARTIAL_FAILURE. Counts are summed up before they are
    shuffled, however many objects a table has; error samples come from a second
    look at just the objects with an error.
    """
    table = ["schema_name", "table_name"]
    totals = manifest.groupBy(*table).agg(
        *[F.count_if(F.col("state") == s).alias(f"objects_{s}") for s in ("found", "copied", "skipped", "failed")]
    )
    by_code = manifest.where(F.col("error_code").isNotNull()).groupBy(*table, "error_code").agg(
        F.count(F.lit(1)).alias("count"), F.min("error_detail").alias("sample_detail")
    )
    errors = by_code.groupBy(*table).agg(
        F.array_sort(F.collect_list(F.struct("error_code", "count", "sample_detail"))).alias("errors")
    )
    no_errors = F.array().cast(errors.schema["errors"].dataType)
    accounts = totals.join(errors, table, "left").withColumn("errors", F.coalesce("errors", no_errors))
    accounted = (
        (F.col("objects_copied") + F.col("objects_skipped") >= F.col("objects_found"))
        & (F.col("objects_failed") == 0)
        & (F.size("errors") == 0)
    )
    return accounts.withColumn("status", F.when(accounted, S.SUCCESS).otherwise(S.PARTIAL_FAILURE))
