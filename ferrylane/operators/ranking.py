"""Exact row positions by key, worked out without gathering rows in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ferrylane import storage
from ferrylane.functions.keys import columns

RANK = "__row_rank"
_SLOT = "__slot"
_TIE = "__tie"
_SLICE = "__slice"
_START = "__start"
_INDEX_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits
_MAX_BROADCAST_SLICES = 2_000_000
# Bytes of input that one range, and so one sorting task, is meant to hold.
RANGE_BYTES = 128 * 1024 * 1024
# An input of fewer ranges than the cluster has cores is cut finer, down to this.
LEAST_RANGE_BYTES = 16 * 1024 * 1024
# Spark's names of plan nodes that can give more rows than they take.
MULTIPLYING = ("Join", "Generate", "Expand", "Window", "MapInArrow", "MapInPandas", "FlatMapGroupsInArrow", "FlatMapGroupsInPandas")
KEEPING = ("LeftSemi", "LeftAnti")


class Ranked:
    """Rows written once in slices, and the position at which each slice starts.

    ``frame`` has the rows plus ``RANK`` (1..rows). It can be read any number
    of times, by any executor, and always gives a row the same rank.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._data = storage.join_path(path, "rows")
        self._starts = storage.join_path(path, "slices")

    def is_complete(self) -> bool:
        return storage.committed(self.spark, self._starts)

    def drop(self) -> None:
        storage.delete(self.spark, self.path)

    @cached_property
    def _totals(self) -> Row:
        starts = self.spark.read.parquet(self._starts)
        return starts.agg(F.count(F.lit(1)).alias("slices"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()

    @property
    def rows(self) -> int:
        return self._totals["rows"]

    @property
    def frame(self) -> DataFrame:
        starts = self.spark.read.parquet(self._starts).select(_SLICE, _START)
        # One small row per written slice. Beyond the limit Spark picks the join itself.
        if self._totals["slices"] <= _MAX_BROADCAST_SLICES:
            starts = F.broadcast(starts)
        rows = self.spark.read.parquet(self._data)
        position = F.col(_SLOT).bitwiseAND((1 << _INDEX_BITS) - 1)
        placed = rows.withColumn(_SLICE, _slice_of(F.col(_SLOT))).join(starts, _SLICE)
        return placed.select(
            *columns(c for c in rows.columns if c != _SLOT),
            (F.col(_START) + position + 1).alias(RANK),
        )

    def _write(self, ordered: DataFrame) -> "Ranked":
        # Starts left by an earlier copy must not be taken for those of this one.
        storage.delete(self.spark, self._starts)
        slotted = ordered.withColumn(_SLOT, F.monotonically_increasing_id())
        slotted.drop(_TIE).write.mode("overwrite").options(**storage.MARKED).parquet(self._data)
        sizes = (
            self.spark.read.parquet(self._data)
            .groupBy(_slice_of(F.col(_SLOT)).alias(_SLICE))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        # The running total is over slices, not rows: as many rows as there were tasks.
        before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.withColumn(_START, F.coalesce(F.sum("rows").over(before), F.lit(0)))
        starts.coalesce(1).write.mode("overwrite").options(**storage.MARKED).parquet(self._starts)
        return self


def _slice_of(slot: Column) -> Column:
    return F.shiftright(slot, _INDEX_BITS)


def ranges_for(input_bytes: int | None, range_bytes: int = RANGE_BYTES, cores: int = 1) -> int | None:
    """How many ranges hold that many bytes, with work for all ``cores``; None, the session's default, when they are not known."""
    if input_bytes is None:
        return None
    return max(1, -(-input_bytes // range_bytes), min(cores, -(-input_bytes // min(range_bytes, LEAST_RANGE_BYTES))))


def planned_bytes(df: DataFrame) -> int | None:
    """The bytes of the files and tables that a frame reads. None where that does not bound what it gives:
    a source of unknown size, or a plan that may multiply rows, such as a join."""
    total, plans = 0, [df._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName() in MULTIPLYING and not (plan.nodeName() == "Join" and plan.joinType().toString() in KEEPING):
            return None
        children = plan.children()
        if children.isEmpty():
            size = int(plan.stats().sizeInBytes())
            if size >= 1 << 60:  # what Spark says when it does not know
                return None
            total += size
        plans += [children.apply(i) for i in range(children.size())]
    return total


def rank_by_key(
    df: DataFrame, keys: Sequence[str], path: str, ties: bool = False, already_ranged: bool = False,
    ranges: int | None = None,
) -> Ranked:
    """Rank rows by key: range partition, sort each range, write, then add up range sizes.

    The sorted rows are written before they are counted, because range bounds are
    sampled and a second evaluation could cut the ranges elsewhere. Only the
    written copy is read afterwards.

    With ``ties`` the keys may repeat: equal keys are spread over ranges by their
    place in the input, so one key with very many rows does not fill one task.
    The input's order must then be stable, as that of a file scan is.
    ``ranges`` is how many ranges are cut, by default as many as the session has shuffle
    partitions. ``already_ranged`` says that the partitions of ``df`` are ascending key
    ranges, as from a range-partitioned source scan; then nothing is shuffled.
    """
    spark = df.sparkSession
    order = columns(keys)
    if ties:
        df, order = df.withColumn(_TIE, F.monotonically_increasing_id()), [*order, F.col(_TIE)]
    ranged = df if already_ranged else df.repartitionByRange(*([ranges] if ranges else []), *order)
    return Ranked(spark, path)._write(ranged.sortWithinPartitions(*order))


def number_rows(df: DataFrame, path: str) -> Ranked:
    """Number rows 1..N in no particular order, with neither shuffle nor sort.

    The order is whatever the scan gave; what matters is that it is written down.
    """
    return Ranked(df.sparkSession, path)._write(df)
