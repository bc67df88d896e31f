"""Bloom filters of a bounded size, filled by tasks and merged by segment, ``FAN_IN`` tasks at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylane.llm.common import Batches, free_name

SEGMENT_BITS = 1 << 16
FAN_IN = 64
#: Rows whose bits a task gathers before it hands them on: so many, or a row for so many bits of the filter, so that what it hands
#: on (two bitmaps for each segment met) is not many times larger than the rows.
CHUNK_ROWS, BITS_PER_CHUNK_ROW = 1 << 18, 1 << 6
#: The most that is gathered and broadcast: 32 MB. A fuller filter lets more rows through and loses none.
MAX_BITS = 1 << 28


def filter_bits(rows: int, bits_per_row: int, max_bits: int) -> int:
    """A power of two, one segment at least."""
    wanted = max(SEGMENT_BITS, rows * bits_per_row)
    return min(1 << (wanted - 1).bit_length(), max_bits)


def positions(digests: pa.Array, bits: int) -> np.ndarray:
    """Two bit positions for each digest, shape (rows, 2)."""
    if not len(digests):
        return np.zeros((0, 2), dtype=np.uint64)
    words = np.frombuffer(b"".join(digests.to_pylist()), dtype="<u8").reshape(len(digests), -1)
    return words[:, :2] & np.uint64(bits - 1)


def _pack(local: np.ndarray) -> bytes:
    bitmap = np.zeros(SEGMENT_BITS, dtype=bool)
    bitmap[local] = True
    return np.packbits(bitmap).tobytes()


_BITMAPS = "segment long, part long, seen binary, repeated binary"


def _partial_bitmaps(bits: int):
    """For each segment that a task's rows touch: the bits set, and those set more than once."""
    def emit(chunk: list[np.ndarray]) -> pa.RecordBatch:
        places, counts = np.unique(np.concatenate(chunk).ravel(), return_counts=True)
        segments, starts = np.unique(places // np.uint64(SEGMENT_BITS), return_index=True)
        seen, repeated = [], []
        for start, end in zip(starts, [*starts[1:], len(places)], strict=True):
            local = (places[start:end] % np.uint64(SEGMENT_BITS)).astype(np.int64)
            seen.append(_pack(local))
            repeated.append(_pack(local[counts[start:end] > 1]))
        part = TaskContext.get().partitionId()
        return pa.RecordBatch.from_arrays(
            [pa.array(segments.astype(np.int64)), pa.array([part] * len(segments), pa.int64()), pa.array(seen, pa.binary()), pa.array(repeated, pa.binary())],
            names=["segment", "part", "seen", "repeated"])

    def run(batches: Batches) -> Batches:
        chunk: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                chunk.append(positions(batch.column(0), bits))
            if sum(map(len, chunk)) >= max(CHUNK_ROWS, bits // BITS_PER_CHUNK_ROW):
                yield emit(chunk)
                chunk = []
        if chunk:
            yield emit(chunk)

    return run


def _merge(table: pa.Table) -> pa.Table:
    seen = np.zeros(SEGMENT_BITS // 8, dtype=np.uint8)
    repeated = seen.copy()
    for s, r in zip(table["seen"].to_pylist(), table["repeated"].to_pylist(), strict=True):
        s, r = np.frombuffer(s, dtype=np.uint8), np.frombuffer(r, dtype=np.uint8)
        repeated |= r | (seen & s)
        seen |= s
    return pa.table({"segment": table["segment"][:1], "part": table["part"][:1],
                     "seen": pa.array([seen.tobytes()], pa.binary()), "repeated": pa.array([repeated.tobytes()], pa.binary())})


def filter_of(digests: DataFrame, bits: int, which: str = "seen") -> bytes:
    """The bits that the rows set ("seen"), or that more than one of them sets ("repeated"); ``bits`` / 8 bytes.

    ``digests`` has one column, of 16 random bytes or more.
    """
    parts = digests.mapInArrow(_partial_bitmaps(bits), _BITMAPS)
    left = digests.rdd.getNumPartitions()
    while True:
        # What meets in one group is FAN_IN tasks' bitmaps (and a task has one for each chunk of its rows).
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")).groupBy("segment", "part").applyInArrow(_merge, _BITMAPS)
        left = -(-left // FAN_IN)
        if left <= 1:
            break
    whole = np.zeros(bits // 8, dtype=np.uint8)
    width = SEGMENT_BITS // 8
    for row in parts.select("segment", F.col(which).alias("found")).toLocalIterator():
        whole[row.segment * width:(row.segment + 1) * width] = np.frombuffer(row.found, dtype=np.uint8)
    return whole.tobytes()



def holds(filled: bytes, places: np.ndarray) -> np.ndarray:
    """Whether all bits of each row are set."""
    bitmap = np.frombuffer(filled, dtype=np.uint8)
    p = places.astype(np.int64)
    return ((bitmap[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1).all(axis=1)


def id_digest(column: str) -> Column:
    return F.unhex(F.md5(F.col(column).cast("string")))


class IdFilter:
    """Tells of most rows, where they lie, that their id is not among some ids."""

    def __init__(self, ids: DataFrame, bits_per_id: int = 16, max_bits: int = MAX_BITS):
        known = ids.select(F.col(ids.columns[0]).alias("id")).where("id IS NOT NULL")
        self.bits = filter_bits(known.count(), bits_per_id, max_bits)
        self.shared = ids.sparkSession.sparkContext.broadcast(filter_of(known.select(id_digest("id")), self.bits))

    def may_hold(self, column: str) -> Column:
        bits, shared = self.bits, self.shared

        def look_up(digests: pd.Series) -> pd.Series:
            return pd.Series(holds(shared.value, positions(pa.array(digests, pa.binary()), bits)))

        return F.pandas_udf(look_up, "boolean")(F.coalesce(id_digest(column), F.unhex(F.md5(F.lit("")))))


def without_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose id is not in ``ids``; only rows that the filter can't clear are shuffled."""
    flag, name = free_name(docs, "maybe"), free_name(docs, "drop_id")
    flagged = docs.withColumn(flag, IdFilter(ids).may_hold(column))
    dropped = ids.select(F.col(ids.columns[0]).alias(name))
    checked = flagged.where(F.col(flag)).join(dropped, F.col(column) == F.col(name), "left_anti")
    return flagged.where(~F.col(flag)).unionByName(checked).select(*docs.columns)


def with_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose id is in ``ids``; only rows that the filter lets through are shuffled."""
    flag, name = free_name(docs, "maybe"), free_name(docs, "keep_id")
    wanted = ids.select(F.col(ids.columns[0]).alias(name))
    flagged = docs.withColumn(flag, IdFilter(ids).may_hold(column)).where(F.col(flag))
    return flagged.join(wanted, F.col(column) == F.col(name), "left_semi").select(*docs.columns)
