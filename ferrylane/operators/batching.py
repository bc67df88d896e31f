"""Cutting ranked rows into batches, and picking up where a run stopped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylane import schemas as S
from ferrylane.functions.keys import after_key, columns, key_to_json, scan_filter
from ferrylane.operators.ranking import RANK

BATCH = "batch_index"


def batch_of(size: int, first_index: int = 0, rank: str = RANK) -> Column:
    """The batch of a rank: every batch is full but the last."""
    return (F.lit(first_index) + F.expr(f"({rank} - 1) div {int(size)}")).cast("bigint")


def assign_batches(ranked: DataFrame, size: int, first_index: int = 0) -> DataFrame:
    """Add ``batch_index`` to ranked rows. A projection; nothing moves."""
    return ranked.withColumn(BATCH, batch_of(size, first_index))


def batch_edges(ranked: DataFrame, keys: Sequence[str], total: int, size: int, first_index: int = 0) -> DataFrame:
    """(batch_index, rows, first_key, last_key) per batch.

    Ranks say which rows open and close a batch, and how many lie between, so
    only those two rows per batch leave the scan.
    """
    place = (F.col(RANK) - 1) % size
    opens = place == 0
    closes = (place == size - 1) | (F.col(RANK) == total)
    key = F.struct(*columns(keys))
    edges = ranked.where(opens | closes).select(
        batch_of(size, first_index).alias(BATCH),
        F.when(closes, place + 1).alias("rows"),
        F.when(opens, key).alias("first_key"),
        F.when(closes, key).alias("last_key"),
    )
    return edges.groupBy(BATCH).agg(
        F.max("rows").alias("rows"), F.max("first_key").alias("first_key"), F.max("last_key").alias("last_key")
    )


def commit_groups(edges: DataFrame, per_commit: int, first_index: int = 0) -> DataFrame:
    """Fold consecutive batches into groups that are merged and committed together."""
    group = F.expr(f"({BATCH} - {int(first_index)}) div {int(per_commit)}")
    first, last = key_to_json("first_key"), key_to_json("last_key")
    described = edges.select(group.alias("commit"), BATCH, "rows", first.alias("first_pk"), last.alias("last_pk"))
    return described.groupBy("commit").agg(
        F.min(BATCH).alias("first_batch"),
        F.max(BATCH).alias("last_batch"),
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("batches"),
        F.min_by("first_pk", BATCH).alias("first_pk_json"),
        F.max_by("last_pk", BATCH).alias("last_pk_json"),
    )


def key_page(
    df: DataFrame,
    keys: Sequence[str],
    size: int,
    last: Mapping[str, Any] | None = None,
    cutoff: Any = None,
    cutoff_column: str = "updatedAt",
) -> DataFrame:
    """One page in key order: the first ``size`` rows after ``last``, up to the cutoff."""
    wanted = scan_filter(df.schema, keys, last, cutoff, cutoff_column)
    rows = df if wanted is None else df.where(wanted)
    return rows.orderBy(*columns(keys)).limit(size)


def rows_after(df: DataFrame, keys: Sequence[str], last: Mapping[str, Any] | None) -> DataFrame:
    wanted = after_key(df.schema, keys, last)
    return df if wanted is None else df.where(wanted)


def with_resume_point(latest: DataFrame) -> DataFrame:
    """From latest checkpoints to where the next run starts.

    No checkpoint or a completed one starts over; anything else continues after
    the last committed key, at the next batch index (index 0 counts as an index).
    """
    resumed = F.coalesce(F.col("status") != S.COMPLETED, F.lit(False))
    next_index = F.coalesce("last_batch_index", F.lit(-1)) + 1
    return latest.withColumns({
        "is_resumed": resumed,
        "resume_after_json": F.when(resumed, F.col("last_pk_json")),
        "next_batch_index": F.when(resumed, next_index).otherwise(F.lit(0)).cast("bigint"),
    })
