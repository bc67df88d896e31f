"""Insert-only merge: add the rows whose key the target does not have."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane import storage
from ferrylane.functions.keys import column, columns, typed_literal
from ferrylane.session import scratch_path
from ferrylane.storage import VersionedTable

# Keys are broadcast only when counted and found to be no larger than this.
BROADCAST_BYTES = 64 * 1024 * 1024


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [column(k).isNotNull() for k in keys])


def known_keys(target: DataFrame, keys: Sequence[str], key_range: tuple | None) -> DataFrame:
    """The keys of the target that staged rows can match: those without a NULL, in the range of the leading key."""
    known = target.select(*columns(keys)).where(_all_present(keys))
    if key_range is None:
        return known
    lead, kind = keys[0], target.schema[keys[0]].dataType
    low, high = (typed_literal(bound, kind) for bound in key_range)
    return known.where((column(lead) >= low) & (column(lead) <= high))


def counted_bytes(schema: T.StructType) -> Column:
    """How much memory rows hold, counted rather than estimated; 0 when there are none."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column(field.name)), F.lit(0)) + 16
        return F.lit(16)

    return F.coalesce(F.sum(reduce(Column.__add__, map(width, schema.fields)).cast("bigint")), F.lit(0))


def _key_bytes(keys: DataFrame) -> int:
    return keys.agg(counted_bytes(keys.schema)).first()[0]


def new_rows(
    staging: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    unique: bool = False,
    key_range: tuple[Any, Any] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    scratch: str | None = None,
) -> DataFrame:
    """The staged rows whose key is not in the target. A NULL in a key never matches.

    Only the key columns of the target are read, and with ``key_range`` (the
    smallest and largest leading key staged) only the row groups that overlap it:
    key-ordered batches then cost about as much as they hold, however large the
    target has grown. The keys found there decide how the rest is done:

    * none: every row is new, and nothing is joined or shuffled;
    * few enough to broadcast: an anti-join where the staged rows lie;
    * more: the absent keys are worked out from key columns alone and written to
      ``scratch``, and the rows are picked by them, again by broadcast if they are
      few. Whole rows are shuffled only when both are many.

    ``unique`` promises keys without NULLs and repeats, as under a primary key.
    Without it rows with a NULL key are passed by the joins, which would gather
    them in one task; repeated keys are collapsed before they are shuffled; and
    what is left of a key with very many rows is a plain join of scanned tables,
    which the adaptive planner splits.
    """
    spark, known = staging.sparkSession, known_keys(target, keys, key_range)
    size = _key_bytes(known)
    if size == 0:
        return staging
    keyed = staging if unique else staging.where(_all_present(keys))
    if size <= broadcast_bytes:
        fresh = keyed.join(F.broadcast(known), list(keys), "left_anti")
    else:
        absent = _absent_keys(keyed.select(*columns(keys)), known, keys, unique, scratch or scratch_path(spark, "keys"))
        if _key_bytes(absent) <= broadcast_bytes:
            # Few rows out of many tasks: put them together instead of writing a file each.
            fresh = keyed.join(F.broadcast(absent), list(keys), "left_semi").hint("rebalance")
        else:
            fresh = keyed.join(absent, list(keys), "left_semi")
    fresh = fresh.select(*columns(staging.columns))
    return fresh if unique else fresh.unionByName(staging.where(~_all_present(keys)))


def _absent_keys(staged: DataFrame, known: DataFrame, keys: Sequence[str], unique: bool, path: str) -> DataFrame:
    """Staged keys that are not known, written to ``path`` and read back."""
    if not unique:
        staged, known = staged.distinct(), known.distinct()
    staged.join(known, list(keys), "left_anti").write.mode("overwrite").parquet(path)
    return staged.sparkSession.read.parquet(path)


def union_new_rows(staging: DataFrame, target: DataFrame, keys: Sequence[str], **options: Any) -> DataFrame:
    """The target after the merge, without writing it. A bag union: nothing is deduplicated."""
    return target.unionByName(new_rows(staging, target, keys, **options))


def read_for(table: VersionedTable, schema: T.StructType, keys: Sequence[str], key_range: tuple[Any, Any] | None) -> DataFrame:
    """The target as far as keys of the range need it: files whose own range lies elsewhere are not opened."""
    if key_range is None or any(bound is None for bound in key_range):
        return table.read(schema)
    low, high = (typed_literal(bound, schema[keys[0]].dataType) for bound in key_range)
    return table.read_within(schema, keys[0], low, high)


def merge_into(table: VersionedTable, staging: DataFrame, keys: Sequence[str], all_new: bool = False, **options: Any) -> int:
    """Append the new rows to the table and return how many there were.

    If the append dies, the next merge of the same rows adds just those missing. ``all_new`` says that the caller has
    looked already and the table holds none of their keys.
    """
    if not keys:
        raise ValueError(f"{table.path} has no key to merge on")
    inserted, rows, scratch = Observation(), staging, None
    if not all_new:
        target, scratch = read_for(table, staging.schema, keys, options.get("key_range")), scratch_path(table.spark, "keys")
        rows = new_rows(staging, target, keys, scratch=scratch, **options)
    table.append(rows.observe(inserted, F.count(F.lit(1)).alias("rows")))
    if scratch is not None:
        storage.delete(table.spark, scratch)
    return inserted.get["rows"]


def drop_target_column(table: VersionedTable, column: str) -> bool:
    """Drop ``column`` from what the table shows, without writing a data file; False when it was not there."""
    if not table.has_column(column):
        return False
    table.hide_column(column)
    return True


def with_target_column(table: VersionedTable, column: str, data_type: T.DataType = T.LongType()) -> DataFrame:
    """The table with ``column``, NULL in rows written without it.

    Files without the column read as NULL, so bringing it back rewrites nothing.
    """
    schema = table.read().schema
    return table.read(schema if column in schema.names else schema.add(column, data_type))


def key_bounds(first: Mapping[str, Any], last: Mapping[str, Any], keys: Sequence[str]) -> tuple[Any, Any]:
    """The leading key's range in a run of key-ordered batches."""
    return first[keys[0]], last[keys[0]]
