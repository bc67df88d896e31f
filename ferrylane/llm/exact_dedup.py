"""Exact dedup in two Bloom passes: only rows whose digest may repeat are shuffled.

Texts are equal when identical after lower-casing A-Z. The first pass sets two bits per row, hashed from the
SHA-256 of its text, and keeps the bits that more than one row has set. The second pass looks each row up: a
row with a bit of its own has no equal and passes straight through; the rest are grouped by digest.

The filter has ``bits_per_row`` bits a row and at most ``max_bits``: a fixed bound on what is gathered and
broadcast. More rows than that are split by ranges of their digests' hash, with a filter for each range, one after the other
over the written digests, so that filters never fill up. ``deduplicate`` then carries the digests that did repeat past the
texts as one more filter; should there be more of them than it has room for, more texts are shuffled, and the result is the
same. Hot groups are pre-aggregated. Texts are hashed whole, however long.

A null text counts as empty; empty texts equal each other. Of equal texts the row with the largest doc_id
stays (a null doc_id is the smallest). Rows that repeat text and doc_id count as rows of the group; ``deduplicate``
leaves one of them. Empty tables give empty results; other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane.llm.bloom import filter_bits, filter_of, holds, positions
from ferrylane.llm.common import Workspace, batch_map, free_name

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def digest_of(text: str | None) -> bytes:
    return hashlib.sha256((text or "").encode().translate(LOWER)).digest()


def with_digest(docs: DataFrame, text: str, into: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the digest of the text as ``into``."""
    read = docs.select(*[F.col(c) for c in keep], F.col(text).alias(free_name(docs, "_text")))
    schema = T.StructType([*read.schema.fields[:-1], T.StructField(into, T.BinaryType())])

    def digests(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = pa.array([digest_of(t) for t in batch.column(len(keep)).to_pylist()], pa.binary())
        kept = [batch.schema.field(i) for i in range(len(keep))]
        return pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], column], schema=pa.schema([*kept, pa.field(into, pa.binary())]))

    return read.mapInArrow(batch_map(digests), schema)


def _flag(at: int, bits: int, shared):
    """Adds whether a row's digest may repeat."""
    def flags(batch: pa.RecordBatch) -> pa.RecordBatch:
        maybe = pa.array(holds(shared.value, positions(batch.column(at), bits)))
        return pa.RecordBatch.from_arrays([*batch.columns, maybe], names=[*batch.schema.names, "maybe"])

    return batch_map(flags)


def _ranges(keyed: DataFrame, bits_per_row: int, max_bits: int) -> Iterator[tuple[DataFrame, int, Broadcast]]:
    """The rows of ``keyed`` (with a digest) in as many parts as filters need, each with its filter of repeated bits."""
    rows = keyed.count()
    parts = max(1, -(-rows * bits_per_row // max_bits))
    bits = filter_bits(-(-rows // parts), bits_per_row, max_bits)
    for part in range(parts):
        own = keyed if parts == 1 else keyed.where(F.pmod(F.xxhash64("digest"), F.lit(parts)) == part)
        yield own, bits, keyed.sparkSession.sparkContext.broadcast(filter_of(own.select("digest"), bits, "repeated"))


def _possible_repeats(ws: Workspace, keyed: DataFrame, bits_per_row: int, max_bits: int) -> DataFrame:
    """``keyed`` (digest last) with the column ``maybe``."""
    schema = T.StructType([*keyed.schema.fields, T.StructField("maybe", T.BooleanType())])
    flagged = [ws.save(own.mapInArrow(_flag(len(keyed.columns) - 1, bits, shared), schema), "flagged")
               for own, bits, shared in _ranges(keyed, bits_per_row, max_bits)]
    return reduce(DataFrame.unionByName, flagged)


def equal_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits_per_row: int = 16, max_bits: int = 1 << 28) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest."""
    ws = Workspace(docs.sparkSession, "exact-dedup")
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keyed = ws.save(with_digest(read, "text", "digest", ["doc_id"]), "digests")
    flagged = _possible_repeats(ws, keyed, bits_per_row, max_bits)
    alone = flagged.where(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    maybe = flagged.where("maybe").select("doc_id", "digest")
    groups = ws.save(maybe.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    ws.drop(keyed)
    grouped = maybe.join(groups, "digest").select("doc_id", "keep_id", "group_size", "digest")
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits_per_row: int = 16, max_bits: int = 1 << 28) -> DataFrame:
    """``docs`` with one row for each text. Rows without an equal are never shuffled."""
    ws = Workspace(docs.sparkSession, "exact-dedup")
    columns, digest = docs.columns, free_name(docs, "digest")
    digests = ws.save(with_digest(docs, text, "digest", [doc_id]), "digests")
    # Digests that do repeat, and the row of each that stays.
    schema, keep_id, found, filters = T.StructType([*digests.schema.fields, T.StructField("maybe", T.BooleanType())]), free_name(docs, "keep_id"), [], []
    for own, bits, shared in _ranges(digests, bits_per_row, max_bits):
        maybe = own.mapInArrow(_flag(1, bits, shared), schema).where("maybe")
        groups = maybe.groupBy("digest").agg(F.max(doc_id).alias("keep_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
        found.append(ws.save(groups.select(F.col("digest").alias(digest), F.col("keep_id").alias(keep_id)), "groups"))
        filters.append((bits, shared))
    groups = reduce(DataFrame.unionByName, found)
    bits, shared = filters[0]
    if len(filters) > 1:
        bits = filter_bits(groups.count(), bits_per_row, max_bits)
        shared = ws.spark.sparkContext.broadcast(filter_of(groups.select(digest), bits))

    flagged = _carry(docs, text, digest, bits, shared)
    alone = flagged.where(F.col(digest).isNull()).select(*columns)
    repeated = flagged.where(F.col(digest).isNotNull())
    joined = repeated.join(groups, digest, "left")
    stays = joined.where(F.col(keep_id).eqNullSafe(F.col(doc_id)) | F.col(keep_id).isNull())
    return alone.unionByName(stays.dropDuplicates([digest]).select(*columns))


def _carry(docs: DataFrame, text: str, digest: str, bits: int, shared) -> DataFrame:
    """``docs`` with the digest of those texts that may repeat, and null for the others."""
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(digest, T.BinaryType())])

    def carry(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests = [digest_of(t) for t in batch.column(at).to_pylist()]
        maybe = holds(shared.value, positions(pa.array(digests, pa.binary()), bits))
        digests = pa.array([d if m else None for d, m in zip(digests, maybe, strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, digests], schema=pa.schema([*batch.schema, pa.field(digest, pa.binary())]))

    return docs.mapInArrow(batch_map(carry), schema)


def text_classes(docs: DataFrame) -> DataFrame:
    """The rows of ``equal_texts`` with the digest in hex."""
    return equal_texts(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


EQUAL_TEXTS_SQL = """
WITH folded AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM folded
"""
