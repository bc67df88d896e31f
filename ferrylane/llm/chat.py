"""Chat formatting: logged snapshots of growing conversations collapse to the longest, which is rendered.

A log may hold a conversation again each time it grew. Every turn gets a rolling hash of the turns up to it;
a conversation whose whole hash is met inside a longer one is a prefix of it. Equal conversations are one, named by the
smallest conv_id; an anti-join with all inner prefixes leaves the maximal ones.

Turns are dealt by ranges of (conv_id, turn, role, text), so a conversation may lie on many partitions: each scans its part,
and what the earlier parts add up to (one row for each partition) is put in front. No window and no group holds a whole
conversation; rendered text comes in parts of at most ``TURNS_PER_PART`` turns.

Turns are ordered by turn (null first), then role, then text. A null role or text counts as empty. Rows that repeat all four
columns count once. Rows without a conv_id belong to no conversation and are left out. Other columns are ignored.
Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylane.llm.common import Batches, Workspace, ranges_of, text_of

TURNS_PER_PART = 64
#: The rolling hash of turns h1, h2, ... is the sum of h(i) * RADIX ** i, modulo a Mersenne prime.
MODULUS = 2**127 - 1
RADIX = int.from_bytes(hashlib.sha256(b"turns").digest()[:15], "big")


def turn_hash(role: str, text: str) -> int:
    digest = hashlib.blake2b(role.encode(), digest_size=16)
    digest.update(len(role).to_bytes(8, "big") + text.encode())
    return int.from_bytes(digest.digest(), "big") % MODULUS


_SCANNED = "part long, opening boolean, conv_id long, place long, sum binary, role string, text string"


def _scan(batches: Batches) -> Batches:
    """Number and sum up the turns of each conversation as far as they lie in this partition.

    ``opening`` tells that earlier partitions may hold turns of the same conversation."""
    part = TaskContext.get().partitionId()
    opening, current, place, total, power = True, None, 0, 0, 1
    for batch in batches:
        openings, places, sums = [], [], []
        rows = zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
        for conv_id, role, text in rows:
            if conv_id != current:
                opening = current is None
                current, place, total, power = conv_id, 0, 0, 1
            place, power = place + 1, power * RADIX % MODULUS
            total = (total + turn_hash(role, text) * power) % MODULUS
            openings.append(opening)
            places.append(place)
            sums.append(total.to_bytes(16, "big"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * batch.num_rows, pa.int64()), pa.array(openings, pa.bool_()), batch.column(0), pa.array(places, pa.int64()),
             pa.array(sums, pa.binary()), batch.column(1), batch.column(2)],
            names=["part", "opening", "conv_id", "place", "sum", "role", "text"])


def _before(scanned: DataFrame) -> dict[int, tuple[int, int]]:
    """For each partition, turns and sum that earlier ones hold of its first conversation. One row each is gathered."""
    ends = scanned.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place", "sum")).alias("last"))
    before, held = {}, (None, 0, 0)
    for row in sorted(ends.collect(), key=lambda r: r.part):
        conv_id, place, total = row.last.conv_id, row.last.place, int.from_bytes(row.last.sum, "big")
        earlier = held[1:] if held[0] == row.first else (0, 0)
        if earlier[0]:
            before[row.part] = earlier
        if row.first == conv_id:
            place, total = earlier[0] + place, (earlier[1] + total * pow(RADIX, earlier[0], MODULUS)) % MODULUS
        held = (conv_id, place, total)
    return before


def _whole(before: dict[int, tuple[int, int]]):
    """Places and sums from a conversation's very first turn on."""
    def run(part: pd.Series, opening: pd.Series, place: pd.Series, total: pd.Series) -> pd.DataFrame:
        places, sums = [], []
        for p, o, n, s in zip(part, opening, place, total, strict=True):
            turns, earlier = before.get(p, (0, 0)) if o else (0, 0)
            if turns:
                s = ((earlier + int.from_bytes(s, "big") * pow(RADIX, turns, MODULUS)) % MODULUS).to_bytes(16, "big")
            places.append(n + turns)
            sums.append(s)
        return pd.DataFrame({"position": places, "prefix": sums})

    return F.pandas_udf(run, "position long, prefix binary")


def with_prefixes(ws: Workspace, turns: DataFrame) -> DataFrame:
    """Per turn: conv_id, position from 1, prefix (the hash of all turns up to it), role, text."""
    read = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of().alias("text")).distinct()
    order = ["conv_id", "turn", "role", "text"]
    saved = ws.save(read, "turns")
    dealt = saved.repartitionByRange(*ranges_of(saved), *order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    scanned = ws.save(dealt.mapInArrow(_scan, _SCANNED), "scanned")
    whole = _whole(_before(scanned))("part", "opening", "place", "sum")
    return ws.save(scanned.select("conv_id", whole.alias("w"), "role", "text").select("conv_id", "w.position", "w.prefix", "role", "text"), "prefixes")


def maximal(ws: Workspace, prefixes: DataFrame) -> DataFrame:
    """Conversations that are no prefix of another: conv_id, n_turns, n_copies."""
    ends = prefixes.groupBy("conv_id").agg(F.max(F.struct("position", "prefix")).alias("e")).select("conv_id", F.col("e.position").alias("n_turns"), "e.prefix")
    ends = ws.save(ends, "ends")
    inner = prefixes.select("conv_id", "position", "prefix").join(ends.select("conv_id", "n_turns"), "conv_id").where("position < n_turns")
    inner = inner.select(F.col("position").alias("n_turns"), "prefix").distinct()
    distinct = ends.groupBy("n_turns", "prefix").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    return distinct.join(inner, ["n_turns", "prefix"], "left_anti").select("conv_id", "n_turns", "n_copies")


def rendered(role: Column, text: Column) -> Column:
    """A turn between markers. Marker signs inside are escaped, so that different turns render differently."""
    escaped = [F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|")) for c in (role, text)]
    return F.concat(F.lit("<|start|>"), escaped[0], F.lit("\n"), escaped[1], F.lit("<|end|>\n"))


def format_chats(turns: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """The maximal conversations: conv_id, part (from 0), n_turns, n_copies, text. A conversation is its parts in order."""
    ws = Workspace(turns.sparkSession, "chat")
    prefixes = with_prefixes(ws, turns)
    kept = ws.save(maximal(ws, prefixes), "maximal")
    part = F.floor((F.col("position") - 1) / turns_per_part).cast("long")
    shown = prefixes.select("conv_id", part.alias("part"), "position", rendered(F.col("role"), F.col("text")).alias("turn"))
    parts = shown.join(kept, "conv_id").groupBy("conv_id", "part", "n_turns", "n_copies").agg(
        F.sort_array(F.collect_list(F.struct("position", "turn"))).alias("turns"))
    return parts.select("conv_id", "part", "n_turns", "n_copies", F.array_join("turns.turn", "").alias("text"))


CHAT_SQL = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS position,
           count(*) OVER (PARTITION BY conv_id) AS n_turns FROM turns),
prefixes AS (
    SELECT *, string_agg(md5(len(role) || ' ' || role || text), '') OVER (PARTITION BY conv_id ORDER BY position) AS prefix FROM placed),
ends AS (
    SELECT prefix, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM prefixes WHERE position = n_turns GROUP BY prefix, n_turns),
maximal AS (SELECT * FROM ends WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE position < n_turns))
SELECT m.conv_id, (p.position - 1) // 64 AS part, m.n_turns, m.n_copies,
       string_agg('<|start|>' || replace(replace(p.role, '\\', '\\\\'), '<|', '<\\|') || chr(10)
                  || replace(replace(p.text, '\\', '\\\\'), '<|', '<\\|') || '<|end|>' || chr(10), '' ORDER BY p.position) AS text
FROM maximal m JOIN prefixes p ON p.conv_id = m.conv_id
GROUP BY m.conv_id, (p.position - 1) // 64, m.n_turns, m.n_copies
"""
