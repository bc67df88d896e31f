"""Near-dedup by bottom-k sketches of one hash function.

A text's set is its distinct 5-word shingles, hashed once; its sketch is the ``k`` smallest hashes. Texts with the
same set are one class, and only the class's smallest doc_id goes on. Then:

* Inverted lists. Two sets of similarity 0.75 share three quarters of their sketches, give or take; at least
  ``least_shared`` values of them (five standard deviations below). So a pair must share one of the rarest
  ``k - least_shared + 1`` values of both. Texts that share none of their rarest values with any other are done with.
* Of the others the full sets are listed, by the same rule with exact numbers: a text's rarest quarter, and with each
  value how many of its values are as frequent or more so. The rarest value that a pair shares bounds its overlap by
  the smaller of these two numbers, and a pair that needs more overlap is never named. Common passages rank last, so
  texts that share little else drop out here.
* Overlaps. The pairs of a short list are all compared. A long list names leaders, in growing numbers from round to
  round; a leader is compared with all members outside its component and has then done with the list. Lists within
  one component are done, so the members of a list's largest component lead no more: of two components that could be
  joined one has another leader. So large groups of copies cost a comparison for each copy and leader, not one for each
  two copies, and no pair that could join two components is left out.
* Each text has ``PARITY_WORDS`` words of bits, each the parity of the shingles that fall to it. Two texts differ in at
  least as many shingles as in bits; a pair that differs in more bits than similar texts may in shingles is never named.
* The similarity of a pair is estimated from the sketch of its union; clearly lower ones go.
* The rest is confirmed on the full sets, the likeliest pair of each text first; what has become one component by
  then needs no further pair.

Texts are read whole, however long, in some 60 bytes of memory for each byte of the longest text. Texts without words have no shingles and no links, null texts and empty ones among them. Rows without a doc_id are returned with
no component and as kept. Rows that share a doc_id are one node. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylane.llm.bloom import with_ids, without_ids
from ferrylane.llm.common import Workspace, batch_map, text_of
from ferrylane.llm.components import components
from ferrylane.llm.shingles import shingle_sets

SKETCH_SIZE = 64
#: Similarity in percent, compared in whole numbers.
SIMILARITY = 75
#: Lists of at most so many members are compared pair by pair.
SHORT_LIST = 8
#: How many times more leaders a long list names in each round.
LEADER_GROWTH = 64
#: 64-bit words of shingle parities for each text.
PARITY_WORDS = 8
PARITIES = "struct<" + ", ".join(f"w{i}: bigint" for i in range(PARITY_WORDS)) + ">"


def least_shared(k: int) -> int:
    """Values that two sketches of similar texts share, but for five standard deviations."""
    share = SIMILARITY / 100
    return max(1, math.floor(share * k - 5 * math.sqrt(k * share * (1 - share))))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([np.zeros(0, dtype=np.uint64), *arrays]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sketches(k: int):
    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingle_sets(batch.column(1)))
        contents = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(contents, pa.binary()), _lists([s[:k] for s in sets])],
            names=["doc_id", "n_shingles", "content", "sketch"])

    return batch_map(sketch)


def _parities(sets: list[np.ndarray]) -> pa.Array:
    """For each set the bits that an odd number of its values fall to."""
    bits = 64 * PARITY_WORDS
    odd = np.zeros((len(sets), bits), dtype=np.uint8)
    for row, values in zip(odd, sets, strict=True):
        row[:] = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    words = np.packbits(odd, axis=1).view(np.int64)
    return pa.StructArray.from_arrays([pa.array(words[:, i]) for i in range(PARITY_WORDS)], names=[f"w{i}" for i in range(PARITY_WORDS)])


def _full_sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = list(shingle_sets(batch.column(1)))
    return pa.RecordBatch.from_arrays([batch.column(0), _lists(sets), _parities(sets)], names=["doc_id", "shingles", "parities"])


def _frequencies(postings: DataFrame) -> DataFrame:
    """Values that more than one text has."""
    return postings.groupBy("value").agg(F.count(F.lit(1)).alias("frequency")).where("frequency > 1")


def _rarest(postings: DataFrame, frequencies: DataFrame, size: Column, needed: Column) -> DataFrame:
    """For each doc_id the shared ones among its rarest ``size`` - ``needed`` + 1 values: value, doc_id, n, remaining.

    ``remaining`` counts the value and those after it, from rare to frequent.
    """
    shared = postings.join(frequencies, "value").groupBy("doc_id", "n").agg(
        F.sort_array(F.collect_list(F.struct("frequency", "value"))).alias("shared"))
    unshared = size - F.size("shared")
    listed = F.greatest(size - needed + 1 - unshared, F.lit(0)).cast("int")
    return shared.select("doc_id", "n", F.size("shared").alias("s"), F.posexplode(F.slice("shared", 1, listed))).select(
        "col.value", "doc_id", "n", (F.col("s") - F.col("pos")).alias("remaining"))


def _sketch_lists(classes: DataFrame, ws: Workspace, k: int) -> DataFrame:
    postings = classes.select("doc_id", "n", F.explode("sketch").alias("value"))
    whole = F.ceil(F.col("n") * SIMILARITY / 100)
    needed = F.when(F.col("n") * 100 < k * SIMILARITY, whole).otherwise(F.least(whole, F.lit(least_shared(k))))
    return _rarest(postings, ws.save(_frequencies(postings), "frequencies"), F.least(F.col("n"), F.lit(k)), needed)


def _set_lists(sets: DataFrame, ws: Workspace) -> DataFrame:
    postings = sets.select("doc_id", F.size("shingles").alias("n"), F.explode("shingles").alias("value"))
    return _rarest(postings, ws.save(_frequencies(postings), "frequencies"), F.col("n"), F.ceil(F.col("n") * SIMILARITY / 100))


def _similar(intersection: Column, union: Column) -> Column:
    return 100 * intersection >= SIMILARITY * union


def _may_be_similar(remaining: Column, n: Column, parities: str, other_parities: str) -> Column:
    """Whether two sets of ``n`` values between them may be similar, sharing at most ``remaining``."""
    differing = sum((F.bit_count(F.col(f"{parities}.w{i}").bitwiseXOR(F.col(f"{other_parities}.w{i}"))) for i in range(PARITY_WORDS)), F.lit(0))
    return (remaining * (100 + SIMILARITY) >= n * SIMILARITY) & (differing * (100 + SIMILARITY) <= n * (100 - SIMILARITY))


def _likely(pairs: DataFrame, sketches: DataFrame, k: int) -> DataFrame:
    """The pairs a, b whose union's sketch doesn't speak against them, with the similarity it gives."""
    left = sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("left"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("right"))
    both = F.array_intersect("left", "right")
    union = F.array_sort(F.array_union("left", "right"))
    complete = (F.size("left") < k) & (F.size("right") < k)
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("both"), union.alias("union"), complete.alias("complete"))
    retained = F.slice("union", 1, k)
    hits = F.size(F.array_intersect(retained, "both"))
    counted = joined.select("a", "b", "complete", F.size("both").alias("n_both"), F.size("union").alias("n_union"),
                            hits.alias("hits"), F.size(retained).alias("n_retained"))
    enough = F.when(F.col("complete"), _similar(F.col("n_both"), F.col("n_union"))).otherwise(
        F.col("hits") * k >= least_shared(k) * F.col("n_retained"))
    return counted.where(enough).select("a", "b", (F.col("hits") / F.col("n_retained")).alias("estimate"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    counted = pairs.select("a", "b").join(left, "a").join(right, "b").select(
        "a", "b", both.alias("n_both"), (F.size("left") + F.size("right") - both).alias("n_union"))
    return counted.where(_similar(F.col("n_both"), F.col("n_union"))).select("a", "b")


class _Labels:
    """The components found so far: doc_id and component_id."""

    def __init__(self, ws: Workspace, ids: DataFrame):
        self.ws = ws
        self.table = ws.save(ids.select("doc_id", F.col("doc_id").alias("component_id")), "labels")

    def of(self, name: str) -> DataFrame:
        return self.table.select(F.col("doc_id").alias(name), F.col("component_id").alias(f"component_{name}"))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs that could join two components."""
        return pairs.join(self.of("a"), "a").join(self.of("b"), "b").where("component_a <> component_b")

    def connect(self, links: DataFrame) -> None:
        joining = self.apart(links).select(F.col("component_a").alias("a"), F.col("component_b").alias("b"))
        joining = self.ws.save(joining.distinct(), "joining")
        if joining.isEmpty():
            return
        merged = components(self.ws, joining).select(F.col("id").alias("component_id"), F.col("component_id").alias("into"))
        labels = self.table.join(merged, "component_id", "left").select(
            "doc_id", F.coalesce("into", "component_id").alias("component_id"))
        self.table = self.ws.save(labels, "labels")


def _link(ws: Workspace, labels: _Labels, pairs: DataFrame, sets: DataFrame, texts: int) -> None:
    """Confirm the pairs that could join two components, and join them."""
    if pairs.count() > texts:
        ends = pairs.select(F.col("a").alias("id"), "estimate", "a", "b").unionByName(pairs.select(F.col("b").alias("id"), "estimate", "a", "b"))
        first = ends.groupBy("id").agg(F.max(F.struct("estimate", "a", "b")).alias("pair")).select("pair.a", "pair.b").distinct()
        labels.connect(_confirmed(first, sets))
        pairs = ws.save(labels.apart(pairs).select("a", "b"), "pairs-left")
    labels.connect(_confirmed(pairs, sets))


def _open_lists(members: DataFrame) -> DataFrame:
    """Lists of more than one component: value, in_list (members), largest (the component that has most of them)."""
    parts = members.groupBy("value", "component_id").agg(F.count(F.lit(1)).alias("n"))
    lists = parts.groupBy("value").agg(
        F.sum("n").alias("in_list"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component_id")).alias("l"))
    return lists.where("parts > 1").select("value", "in_list", F.col("l.component_id").alias("largest"))


def _leaders(members: DataFrame, n_leaders: int, turn: int) -> DataFrame:
    """All members of short lists, and of each long list at most ``n_leaders`` from outside its largest component:
    unlinked texts first, then those with the fewest values before the list's, as texts with few edits have."""
    members = members.where((F.col("in_list") <= SHORT_LIST) | (F.col("component_id") != F.col("largest")))
    seat = F.when(F.col("in_list") <= SHORT_LIST, F.col("doc_id")).otherwise(F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.lit(n_leaders)))
    rank = F.struct(
        F.col("component_id") != F.col("doc_id"), F.col("n") - F.col("remaining"), "doc_id", "n", "remaining", "component_id", "parities")
    return members.withColumn("seat", seat).groupBy("value", "seat").agg(F.min(rank).alias("l")).select(
        "value", F.col("l.doc_id").alias("leader"), F.col("l.n").alias("leader_n"),
        F.col("l.remaining").alias("leader_remaining"), F.col("l.component_id").alias("leader_component"),
        F.col("l.parities").alias("leader_parities"))


def _connect_lists(ws: Workspace, postings: DataFrame, sketches: DataFrame, sets: DataFrame, k: int) -> _Labels:
    labels = _Labels(ws, postings.select("doc_id").distinct())
    texts = labels.table.count()
    turn, n_leaders = 0, 1
    while True:
        members = ws.save(postings.join(labels.table, "doc_id"), "members")
        lists = ws.save(_open_lists(members), "lists")
        if lists.isEmpty():
            return labels
        members = ws.save(members.join(lists, "value").join(sets.select("doc_id", "parities"), "doc_id"), "open-members")
        leaders = ws.save(_leaders(members, n_leaders, turn), "leaders")
        possible = (F.col("component_id") != F.col("leader_component")) & _may_be_similar(
            F.least("remaining", "leader_remaining"), F.col("n") + F.col("leader_n"), "parities", "leader_parities")
        pairs = members.join(leaders, "value").where(possible).select(
            F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct()
        likely = ws.save(_likely(pairs, sketches, k), "likely")
        _link(ws, labels, likely, sets, texts)
        done = leaders.select("value", F.col("leader").alias("doc_id"))
        left = members.where(F.col("in_list") > SHORT_LIST).join(done, ["value", "doc_id"], "left_anti")
        postings = left.select("value", "doc_id", "n", "remaining")
        turn, n_leaders = turn + 1, n_leaders * LEADER_GROWTH


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SKETCH_SIZE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    ws = Workspace(docs.sparkSession, "near-dedup")
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    rows = ws.save(read.mapInArrow(_sketches(k), "doc_id long, n_shingles long, content binary, sketch array<long>"), "sketches")
    linkable = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("content").agg(F.min(F.struct("doc_id", F.col("n_shingles").alias("n"), "sketch")).alias("r"))
    classes = ws.save(classes.select("content", "r.doc_id", F.col("r.n").cast("int").alias("n"), "r.sketch"), "classes")

    ids = ws.save(_sketch_lists(classes, ws, k).select("doc_id").distinct(), "listed")
    sets = ws.save(with_ids(read, ids).mapInArrow(batch_map(_full_sets), f"doc_id long, shingles array<long>, parities {PARITIES}"), "sets")
    listed = ws.save(_set_lists(sets, ws), "postings")
    sketches = ws.save(classes.join(ids, "doc_id", "left_semi").select("doc_id", "sketch"), "listed-sketches")
    labels = _connect_lists(ws, listed, sketches, sets, k)

    named = classes.select("content", "doc_id").join(labels.table.select("doc_id", "component_id"), "doc_id", "left").select(
        "content", F.coalesce("component_id", "doc_id").alias("component_id"))
    named = ws.save(named, "named")
    joined = rows.select("doc_id", "n_shingles", "content").join(named, "content", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SKETCH_SIZE) -> DataFrame:
    """``docs`` without the rows that near_duplicates does not keep."""
    ws = Workspace(docs.sparkSession, "near-dedup")
    dropped = ws.save(near_duplicates(docs, doc_id, text, k).where(~F.col("kept")).select("doc_id"), "dropped")
    return without_ids(docs, dropped, doc_id)
