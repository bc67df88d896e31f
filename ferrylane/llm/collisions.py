"""Nearest neighbours by inner product through collision counting.

Every vector is projected on ``PROJECTIONS`` random lines, and each projection is a sorted array. A query opens a window around its
own place in every array and counts, for each vector, in how many windows it lies. Vectors that collide often enough are verified:
their inner product with the query is worked out in double precision from the vectors as given. Widening all windows by one factor
is the same as hashing anew for a larger radius (virtual rehashing): it goes on until the windows serve a radius within which the
wanted number of verified vectors lies. The windows of a radius span ``HALF_WIDTH`` radii to either side; a vector within the radius
misses one with probability ``MISS``, and the threshold is such that it is passed on with probability ``FOUND`` or more.

Largest inner products become smallest distances by one more component, sqrt(M^2 - |x|^2) for vectors and 0 for queries of length M.

Equal vectors are one, with the ``k + 1`` smallest of their ids, which is all that any list of ``k`` can show. The distinct vectors
are dealt by hash to blocks of bounded size; a block has its own arrays and its own M. Query blocks meet vector blocks in waves:
one block, then eight, then sixty-four and so on. In the first wave windows widen step by step; in later ones they start at the radius
of the ``k``-th best vector found so far, so that far blocks cost little more than the counting. Nothing is dropped between waves.

Defined results: vectors that are null, empty or zero, or that hold null or non-finite components, and rows with a null id, take no
part. Vectors of another length than the query's are no candidates. Rows that repeat an id share it: none of them is its own
candidate, and every different vector under it has a list. An inner product that overflows is infinite; one that is not a
number counts as minus infinity. Ties go to the smaller id. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrylane.llm.common import Batches, Workspace

PROJECTIONS = 128
HALF_WIDTH = 2.0
#: The probability that a normal variable lies outside HALF_WIDTH deviations.
MISS = math.erfc(HALF_WIDTH / math.sqrt(2))
FOUND = 0.98
#: The first radius, of unit vectors, and the factor between radii while windows widen step by step.
FIRST_RADIUS, FACTOR = 0.05, math.sqrt(2)
#: Vectors of a block, fewer if they are long, and queries that meet them in one task.
BLOCK_ROWS, BLOCK_VALUES, QUERY_ROWS = 8192, 1 << 22, 2048
#: How many times more blocks each wave has than the last.
WAVE = 8
_LOST = 1e-9  # what rounding may take off a radius


def misses_allowed(projections: int = PROJECTIONS, found: float = FOUND) -> int:
    """The fewest misses such that a vector at the radius has no more of them with probability ``found``."""
    total = 0.0
    for misses in range(projections + 1):
        total += math.comb(projections, misses) * MISS**misses * (1 - MISS) ** (projections - misses)
        if total >= found:
            return misses
    return projections


class Block:
    """The sorted arrays of a block of vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        # Lengths are taken of scaled vectors, so that squares neither overflow nor vanish.
        self.scale = np.abs(vectors).max()
        scaled = vectors / self.scale
        self.longest = np.linalg.norm(scaled, axis=1).max()
        unit = scaled / self.longest
        rest = np.sqrt(np.maximum(0.0, 1 - (unit**2).sum(axis=1)))
        self.lines = np.random.Generator(np.random.PCG64(vectors.shape[1])).normal(size=(PROJECTIONS, vectors.shape[1] + 1))
        places = self.lines[:, :-1] @ unit.T + self.lines[:, -1:] * rest
        self.order = np.argsort(places, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(places, self.order, axis=1)
        self.allowed = misses_allowed()

    def distance(self, query: np.ndarray, score: float) -> float:
        """How far from the query, both of length 1, a vector with that inner product lies. Scores are at most length times length."""
        top = np.abs(query).max()
        length = np.linalg.norm(query / top)
        cosine = score / top / self.scale / (length * self.longest)
        return math.sqrt(max(0.0, 2 - 2 * cosine)) + _LOST if cosine > -1 else 2.0

    def _windows(self, place: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        low = np.array([a.searchsorted(x, "left") for a, x in zip(self.sorted, place - HALF_WIDTH * radius)])
        high = np.array([a.searchsorted(x, "right") for a, x in zip(self.sorted, place + HALF_WIDTH * radius)])
        return low, high

    def _in_slices(self, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """How often each vector lies in one of the slices of the sorted arrays."""
        return np.bincount(np.concatenate([o[a:b] for o, a, b in zip(self.order, lows, highs)]), minlength=len(self.vectors))

    def collisions(self, place: np.ndarray, radius: float) -> np.ndarray:
        """Windows that each vector lies in; where windows are wide, by counting what lies outside."""
        low, high = self._windows(place, radius)
        size = len(self.vectors)
        if 2 * (high - low).sum() <= size * PROJECTIONS:
            return self._in_slices(low, high)
        nothing, everything = np.zeros_like(low), np.full_like(high, size)
        return PROJECTIONS - self._in_slices(nothing, low) - self._in_slices(high, everything)

    def _widened(self, count: np.ndarray, before: tuple[np.ndarray, np.ndarray], now: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The counts of wider windows, from those of the narrower and the strips between them."""
        return count + self._in_slices(now[0], before[0]) + self._in_slices(before[1], now[1])

    def search(self, query: np.ndarray, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows found and their scores: all that were verified and can be among the ``k`` best, given that ``k`` with
        ``bound`` or more are known (minus infinity: none are)."""
        top = np.abs(query).max()
        unit = query / top
        place = self.lines[:, :-1] @ (unit / np.linalg.norm(unit))
        least = PROJECTIONS - self.allowed
        if bound > -math.inf:
            rows = np.flatnonzero(self.collisions(place, self.distance(query, bound)) >= least)
            scores = self._scores(query, rows)
        else:
            rows, scores = self._step_by_step(query, place, least, k)
        keep = scores >= bound
        return rows[keep], scores[keep]

    def _step_by_step(self, query, place, least, k):
        radius, windows = FIRST_RADIUS, self._windows(place, FIRST_RADIUS)
        count = self._in_slices(*windows)
        verified, rows, scores = np.zeros(len(self.vectors), dtype=bool), np.zeros(0, np.int64), np.zeros(0)
        while True:
            fresh = np.flatnonzero((count >= least) & ~verified)
            verified[fresh] = True
            rows, scores = np.append(rows, fresh), np.append(scores, self._scores(query, fresh))
            enough = len(rows) >= k and self.distance(query, np.partition(scores, -k)[-k]) <= radius
            if enough or len(rows) == len(self.vectors):
                return rows, scores
            radius *= FACTOR
            wider = self._windows(place, radius) if radius < 1e3 else (np.zeros_like(windows[0]), np.full_like(windows[1], len(self.vectors)))
            count, windows = self._widened(count, windows, wider), wider

    def _scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            scores = (self.vectors[rows] * query).sum(axis=1)
        return np.where(np.isnan(scores), -np.inf, scores)


def _usable(batches: Batches) -> Batches:
    """A digest for each vector that takes part; the others go."""
    for batch in batches:
        column = batch.column(1)
        lengths = np.diff(column.offsets.to_numpy())
        values = column.flatten().fill_null(math.nan).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 becomes 0.0
        valid = np.asarray(column.is_valid()) & np.asarray(batch.column(0).is_valid())
        starts = np.concatenate([[0], np.cumsum(np.where(np.asarray(column.is_valid()), lengths, 0))])
        kept = [i for i in np.flatnonzero(valid) if starts[i + 1] > starts[i]
                and np.isfinite(v := values[starts[i]:starts[i + 1]]).all() and v.any()]
        digests = [hashlib.blake2b(values[starts[i]:starts[i + 1]].tobytes(), digest_size=16).digest() for i in kept]
        chosen = batch.take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays([*chosen.columns, pa.array(digests, pa.binary())], names=["vec_id", "vector", "asks", "content"])


_FOUND = "query binary, content binary, first long, score double"


def _meet(k: int):
    """What a block of queries finds in a block of vectors: for each at most ``k`` distinct vectors."""
    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        queries, members = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        out: list[list] = [[], [], [], []]
        if queries.num_rows and members.num_rows:
            matrix = lambda t: t["vector"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            block, first, contents = Block(matrix(members)), members["first"].to_numpy(), members["content"].to_pylist()
            for vector, name, bound in zip(matrix(queries), queries["content"].to_pylist(), queries["bound"].to_pylist(), strict=True):
                rows, scores = block.search(vector, k, -math.inf if bound is None else bound)
                best = np.lexsort((first[rows], -scores))[:k]
                out[0] += [name] * len(best)
                out[1] += [contents[i] for i in rows[best]]
                out[2] += first[rows[best]].tolist()
                out[3] += scores[best].tolist()
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.float64())
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds)], names=["query", "content", "first", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    return found.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k).drop("place")


def nearest(rows: DataFrame, asks: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each row for which ``asks``: query_id, rank, vec_id, score."""
    ws = Workspace(rows.sparkSession, "nearest")
    read = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
    usable = ws.save(read.mapInArrow(_usable, "vec_id long, vector array<double>, asks boolean, content binary"), "usable")
    # Only the smallest ids of a vector can be shown. Spark trims them before the shuffle, so that a hot vector is a few rows.
    by_id = Window.partitionBy("content").orderBy("vec_id")
    few = usable.select("content", "vec_id", "vector").dropDuplicates(["content", "vec_id"]).withColumn(
        "place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    classes = ws.save(few.groupBy("content").agg(
        F.min("vec_id").alias("first"), F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector")), "classes")
    asking = usable.where("asks").select("vec_id", "content").distinct()
    asked = asking.select("content").distinct()
    sized = classes.withColumn("length", F.size("vector"))
    most = F.greatest(F.lit(1024), F.least(F.lit(BLOCK_ROWS), F.expr(f"{BLOCK_VALUES} div length")))
    lengths = sized.groupBy("length").agg(F.count(F.lit(1)).alias("members"))
    queries = ws.save(classes.join(asked, "content", "left_semi").select("content", "vector", F.size("vector").alias("length")), "queries")
    per_length = lengths.join(queries.groupBy("length").agg(F.count(F.lit(1)).alias("queries")), "length").select(
        "length", F.ceil(F.col("members") / most).cast("int").alias("blocks"), F.ceil(F.col("queries") / QUERY_ROWS).cast("int").alias("query_blocks"))
    per_length = ws.save(per_length, "lengths")
    place = lambda blocks: F.pmod(F.xxhash64("content"), F.col(blocks)).cast("int")
    members = sized.join(per_length, "length").withColumn("block", place("blocks"))
    askers = queries.join(per_length, "length").withColumn("qb", place("query_blocks"))

    blocks = per_length.agg(F.max("blocks")).first()[0] or 0
    best, low, width = None, 0, 1
    while low < blocks:
        high = low + width
        bounds = None if best is None else best.groupBy("query").agg(
            F.when(F.count(F.lit(1)) > k, F.min("score")).alias("bound")).withColumnRenamed("query", "content")
        known = askers.withColumn("bound", F.lit(None).cast("double")) if bounds is None else askers.join(bounds, "content", "left")
        met = known.where(f"blocks > {low}").select(
            "length", F.explode(F.sequence(F.lit(low), F.least(F.lit(high), F.col("blocks")) - 1)).alias("block"), "qb", F.lit(True).alias("asks"),
            "content", "vector", F.lit(None).cast("long").alias("first"), "bound")
        held = members.where(f"block >= {low} AND block < {high}").select(
            "length", "block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("qb"), F.lit(False).alias("asks"),
            "content", "vector", "first", F.lit(None).cast("double").alias("bound"))
        found = met.unionByName(held).groupBy("length", "block", "qb").applyInArrow(_meet(k + 1), _FOUND)
        best = ws.save(_best(found if best is None else best.unionByName(found), k + 1), "best")
        low, width = high, width * WAVE
    if best is None:
        best = ws.spark.createDataFrame([], _FOUND)
    # The k + 1 best ids of each distinct query: enough for every id that asks, whose own is left out.
    named = best.join(classes.select("content", "ids"), "content").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = named.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    lists = ws.save(top.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("top")), "lists")
    own = asking.withColumnsRenamed({"vec_id": "query_id", "content": "query"}).join(lists, "query")
    others = F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("at", "t")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"))
