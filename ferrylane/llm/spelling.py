"""Spelling variants by a trie of letter-group counts.

Letters fall into ``GROUPS`` groups; a word is the vector of how many of its letters each group has. One inserted letter adds one
to one count, one deleted takes one off, one replaced does both or neither. So the words near a word lie in the leaves of the
trie of count vectors that a depth-first search reaches with one surplus and one deficit to spend; leaf words are verified letter
by letter.

The trie is dealt over tasks by its upper levels: the word's length and the first ``depth`` counts, which grow with the number of
words. A word goes as member to the subtree that has it, and as query to those that its budget can reach. Every pair is met once:
by the shorter word, or of words equally long by the one whose first differing count is lower. A subtree with very many words or
queries is cut into blocks, block of queries against block of members. The search goes down a subtree for all queries at once.

Defined results: a null text has no words; a null id counts as the empty text in ``<id>:<run>``. Runs are taken from whole texts,
however long. Rows that repeat count as often as they occur. Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylane.llm.common import Batches, Workspace

LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR = 6, 5, 5
#: One occurrence in so many loses a letter.
DROP_ONE_IN = 199
GROUPS = 16
#: The order of the trie's levels, groups that tell words apart first. A letter's group is its code point modulo GROUPS.
LEVELS = (5, 4, 1, 14, 15, 9, 3, 2, 8, 12, 7, 13, 0, 6, 11, 10)
#: Words that a subtree is meant to hold, and the most that one task's block does.
SUBTREE_WORDS, BLOCK_WORDS = 16_384, 65_536
#: Distinct words that a task holds before it hands on what it has counted.
HELD_WORDS = 200_000
#: Down to so many pairs queries go down together, then pair by pair; letters of pairs that are verified in one go.
SMALL, HELD_LETTERS = 1 << 14, 1 << 21

# Shorter runs make no word. A match starts where its run does, since no part of a longer run is left over.
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")
_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))


def document_words(doc_id: int | None, text: str) -> Counter[str]:
    """The words of one text, letters dropped where the hash says so."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter[str] = Counter()
    for run, n in Counter(_RUN.findall(text.encode().translate(_LOWER).decode())).items():
        h = zlib.crc32(run.encode(), seed)
        if h % DROP_ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LEAST_LETTERS:
            words[run] += n
    return words


def _count(batches: Batches) -> Batches:
    held: Counter[str] = Counter()

    def emit() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                held.update(document_words(doc_id, text))
            if len(held) >= HELD_WORDS:
                yield emit()
    yield emit()


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words that occur ``LEAST_COUNT`` times or more."""
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = read.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def code_points(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)


def vectors(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and counts by level."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    level_of = np.argsort(LEVELS)
    owner = np.repeat(np.arange(len(words)), lengths)
    flat = np.bincount(owner * GROUPS + level_of[letters % GROUPS], minlength=len(words) * GROUPS)
    return lengths, flat.reshape(len(words), GROUPS).astype(np.int32)


def _probes(depth: int) -> np.ndarray:
    """What a query adds to its (length, counts) to name the subtrees that its budget reaches."""
    steps = []
    for longer in (1, 0):
        none = [longer] + [0] * depth
        steps.append(none)
        for i in range(depth):
            up = list(none)
            up[1 + i] = 1
            steps.append(up)
            if not longer:
                for j in range(i + 1, depth):
                    both = list(up)
                    both[1 + j] = -1
                    steps.append(both)
    return np.array(steps, dtype=np.int32)


_PLACED = "key array<int>, asks boolean, word string, n long"


def _place(depth: int):
    steps = _probes(depth)

    def rows(key: np.ndarray, asks: bool, words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        offsets = np.arange(len(key) + 1, dtype=np.int32) * (depth + 1)
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array(offsets), pa.array(key.ravel())), pa.array([asks] * len(key), pa.bool_()), pa.array(words, pa.string()), pa.array(n)],
            names=["key", "asks", "word", "n"])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            lengths, counts = vectors(words)
            own = np.column_stack([lengths, counts[:, :depth]]).astype(np.int32)
            names = np.array(words, dtype=object)
            yield rows(own, False, names, n)
            for step in steps:
                key = own + step
                real = (key >= 0).all(axis=1)
                yield rows(key[real], True, names[real], n[real])

    return run


class Subtree:
    """The members of one length, in the order of their count vectors, and the search for queries among them."""

    def __init__(self, words: list[str]):
        _, counts = vectors(words)
        self.order = np.lexsort(counts.T[::-1])
        self.counts = np.ascontiguousarray(counts[self.order].T)
        self.letters = code_points(words)[self.order]

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (member, query) that differ by one letter, for queries as long as the members or one letter shorter."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if queries:
            counts, letters = np.ascontiguousarray(vectors(queries)[1].T), code_points(queries)
            # Spent: 1 the surplus, 2 the deficit. A longer member leaves no deficit to spend; among equals it is the member's
            # first differing count that is higher, so the surplus comes first.
            spent = np.full(len(queries), 0 if letters.shape[1] == self.letters.shape[1] else 2)
            stack, waiting = [(0, 0, len(self.order), np.arange(len(queries)), spent)], 0
            held: list[tuple[np.ndarray, np.ndarray]] = []
            while stack:
                level, low, high, q, spent = stack.pop()
                if level == GROUPS or (high - low) * len(q) <= SMALL:
                    held.append(self._reached(level, low, high, q, spent, counts))
                    waiting += len(held[-1][0])
                    if waiting * letters.shape[1] > HELD_LETTERS:
                        found, held, waiting = [*found, self._verified(held, letters, counts)], [], 0
                    continue
                column, wanted = self.counts[level, low:high], counts[level, q]
                starts = np.append(np.flatnonzero(np.diff(column, prepend=column[0] - 1)), len(column))
                for start, end in zip(starts[:-1], starts[1:]):
                    into, then = _spend(column[start] - wanted, spent)
                    if len(into):
                        stack.append((level + 1, low + start, low + end, q[into], then))
            found.append(self._verified(held, letters, counts))
        m, q = (np.concatenate(side) for side in zip(*found))
        return self.order[m], q

    def _reached(self, level: int, low: int, high: int, q: np.ndarray, spent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The way down for so few pairs that each is followed by itself."""
        m, k = np.repeat(np.arange(low, high), len(q)), np.tile(np.arange(len(q)), high - low)
        q, spent = q[k], spent[k]
        for deeper in range(level, GROUPS):
            into, spent = _spend(self.counts[deeper, m] - counts[deeper, q], spent)
            m, q = m[into], q[into]
        return m, q

    def _verified(self, held: list[tuple[np.ndarray, np.ndarray]], letters: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that one letter tells apart. Pairs of equal vectors are met from both sides and kept at the query that sorts first."""
        kept, width = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], self.letters.shape[1]
        for m, q in held:
            size = max(1, HELD_LETTERS // width)
            for s in range(0, len(m), size):
                i, j = m[s:s + size], q[s:s + size]
                a, b = self.letters[i], letters[j]
                if a.shape == b.shape:
                    differ = a != b
                    near = np.flatnonzero(differ.sum(axis=1) == 1)
                    at = differ[near].argmax(axis=1)
                    after = a[near, at] > b[near, at]
                    near = near[after | (self.counts[:, i[near]] != counts[:, j[near]]).any(axis=0)]
                else:
                    ahead = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(axis=1)
                    behind = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
                    near = np.flatnonzero(ahead + behind >= width - 1)
                kept.append((i[near], j[near]))
        return tuple(np.concatenate(side) for side in zip(*kept))


def _spend(more: np.ndarray, spent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ways can be afforded, of those that lead to ``more`` letters of a group, and what is spent then."""
    into = np.flatnonzero((more == 0) | ((more == 1) & (spent & 1 == 0)) | ((more == -1) & (spent == 1)))
    more, spent = more[into], spent[into]
    return into, spent + np.where(more == 1, 1, 0) + np.where(more == -1, 2, 0)


_PAIRS = "word string, n long, other string, other_n long"


def _search(table: pa.Table) -> pa.Table:
    """The near pairs of a block of members and a block of queries."""
    asks = table["asks"].to_numpy()
    words, n = np.array(table["word"].to_pylist(), dtype=object), table["n"].to_numpy()
    members, member_n = words[~asks].tolist(), n[~asks]
    out: list[list] = [[], [], [], []]
    if members:
        tree, queries, query_n = Subtree(members), words[asks], n[asks]
        lengths = np.array([len(w) for w in queries], dtype=np.int64)
        for length in (len(members[0]), len(members[0]) - 1):
            chosen = np.flatnonzero(lengths == length)
            m, q = tree.near(queries[chosen].tolist())
            out[0] += [members[i] for i in m]
            out[1] += member_n[m].tolist()
            out[2] += queries[chosen[q]].tolist()
            out[3] += query_n[chosen[q]].tolist()
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.table([pa.array(v, k) for v, k in zip(out, kinds)], names=["word", "n", "other", "other_n"])


def near_pairs(ws: Workspace, words: DataFrame) -> DataFrame:
    """Each pair of near words once: word, n, other, other_n."""
    total = words.count()
    depth = min(GROUPS, max(1, math.ceil(math.log(max(1.0, total / SUBTREE_WORDS / 6), 2.5))))
    placed = words.select("word", "n").mapInArrow(_place(depth), _PLACED)
    sizes = placed.groupBy("key").agg(F.count_if(~F.col("asks")).alias("members"), F.count_if("asks").alias("queries"))
    # Few subtrees are too large for a task: at most a row for every BLOCK_WORDS words placed.
    large = ws.save(sizes.where(f"members > 0 AND greatest(members, queries) > {BLOCK_WORDS}").select(
        "key", F.ceil(F.col("members") / BLOCK_WORDS).cast("int").alias("mbs"), F.ceil(F.col("queries") / BLOCK_WORDS).cast("int").alias("qbs")), "large")
    place = lambda blocks: F.pmod(F.xxhash64("word"), F.greatest(F.lit(1), F.col(blocks))).cast("int")
    every = lambda blocks: F.sequence(F.lit(0), F.greatest(F.lit(1), F.col(blocks)) - 1)
    if large.isEmpty():
        dealt, keys = placed, ["key"]
    else:
        cut = placed.join(large if large.count() > 1_000_000 else F.broadcast(large), "key", "left").fillna(1, ["mbs", "qbs"])
        dealt, keys = cut.withColumns({
            "mb": F.explode(F.when(F.col("asks"), every("mbs")).otherwise(F.array(place("mbs")))),
        }).withColumn("qb", F.explode(F.when(F.col("asks"), F.array(place("qbs"))).otherwise(every("qbs")))), ["key", "mb", "qb"]
    return ws.save(dealt.select(*keys, "asks", "word", "n").groupBy(*keys).applyInArrow(_search, _PAIRS), "pairs")


def _roots(ws: Workspace, forms: DataFrame) -> DataFrame:
    """(word, root) for words that have a form: every round follows twice as many forms. Counts grow along them, so they end."""
    up = ws.save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = ws.save(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if followed.where("moved").isEmpty():
            return followed.select("word", "root")
        up = ws.save(followed.select("word", "root"), "roots")


def variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """One row per row of ``words`` (word, n): word, form, root, n, n_near, form_n."""
    ws = Workspace(words.sparkSession, "spelling")
    words = ws.save(words.select("word", "n"), "words")
    pairs = near_pairs(ws, words)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("low"), "other")).alias("best"))
    near = words.join(best, "word", "left")
    formed = -F.col("best.low") >= factor * F.col("n")
    near = ws.save(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.other")).alias("form"), F.when(formed, -F.col("best.low")).alias("form_n")), "near")
    roots = _roots(ws, near.where("form IS NOT NULL"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variants of the words of ``docs``."""
    return variants(counted_words(docs))
