"""SentencePiece encoding with seeded merge-dropout, and decoding.

A BPE model merges neighbouring symbols, the best-scored pair first. With dropout each candidate merge may be skipped, for
good, when its turn comes; so the same text is cut in various ways, and every cut decodes to it. Whether a candidate is skipped is
a hash of the seed, the row's key, and where its two parts start and end: a row is cut alike whenever, wherever and in
whatever order it is worked on, and another seed gives another cut. A rate of 0 gives the library's own encoding.

Two agendas do the same. Short stretches, which are nearly all, are worked on side by side: as many rows of an array,
each taking its best candidate until none is left. Long ones (texts without spaces) have a heap each, so that their time grows
with n log n. No piece may reach over the start of a run of spaces or a character that has no piece, so texts are cut there.

The model must leave texts as they are, but for spaces, as models for lossless use do; else ValueError. Characters without a
piece, and the space sign U+2581 itself, become byte pieces. Null and empty texts have no pieces and decode to the empty text.
Other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane.llm.common import batch_map, free_name, prepare
from ferrylane.llm.shingles import mix

SPACE = "▁"
#: Stretches of at most so many characters are worked on side by side, in arrays of these widths.
WIDTHS = (4, 8, 12, 16, 24, 32, 64)
#: Characters worked on at once.
CHUNK = 1 << 20
NEVER = np.int32(2**31 - 1)
_PLACE, _MIDDLE, _END = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Pieces:
    """A model's pieces as arrays: which two merge into which, and how good that is."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.bytes = np.full(256, -1, dtype=np.int32)
        for i in range(size):
            if sp.is_byte(i):
                self.bytes[int(self.names[i][3:5], 16)] = i
        self._check(plain)
        scores = np.array([sp.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        by_name = {self.names[i]: i for i in plain}
        self.pairs: dict[tuple[int, int], int] = {}
        for name, i in by_name.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
            for cut in range(1, len(name)):
                left, right = by_name.get(name[:cut]), by_name.get(name[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = i
        self.size = size
        self._hash_pairs()

    def _check(self, plain: list[int]) -> None:
        probe = " a  b ﬁé\t\nC "
        if self.library.normalize(probe) != (SPACE + probe).replace(" ", SPACE):
            raise ValueError("the model changes texts, so they could not be decoded without loss")
        if (self.bytes < 0).any():
            raise ValueError("the model lacks byte pieces")
        if any(SPACE in self.names[i].lstrip(SPACE) for i in plain):
            raise ValueError("the model has pieces that reach over the start of a word")

    def _hash_pairs(self) -> None:
        """Open addressing; a pair lies at most ``probes`` - 1 slots behind its own."""
        bits = max(4, (4 * len(self.pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        size = (1 << bits) + 64
        self.slot_pair, self.slot_piece = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int32)
        self.probes = 1
        for (left, right), piece in self.pairs.items():
            key = left * self.size + right
            slot = int(self._slots(np.array([key]))[0])
            probe = 0
            while self.slot_pair[slot + probe] >= 0:
                probe += 1
            self.slot_pair[slot + probe], self.slot_piece[slot + probe] = key, piece
            self.probes = max(self.probes, probe + 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _PLACE) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two pieces make, or -1."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -2
        slots = self._slots(keys)
        out = np.where(self.slot_pair[slots] == keys, self.slot_piece[slots], np.int32(-1))
        open_ = np.flatnonzero((out < 0) & (self.slot_pair[slots] >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = slots[open_] + probe
            hit = self.slot_pair[at] == keys[open_]
            out[open_[hit]] = self.slot_piece[at[hit]]
            open_ = open_[~hit & (self.slot_pair[at] >= 0)]
        return out


class Dropout:
    """Which candidates are skipped: those whose keyed hash is below the rate."""

    def __init__(self, rate: float, seed: int):
        self.limit = np.uint64(min(int(rate * 2**64), 2**64 - 1))
        self.seed = int.from_bytes(hashlib.blake2b(str(seed).encode(), digest_size=8).digest(), "big")

    def row_key(self, key: object) -> int:
        return int.from_bytes(hashlib.blake2b(f"{self.seed}:{key}".encode(), digest_size=8).digest(), "big")

    def skips(self, key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For candidates from ``start`` over ``middle`` to ``end``, places in their text."""
        u = np.uint64
        return mix(key ^ mix(start.astype(u) * _PLACE + middle.astype(u) * _MIDDLE + end.astype(u) * _END)) < self.limit


def _heap_merge(pieces: Pieces, ids: np.ndarray, dropout: Dropout, key: int, first: int) -> list[tuple[int, int]]:
    """(place, piece) of the symbols that one stretch is merged into."""
    ids, n = ids.tolist(), len(ids)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    agenda: list[tuple[int, int, int, int, int]] = []
    key_of = np.array([key], dtype=np.uint64)

    def offer(left: int, right: int) -> None:
        if left >= 0 and right < n:
            piece = pieces.pairs.get((ids[left], ids[right]))
            if piece is not None:
                heapq.heappush(agenda, (int(pieces.rank[piece]), left, right, after[right], piece))

    for i in range(n - 1):
        offer(i, i + 1)
    while agenda:
        _, left, right, end, piece = heapq.heappop(agenda)
        if not (alive[left] and right < n and alive[right]) or after[left] != right or after[right] != end:
            continue
        if dropout.limit and dropout.skips(key_of, *[np.array([first + x]) for x in (left, right, end)])[0]:
            continue
        ids[left], alive[right], after[left] = piece, False, end
        if end < n:
            before[end] = left
        offer(before[left], left)
        offer(left, end)
    return [(i, ids[i]) for i in range(n) if alive[i]]


def _side_by_side(pieces: Pieces, ids: np.ndarray, length: np.ndarray, dropout: Dropout, key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Merge each row of ``ids`` (rows, width) as far as it goes: the piece where a symbol starts, -2 elsewhere."""
    n, width = ids.shape
    out = np.full((n, width), -2, dtype=np.int32)
    rows = np.arange(n)
    after = np.broadcast_to(np.arange(1, width + 1, dtype=np.int16), (n, width)).copy()
    before = np.broadcast_to(np.arange(-1, width - 1, dtype=np.int16), (n, width)).copy()
    ids = ids.copy()
    found = np.full((n, width), -1, dtype=np.int32)
    rank = np.full((n, width), NEVER, dtype=np.int32)

    def offer(r: np.ndarray, left: np.ndarray) -> None:
        """Work out the candidate of the symbol at ``left`` and the one after it, for rows ``r`` of those still open."""
        right = after[r, left]
        inside = right < length[r]
        end = np.where(inside, after[r, np.where(inside, right, 0)], 0)
        piece = np.where(inside, pieces.merged(ids[r, left], ids[r, np.where(inside, right, 0)]), np.int32(-1))
        if dropout.limit:
            some = np.flatnonzero(piece >= 0)
            rs, base = r[some], first[r[some]]
            piece[some[dropout.skips(key[rs], base + left[some], base + right[some], base + end[some])]] = -1
        found[r, left] = piece
        rank[r, left] = np.where(piece >= 0, pieces.rank[piece], NEVER)

    for column in range(width - 1):
        r = np.flatnonzero(length > column + 1)
        if len(r):
            offer(r, np.full(len(r), column, dtype=np.int16))
    while len(rows):
        best = rank.argmin(axis=1).astype(np.int16)
        line = np.arange(len(rows))
        going = rank[line, best] != NEVER
        if not going.all():
            done = ~going
            out[rows[done]] = ids[done]
            keep = np.flatnonzero(going)
            if not len(keep):
                break
            rows, ids, after, before, found, rank = rows[keep], ids[keep], after[keep], before[keep], found[keep], rank[keep]
            length, key, first, best = length[keep], key[keep], first[keep], best[keep]
            line = np.arange(len(rows))
        right = after[line, best]
        end = after[line, right]
        ids[line, best] = found[line, best]
        ids[line, right] = -2
        rank[line, right] = NEVER
        after[line, best] = end
        inside = np.flatnonzero(end < length)
        before[inside, end[inside]] = best[inside]
        offer(line, best)
        left = before[line, best]
        some = np.flatnonzero(left >= 0)
        if len(some):
            offer(some, left[some])
    return out


def encode(pieces: Pieces, texts: Sequence[str], keys: Sequence[object], dropout: Dropout) -> list[np.ndarray]:
    """The piece ids of each text; ``keys`` tell rows apart."""
    out: list[np.ndarray] = []
    batch: list[int] = []
    total = 0
    for i, text in enumerate(texts):
        batch.append(i)
        total += len(text)
        if total >= CHUNK or i == len(texts) - 1:
            out += _encode_chunk(pieces, [texts[j] for j in batch], [keys[j] for j in batch], dropout)
            batch, total = [], 0
    return out


def _encode_chunk(pieces: Pieces, texts: list[str], keys: list[object], dropout: Dropout) -> list[np.ndarray]:
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    points = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(points):
        return [np.zeros(0, dtype=np.int32) for _ in texts]
    space = points == 0x20
    ids = np.where(space, pieces.of_char[ord(SPACE)], pieces.of_char[points])
    ids[points == ord(SPACE)] = -1
    unknown = ids < 0
    starts = unknown.copy()
    starts[1:] |= (space[1:] & ~space[:-1]) | unknown[:-1]
    starts[offsets[:-1][sizes > 0]] = True
    first = np.flatnonzero(starts)
    length = np.diff(np.append(first, len(points)))
    owner = np.searchsorted(offsets, first, side="right") - 1
    row_keys = np.array([dropout.row_key(k) for k in keys], dtype=np.uint64)
    place = first - offsets[owner]

    merged = ids.copy()  # pieces where symbols start, -2 within them, -1 where there is no piece
    low = 1
    for width in WIDTHS:
        some = np.flatnonzero((length > low) & (length <= width))
        low = width
        if not len(some):
            continue
        columns = np.arange(width)
        inside = columns[None, :] < length[some][:, None]
        at = np.where(inside, first[some][:, None] + columns[None, :], 0)
        block = np.where(inside, ids[at], np.int32(-2))
        got = _side_by_side(pieces, block, length[some], dropout, row_keys[owner[some]], place[some])
        merged[at[inside]] = got[inside]
    for i in np.flatnonzero(length > low):
        here = slice(first[i], first[i] + length[i])
        merged[here] = -2
        for where, piece in _heap_merge(pieces, ids[here], dropout, int(row_keys[owner[i]]), int(place[i])):
            merged[first[i] + where] = piece

    encoded = merged
    lacking = np.flatnonzero(merged == -1)
    counts = (merged >= 0).astype(np.int64)
    if len(lacking):
        raw = [chr(points[i]).encode("utf-8", "surrogatepass") for i in lacking]
        counts[lacking] = [len(b) for b in raw]
        encoded = np.repeat(merged, np.maximum(counts, merged == -2))
        encoded = encoded[encoded != -2]
        encoded[encoded == -1] = pieces.bytes[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    else:
        encoded = merged[merged >= 0]
    ends = np.concatenate([[0], np.cumsum(counts)])[offsets]
    return [encoded[s:e].astype(np.int32) for s, e in zip(ends[:-1], ends[1:], strict=True)]


def decode(pieces: Pieces, ids: Sequence[int]) -> str:
    return pieces.library.decode([int(i) for i in ids]) if len(ids) else ""


_loaded: dict[str, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    """One for each worker process and model."""
    name = hashlib.sha256(model).hexdigest()
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Pieces(model)
    return _loaded[name]


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def with_pieces(docs: DataFrame, model_path: str, rate: float = 0.1, seed: int = 0, text: str = "text",
                key: str = "doc_id", into: str = "pieces") -> DataFrame:
    """``docs`` with the piece ids of each text; rows of one key and text are cut alike."""
    spark = prepare(docs.sparkSession)
    model = _read(model_path)
    Pieces(model)  # an unfit model fails here, not in a task
    shared, into = spark.sparkContext.broadcast(model), free_name(docs, into)
    at, key_at = docs.columns.index(text), docs.columns.index(key)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))])
    kind = pa.list_(pa.int32())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(at).to_pylist()]
        ids = encode(_pieces(shared.value), texts, batch.column(key_at).to_pylist(), Dropout(rate, seed))
        offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
        column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, dtype=np.int32), *ids])))
        return pa.RecordBatch.from_arrays([*batch.columns, column], schema=pa.schema([*batch.schema, pa.field(into, kind)]))

    return docs.mapInArrow(batch_map(run), schema)


def decoded(model_path: str, spark):
    """A column function: the text that piece ids stand for."""
    shared = spark.sparkContext.broadcast(_read(model_path))

    def run(ids: pd.Series) -> pd.Series:
        pieces = _pieces(shared.value)
        return ids.map(lambda i: "" if i is None else decode(pieces, i))

    return F.pandas_udf(run, "string")


def cut(docs: DataFrame, model_path: str, rate: float, seed: int, copies_differ: bool = False) -> DataFrame:
    """Per row: doc_id, its pieces, their number, and whether they decode to its text.

    With ``copies_differ`` rows that share an id are cut apart: merges are skipped by the id and the row's place in its
    table, which should be a written one, so that a task that is repeated finds the same places.
    """
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if copies_differ:
        read = read.withColumn("row_key", F.concat_ws(":", F.col("doc_id").cast("string"), F.monotonically_increasing_id().cast("string")))
    with_ids = with_pieces(read, model_path, rate, seed, key="row_key" if copies_differ else "doc_id")
    back: Column = decoded(model_path, docs.sparkSession)("pieces")
    return with_ids.select("doc_id", "pieces", F.size("pieces").cast("long").alias("n_pieces"), (back == F.col("text")).alias("lossless"))
