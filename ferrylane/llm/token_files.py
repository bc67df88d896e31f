"""Token ids in checksummed binary files, in ascending doc_id order, and back.

Documents are dealt by ranges of doc_id, encoded where they lie, and packed: a row of the files is a *pack*, whole
documents of about ``PACK_IDS`` ids, cut into blocks that the range coder codes apart. Rows of a partition lie in order, and
``part`` numbers the partitions in order. Parquet holds the rows, so Spark's commit keeps files of failed tasks out.

A pack, little-endian: ``TIDS``, version (1 byte), id bits (1 byte), number of documents and of blocks (4 bytes each); the CRC-32 of
all that follows; per document a flag (1 byte: it has a doc_id), doc_id (8), number of ids (4); per block the number of ids,
of 16-bit words, and the CRC-32 of its ids as unsigned 32-bit integers (4 each); then the blocks' words.

Texts are encoded whole: a task holds the ids of ``ROUND_IDS``, ``TEXT_BYTES`` of texts and the longest text. A null text counts as empty and has just the end id. Rows without a doc_id come first; rows of one doc_id in the order of a
hash of their text, so that they can lie on several partitions. Other columns are ignored. Empty tables give empty files.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrylane.llm.common import Batches, prepare, text_of
from ferrylane.llm.range_coder import BLOCK_IDS, decode_blocks, encode_blocks
from ferrylane.operators.ranking import planned_bytes, ranges_for

PACK_IDS = 16 * BLOCK_IDS
#: Ids that a task codes or decodes at once.
ROUND_IDS = 4096 * BLOCK_IDS
#: Bytes of input files for each task's range of documents.
RANGE_BYTES = 20 << 20
#: Bytes of texts that a task cuts into words at once, if none is longer.
TEXT_BYTES = 16 << 20
#: Words that a worker remembers the ids of; past it, it starts anew.
REMEMBERED_WORDS = 1_000_000
_MAGIC, _VERSION = b"TIDS", 2
_HEAD, _DOC, _BLOCK = struct.Struct("<4sBBIII"), np.dtype([("known", "u1"), ("doc_id", "<i8"), ("n", "<u4")]), np.dtype([("n", "<u4"), ("words", "<u4"), ("crc", "<u4")])
_UNCOMMON_SPACE = re.compile(r"[\x1c-\x1f]")
_KNOWN_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters of which it is known what they are, what NFC makes of them (nothing) and how they are lower-cased.
_KNOWN = "\t-\r -~À-ÖØ-öø-ÿ"
_SIMPLE, _NOT_SIMPLE = re.compile(f"[{_KNOWN}]*"), f"[^{_KNOWN}]"
#: What ``_KNOWN_CUT`` makes of them, and the break between two words.
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|\n|[0-9]|'(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{-~]+")


class CorruptPack(ValueError):
    """A pack whose checksums do not hold."""


def splits_at_spaces(spec: dict) -> bool:
    """Whether white space is dropped and no token reaches over it."""
    normalizer = spec.get("normalizer") or {}
    steps = normalizer.get("normalizers", [normalizer] if normalizer else [])
    plain = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} for n in steps)
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    dropped = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and r"[^\s" in first["pattern"].get("Regex", "")
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and " " not in t["content"] for t in spec.get("added_tokens", []))
    return plain and bool(dropped) and added and (spec.get("model") or {}).get("type") == "BPE"


def cuts_as_known(spec: dict) -> bool:
    """Whether lower-cased text is cut as ``_PIECES`` cuts it and each piece goes to the model by itself, in bytes."""
    steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (splits_at_spaces(spec) and "Lowercase" in steps and len(cuts) == 2 and cuts[0]["pattern"] == {"Regex": _KNOWN_CUT}
            and cuts[1]["type"] == "ByteLevel" and not cuts[1]["add_prefix_space"] and not cuts[1].get("use_regex", True)
            and not spec["model"].get("dropout"))


def _with_room(array: np.ndarray, n: int) -> np.ndarray:
    return array if n <= len(array) else np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), dtype=array.dtype)])


class _Numbers(dict):
    """Numbers keys as they are met; ``fresh`` holds those met since it was last emptied."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


class _Ids:
    """The ids of each number, in a row."""

    def __init__(self):
        self.numbers = _Numbers()
        self.flat, self.used, self.count = np.zeros(1 << 20, dtype=np.int32), 0, 0
        self.start, self.size = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)

    def add(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        used, count = self.used + len(ids), self.count + len(sizes)
        self.flat, self.start, self.size = _with_room(self.flat, used), _with_room(self.start, count), _with_room(self.size, count)
        self.flat[self.used:used] = ids
        self.start[self.count:count], self.size[self.count:count] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.count = used, count

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sizes and, one after the other, the ids."""
        size = self.size.take(numbers)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return size, self.flat.take(np.repeat(self.start.take(numbers) - ends + size, size) + np.arange(total))


def _numbers(keys: list[str], known: _Ids) -> np.ndarray:
    return np.fromiter(map(known.numbers.__getitem__, keys), dtype=np.int64, count=len(keys))


class WordEncoder:
    """Ids as the tokenizers library gives them, asking it once for each word or piece it meets again and again.

    Pieces are what the tokenizer's own expression makes of a lower-cased word; their ids come from the library's model alone.
    Words with other characters than those of ``_SIMPLE``, or with an added token, go through the whole library. Among the
    pieces such a word stands behind a space, which no piece has.
    """

    def __init__(self, tokenizer: bytes):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(tokenizer)
        self.by_word, self.by_piece = splits_at_spaces(spec), cuts_as_known(spec)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.model, self.in_bytes = self.tokenizer.model, {i: in_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(33, 256)}
        self.id_bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self._forget()

    def _forget(self) -> None:
        self.words, self.pieces = _Ids(), _Ids()
        # The break between two words is piece 0 and has no ids.
        _numbers(["\n"], self.pieces)
        self.pieces.numbers.fresh.clear()
        self.pieces.add(*_flat([[]]))

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _asked(self, pieces: list[str]) -> Iterator[list[int]]:
        whole, ask = iter(self._whole([p[1:] for p in pieces if p[0] == " "])), self.model.tokenize
        for piece in pieces:
            if piece[0] == " ":
                yield next(whole)
            else:
                yield [t.id for t in ask(piece if piece.isascii() else piece.translate(self.in_bytes))]

    def _cut(self, words: list[str]) -> list[str]:
        """The pieces of words, with a break between two words."""
        together = "\n".join(words)
        if self._simple(together):
            return _PIECES.findall(together.lower())
        out: list[str] = []
        for word in words:
            out += [*(_PIECES.findall(word.lower()) if self._simple(word) else [f" {word}"]), "\n"]
        return out[:-1]

    def _simple(self, text: str) -> bool:
        return _SIMPLE.fullmatch(text) is not None and not any(a in text for a in self.added)

    def _learn(self) -> None:
        """The ids of the words met last."""
        fresh = self.words.numbers.fresh
        for at in range(0, len(fresh), 4096):
            words = fresh[at:at + 4096]
            if not self.by_piece:
                self.words.add(*_flat(self._whole(words)))
                continue
            cut = self._cut(words)
            pieces = _numbers(cut, self.pieces)
            self.pieces.add(*_flat(list(self._asked(self.pieces.numbers.fresh))))
            self.pieces.numbers.fresh.clear()
            sizes, ids = self.pieces.of(pieces)
            ends = np.append(np.cumsum(sizes)[pieces == 0], len(ids))
            self.words.add(np.diff(ends, prepend=0), ids)
        fresh.clear()

    def encode(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.by_word:
            for ids in self._whole(texts.to_pylist()):
                yield np.array(ids, dtype=np.int32)
            return
        if self.words.count > REMEMBERED_WORDS:
            self._forget()
        odd = pc.match_substring_regex(texts, _NOT_SIMPLE)
        cut = pc.ascii_split_whitespace(pc.if_else(odd, "", texts))
        words = cut.flatten().dictionary_encode()
        number = _numbers(words.dictionary.to_numpy(zero_copy_only=False).tolist(), self.words).take(words.indices.to_numpy())
        numbers = np.split(number, np.cumsum(cut.value_lengths().to_numpy())[:-1])
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            text = texts[i].as_py()
            numbers[i] = _numbers(re.split(r"[ \n]+", text) if _UNCOMMON_SPACE.search(text) else text.split(), self.words)
        self._learn()
        for number in numbers[:len(texts)]:
            yield self.words.of(number)[1]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return sizes, np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(sizes.sum()))


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def _cut(ids: np.ndarray) -> list[np.ndarray]:
    """Blocks of about the same size, none over BLOCK_IDS."""
    return np.array_split(ids, -(-len(ids) // BLOCK_IDS)) if len(ids) else []


def write_packs(packs: list[list[tuple[int | None, np.ndarray]]], id_bits: int) -> list[bytes]:
    """The bytes of packs of (doc_id, ids), which are taken off the list."""
    cut, indexes = [], []
    while packs:  # ids are held once
        docs = packs.pop(0)
        indexes.append(np.array([(i is not None, i or 0, len(ids)) for i, ids in docs], dtype=_DOC))
        cut.append(_cut(np.concatenate([ids for _, ids in docs])))
    words = iter(encode_blocks([b for blocks in cut for b in blocks], id_bits))
    out = []
    for index, blocks in zip(indexes, cut, strict=True):
        coded = [next(words) for _ in blocks]
        table = np.array([(len(b), len(w), crc_of(b)) for b, w in zip(blocks, coded, strict=True)], dtype=_BLOCK)
        body = index.tobytes() + table.tobytes() + b"".join(w.astype("<u2").tobytes() for w in coded)
        out.append(_HEAD.pack(_MAGIC, _VERSION, id_bits, len(index), len(blocks), zlib.crc32(body)) + body)
    return out


def read_packs(packs: list[bytes]) -> list[list[tuple[int | None, np.ndarray]]]:
    """The (doc_id, ids) of packs; CorruptPack if a checksum fails."""
    heads, words, sizes, bits = [], [], [], set()
    for pack in packs:
        if len(pack) < _HEAD.size:
            raise CorruptPack("a pack is cut short")
        magic, version, id_bits, n_docs, n_blocks, crc = _HEAD.unpack_from(pack)
        if magic != _MAGIC or version != _VERSION or crc != zlib.crc32(pack[_HEAD.size:]):
            raise CorruptPack("a pack is damaged")
        index = np.frombuffer(pack, _DOC, n_docs, _HEAD.size)
        table = np.frombuffer(pack, _BLOCK, n_blocks, _HEAD.size + index.nbytes)
        stream = np.frombuffer(pack, "<u2", -1, _HEAD.size + index.nbytes + table.nbytes)
        words += np.split(stream, np.cumsum(table["words"].astype(np.int64))[:-1]) if n_blocks else []
        sizes += table["n"].tolist()
        heads.append((index, table))
        bits.add(id_bits)
    if len(bits) > 1:
        return [docs for pack in packs for docs in read_packs([pack])]
    blocks = iter(decode_blocks(words, sizes, bits.pop())) if bits else iter(())
    out = []
    for index, table in heads:
        own = [next(blocks) for _ in range(len(table))]
        if any(crc_of(b) != crc for b, crc in zip(own, table["crc"].tolist(), strict=True)):
            raise CorruptPack("a block is damaged")
        ids = np.concatenate([np.zeros(0, dtype=np.int32), *own])
        parts = np.split(ids, np.cumsum(index["n"].astype(np.int64))[:-1]) if len(index) else []
        out.append([(int(d["doc_id"]) if d["known"] else None, p) for d, p in zip(index, parts, strict=True)])
    return out


def _gathered(batches: Batches) -> Batches:
    """Batches put together until they have TEXT_BYTES."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= TEXT_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


_FILES = "part long, first long, n_ids long, pack binary"


def _packer(encoder: Callable[[], WordEncoder], end_id: int | None):
    def run(batches: Batches) -> Batches:
        words, part, first = encoder(), TaskContext.get().partitionId(), 0
        packs: list[list[tuple[int | None, np.ndarray]]] = []
        held = room = 0

        def written() -> pa.RecordBatch:
            nonlocal first, packs, held, room
            sizes = [sum(len(ids) for _, ids in docs) for docs in packs]
            firsts = (first + np.concatenate([[0], np.cumsum(sizes)])).tolist()
            coded = write_packs(packs, words.id_bits)
            first, packs, held, room = firsts[-1], [], 0, 0
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(coded), pa.int64()), pa.array(firsts[:-1], pa.int64()), pa.array(sizes, pa.int64()), pa.array(coded, pa.binary())],
                names=["part", "first", "n_ids", "pack"])

        for batch in _gathered(batches):
            doc_ids = batch.column(0).to_pylist()
            for doc_id, ids in zip(doc_ids, words.encode(batch.column(1)), strict=True):
                if end_id is not None:
                    ids = np.append(ids, np.int32(end_id))
                if room <= 0:
                    if held >= ROUND_IDS:
                        yield written()
                    packs.append([])
                    room = PACK_IDS
                packs[-1].append((doc_id, ids))
                room -= len(ids) + 1
                held += len(ids)
        if packs:
            yield written()

    return run


def _ranges(docs: DataFrame) -> list[int]:
    """How many ranges to deal documents over: large ones, because the coder's steps cost the less the more blocks there are,
    but enough for all cores. Nothing where the input's size isn't known."""
    session = docs.sparkSession
    least = min(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    wanted = ranges_for(planned_bytes(docs), RANGE_BYTES)
    return [max(wanted, least)] if wanted else []


_encoders: dict[int, WordEncoder] = {}


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents, each followed by ``end_id``, as files under ``path``."""
    spark = prepare(docs.sparkSession)
    with open(tokenizer_path, "rb") as file:
        tokenizer = file.read()
    shared, name = spark.sparkContext.broadcast(tokenizer), zlib.crc32(tokenizer)

    def encoder() -> WordEncoder:
        """One for each worker process and tokenizer: words met in one task serve the next."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if name not in _encoders:
            _encoders.clear()
            _encoders[name] = WordEncoder(shared.value)
        return _encoders[name]

    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    keyed = read.withColumn("tie", F.xxhash64("text"))
    dealt = keyed.repartitionByRange(*_ranges(docs), "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    dealt.mapInArrow(_packer(encoder, end_id), _FILES).write.parquet(path)


def _unpack(batches: Batches) -> Batches:
    def read(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        columns: dict[str, list] = {"part": [], "first": [], "doc_id": [], "ids": []}
        for (part, first, _), docs in zip(rows, read_packs([r[2] for r in rows]), strict=True):
            for doc_id, ids in docs:
                columns["part"].append(part)
                columns["first"].append(first)
                columns["doc_id"].append(doc_id)
                columns["ids"].append(ids)
                first += len(ids)
        offsets = np.concatenate([[0], np.cumsum([len(i) for i in columns["ids"]])]).astype(np.int32)
        values = np.concatenate([np.zeros(0, dtype=np.int32), *columns["ids"]])
        return pa.RecordBatch.from_arrays(
            [*[pa.array(columns[c], pa.int64()) for c in ("part", "first", "doc_id")], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
            names=["part", "first", "doc_id", "ids"])

    rows, held = [], 0
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("part", "first", "pack", "n_ids")], strict=True):
            rows.append(row[:3])
            held += row[3]
            if held >= ROUND_IDS:
                yield read(rows)
                rows, held = [], 0
    if rows:
        yield read(rows)


def _parts(files: DataFrame) -> DataFrame:
    """For each partition of the write the ids before it: one row each."""
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), ids."""
    files = prepare(spark).read.schema(_FILES).parquet(path)
    read = files.mapInArrow(_unpack, "part long, first long, doc_id long, ids array<int>")
    return read.join(_parts(files), "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "ids")


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""
    files = prepare(spark).read.schema(_FILES).parquet(path)

    def digest(batches: Batches) -> Batches:
        for batch in _unpack(batches):
            ids = batch.column(3)
            flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            crcs = [crc_of(flat[s:e]) for s, e in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(ends).astype(np.int64)), pa.array(crcs, pa.int64())],
                names=["part", "first", "doc_id", "n_tokens", "ids_crc32"])

    read = files.mapInArrow(digest, "part long, first long, doc_id long, n_tokens long, ids_crc32 long")
    return read.join(_parts(files), "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
