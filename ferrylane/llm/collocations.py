"""Phrase collocations from count transducers.

A phrase that occurs often enough has only parts that do. So phrases are mined by length: a pass over the texts names, by hash, the
words that may occur often; the next builds their count transducers and counts the hashes of the word pairs of which both halves
may, and so on. Hashes only choose what is looked at, counts come from the words themselves. From pairs on what is passed on are the
stretches of text in which every phrase so far may be frequent, so that later passes read little.

Within a task phrases are counted, sorted and made into minimal weighted automata by language and prefix range (a range of hashes of
the first two words). Automata of one range are united, about ``FAN_IN`` at a time, their weights summed. The counts of a phrase's
parts are looked up by composing the automaton of all parts that are asked for in a range with that of the counts.

Phrases of one length that may be frequent are known to tasks as a Bloom filter of at most ``bloom.MAX_BITS`` bits (32 MB): a fuller one
lets more through to the automata and loses none. Equal phrases are told by 64-bit hashes inside one Arrow batch (2 MB of text, or one
text), by their words beyond it. A task holds ``HELD_PHRASES`` phrases and ``HELD_HASHES`` hashes, and some 60 bytes per byte of the
longest text.

Defined results: a null text is empty, a null language ``und``. Whole texts are read. Rows count as often as they occur, whatever
their ids. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrylane.llm import bloom
from ferrylane.llm.common import Batches, Workspace, text_of
from ferrylane.llm.shingles import mix, text_bytes, word_hashes
from ferrylane.llm.transducers import COLUMNS, Transducer, arrays, build, union

LEAST_COUNT, MOST_WORDS, SHOWN, NO_LANGUAGE = 100, 5, 2000, "und"
#: Phrases that a prefix range is meant to hold, and automata that are united in one go.
RANGE_PHRASES, FAN_IN = 1 << 16, 32
#: What a task gathers before it hands it on.
HELD_PHRASES, HELD_HASHES, HELD_BYTES = 200_000, 1 << 22, 1 << 20
#: Up to so many hashes are gathered to fill a filter in the driver; more fill it in tasks.
GATHERED = 1 << 20
BITS_PER_PHRASE = 32
#: A language's best phrases are picked in so many parts first.
PARTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_GAP, _CUT = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP[[0x20, 0x09]] = True
_GAP |= _CUT
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The words of several texts: where they lie in ``data``, the text that each is in, which are followed by one in the same piece."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    followed: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def span(self, first: int, last: int) -> str:
        return self.data[self.starts[first]:self.ends[last]].tobytes().decode()


def read_words(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    gap = _GAP[data]
    first, last = ~gap, ~gap
    first[1:] &= gap[:-1]
    last[:-1] &= gap[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = ~gap[begins]
    closes = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[closes] = ~gap[closes]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(_CUT[data])[starts] if len(starts) else np.zeros(0, np.int64)
    followed = np.zeros(len(starts), dtype=bool)
    followed[:-1] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
    hashes, _ = word_hashes(np.where(gap, np.uint8(0x20), data), offsets)
    return Words(data, starts, ends, text, followed, hashes)


def _language_hashes(languages: list[str]) -> np.ndarray:
    known = {lang: int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little") for lang in set(languages)}
    return np.array([known[lang] for lang in languages], dtype=np.uint64)


def _phrase_hashes(words: Words, languages: list[str], upto: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For lengths 1 to ``upto``: a hash of the phrase at each word, and whether one is there. Languages have hashes of their own."""
    own = _language_hashes(languages)[words.text] if len(words) else np.zeros(0, np.uint64)
    levels = [(mix(words.hashes + own), np.ones(len(words), dtype=bool))]
    for n in range(2, upto + 1):
        shorter, there = levels[-1]
        longer, goes_on = np.zeros_like(shorter), np.zeros_like(there)
        k = len(words) - n + 1
        if k > 0:
            longer[:k] = mix(shorter[:k] * _STEP + words.hashes[n - 1:])
            goes_on[:k] = there[:k] & words.followed[n - 2:n - 2 + k]
        levels.append((longer, goes_on))
    return levels


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    mask = np.uint64(bits - 1)
    return np.column_stack([hashes & mask, mix(hashes ^ _STEP) & mask])


class Frequent:
    """A filter of the hashes that were counted often enough."""

    def __init__(self, ws: Workspace, counts: DataFrame, least: int, name: str):
        kept = ws.save(counts.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("hash"), name)
        self.size = kept.count()
        self.bits = bloom.filter_bits(self.size, BITS_PER_PHRASE, bloom.MAX_BITS)
        if self.size <= GATHERED:
            flags = np.zeros(self.bits, dtype=bool)
            flags[_places(kept.toPandas()["hash"].to_numpy().view(np.uint64), self.bits).ravel().astype(np.int64)] = True
            filled = np.packbits(flags).tobytes()
        else:
            filled = bloom.filter_of(kept.mapInArrow(_as_digests, "digest binary"), self.bits)
        self.shared = ws.spark.sparkContext.broadcast(filled)
        #: Prefix ranges are told by so many bits.
        self.range_bits = max(0, (self.size // RANGE_PHRASES).bit_length())


def _as_digests(batches: Batches) -> Batches:
    for batch in batches:
        hashes = batch.column(0).to_numpy().view(np.uint64)
        pairs = np.column_stack([hashes, mix(hashes ^ _STEP)]).astype("<u8")
        yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in pairs], pa.binary())], names=["digest"])


def _gathered(batches: Batches) -> Batches:
    """Small batches put together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= HELD_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches([b for b in held if b.num_rows]).combine_chunks().to_batches()[0]


_HASH, _TOTAL, _AUTOMATON, _STRETCH = range(4)
_MADE = f"kind int, lang string, n long, hash long, text string, prefix int, shard long, {COLUMNS}"
_AUTOMATON_FIELDS = [part.split()[0] for part in COLUMNS.split(", ")]


def _made(kind: int, rows: int, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of one kind; the columns that it doesn't use are null."""
    plain = {"kind": pa.int32(), "lang": pa.string(), "n": pa.int64(), "hash": pa.int64(), "text": pa.string(), "prefix": pa.int32(), "shard": pa.int64()}
    lists = dict(zip(_AUTOMATON_FIELDS, (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True))
    kinds = plain | {name: pa.list_(value) for name, value in lists.items()}
    columns = {"kind": pa.array(np.full(rows, kind, dtype=np.int32)), **columns}
    return pa.RecordBatch.from_arrays([columns[k] if k in columns else pa.nulls(rows, t) for k, t in kinds.items()], names=list(kinds))


class _Hashes:
    """Hashes gathered and counted."""

    def __init__(self) -> None:
        self.held: list[np.ndarray] = []

    def add(self, hashes: np.ndarray) -> bool:
        """Whether it is time to hand them on."""
        self.held.append(hashes)
        return sum(map(len, self.held)) >= HELD_HASHES

    def emit(self) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.held]), return_counts=True)
        self.held = []
        return _made(_HASH, len(values), hash=pa.array(values.view(np.int64)), n=pa.array(counts.astype(np.int64)))


def _count_words(batches: Batches) -> Batches:
    """The hashes of all words with their counts, and how many words each language has."""
    hashes, totals = _Hashes(), Counter()
    for batch in _gathered(batches):
        languages, words = batch.column(0).to_pylist(), read_words(batch.column(1))
        for lang, n in zip(languages, np.bincount(words.text, minlength=len(languages)).tolist(), strict=True):
            totals[lang] += n
        if hashes.add(_phrase_hashes(words, languages, 1)[0][0]):
            yield hashes.emit()
    yield hashes.emit()
    yield _made(_TOTAL, len(totals), lang=pa.array(list(totals), pa.string()), n=pa.array(list(totals.values()), pa.int64()))


def prefix_range(words: tuple[str, ...], bits: int) -> int:
    return zlib.crc32(" ".join(words[:2]).encode()) >> (32 - bits)


class _Phrases:
    """Phrases counted by language, made into automata by prefix range."""

    def __init__(self, range_bits: int):
        self.range_bits, self.held, self.handed = range_bits, Counter(), 0

    def emit(self) -> pa.RecordBatch:
        dealt: dict[tuple[str, int], list] = defaultdict(list)
        for (lang, phrase), n in self.held.items():
            words = tuple(phrase.split(" "))
            dealt[lang, prefix_range(words, self.range_bits)].append((words, n))
        self.held.clear()
        self.handed += 1
        shard = (TaskContext.get().partitionId() << 24) + self.handed
        keys = sorted(dealt)
        columns = arrays(build(sorted(dealt[key])) for key in keys)
        return _made(_AUTOMATON, len(keys), lang=pa.array([k[0] for k in keys], pa.string()), prefix=pa.array([k[1] for k in keys], pa.int32()),
                     shard=pa.array([shard] * len(keys), pa.int64()), **dict(zip(_AUTOMATON_FIELDS, columns, strict=True)))


def _mine(n: int, filled, bits: int, range_bits: int, passes_on: bool):
    """Automata of the phrases of ``n`` words that may be frequent; hashes of those of one word more whose parts may;
    with ``passes_on`` the stretches of text that hold such."""
    def run(batches: Batches) -> Batches:
        phrases, hashes, bitmap = _Phrases(range_bits), _Hashes(), filled.value
        for batch in _gathered(batches):
            languages, words = batch.column(0).to_pylist(), read_words(batch.column(1))
            levels = _phrase_hashes(words, languages, min(n + 1, MOST_WORDS))
            own, there = levels[n - 1]
            may = there.copy()
            may[there] = bloom.holds(bitmap, _places(own[there], bits))
            at = np.flatnonzero(may)
            _, place, counts = np.unique(own[at], return_index=True, return_counts=True)
            for i, count in zip(at[place].tolist(), counts.tolist(), strict=True):
                # Spaces and tabs between the words, any number of them, become one space.
                phrases.held[languages[words.text[i]], " ".join(words.span(j, j) for j in range(i, i + n))] += count
            if len(phrases.held) >= HELD_PHRASES:
                yield phrases.emit()
            if n == MOST_WORDS:
                continue
            longer, there = levels[n]
            on = there & may
            on[:-1] &= may[1:]
            if hashes.add(longer[on]):
                yield hashes.emit()
            if passes_on:
                edges = np.diff(on.astype(np.int8), prepend=0, append=0)
                begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                found = [words.span(b, e - 1 + n) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield _made(_STRETCH, len(found), text=pa.array(found, pa.string()),
                            lang=pa.array([languages[words.text[b]] for b in begins.tolist()], pa.string()))
        yield phrases.emit()
        yield hashes.emit()

    return run


_UNITED = f"size int, lang string, prefix int, shard long, {COLUMNS}"


def _unite(least: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        one = union((Transducer.from_row(row) for row in rows), least)
        head = {name: table[name][:1].combine_chunks() for name in ("size", "lang", "prefix", "shard")}
        return pa.table([*head.values(), *arrays([one])], names=[*head, *_AUTOMATON_FIELDS])

    return run


def _united(ws: Workspace, automata: DataFrame, least: int) -> DataFrame:
    """One automaton for each size, language and prefix range; phrases of less than ``least`` go in the end."""
    where = ["size", "lang", "prefix"]
    while True:
        most = automata.groupBy(*where).count().agg(F.max("count")).first()[0] or 0
        groups = max(1, -(-most // FAN_IN))
        dealt = automata.withColumn("shard", F.pmod(F.xxhash64("shard", F.lit(groups)), F.lit(groups)))
        automata = ws.save(dealt.groupBy(*where, "shard").applyInArrow(_unite(least if groups == 1 else 0), _UNITED), "united")
        if groups == 1:
            return automata


def _spell_out(batches: Batches) -> Batches:
    """The phrases of automata with their counts."""
    for batch in batches:
        for row in batch.to_pylist():
            items = list(Transducer.from_row(row).items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["size"]] * len(items), pa.int32()), pa.array([row["lang"]] * len(items), pa.string()),
                 pa.array([" ".join(key) for key, _ in items], pa.string()), pa.array([n for _, n in items], pa.int64())], names=["size", "lang", "phrase", "a"])


_LOOKED_UP = "lang string, part string, f long"


def _look_up(asked: pa.Table, automata: pa.Table) -> pa.Table:
    """The counts of the parts asked for in one prefix range."""
    found: list[tuple[str, int]] = []
    if asked.num_rows:
        wanted = build(sorted((tuple(part.split(" ")), 0) for part in asked["part"].to_pylist()))
        for row in automata.to_pylist():
            found += [(" ".join(key), n) for key, n in Transducer.from_row(row).compose(wanted)]
    lang = asked["lang"][0].as_py() if asked.num_rows else None
    return pa.table([pa.array([lang] * len(found), pa.string()), pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())],
                    names=["lang", "part", "f"])


def _parts(words: str, first: str, length: str):
    return F.expr(f"array_join(slice({words}, {first}, {length}), ' ')")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, shown: int = SHOWN) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    ws = Workspace(docs.sparkSession, "collocations")
    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), text_of(text).alias("text"))
    made = ws.save(read.mapInArrow(_count_words, _MADE), "words")
    totals = ws.save(made.where(f"kind = {_TOTAL}").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    automata, range_bits = None, {}
    for n in range(1, MOST_WORDS + 1):
        frequent = Frequent(ws, made.where(f"kind = {_HASH}").select("hash", "n"), least, f"frequent-{n}")
        if not frequent.size:
            break
        range_bits[n] = frequent.range_bits
        source = read if n <= 2 else made.where(f"kind = {_STRETCH}").select("lang", "text")
        mined = ws.save(source.mapInArrow(_mine(n, frequent.shared, frequent.bits, frequent.range_bits, 1 < n < MOST_WORDS), _MADE), f"mined-{n}")
        own = mined.where(f"kind = {_AUTOMATON}").select(F.lit(n).alias("size"), "lang", "prefix", "shard", *_AUTOMATON_FIELDS)
        own = ws.save(own, f"automata-{n}")
        automata = own if automata is None else automata.unionByName(own)
        ws.drop(made)  # its hashes and stretches have been used
        made = mined
    ws.drop(made)
    if automata is None:
        return ws.spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    automata = _united(ws, automata, least)
    phrases = ws.save(automata.mapInArrow(_spell_out, "size int, lang string, phrase string, a long").where("size > 1"), "phrases")
    # No phrase occurs more often than its parts, so one that is covered at all is covered by one of one word more.
    words = phrases.withColumn("words", F.split("phrase", " "))
    inner = F.array(_parts("words", "1", "size - 1"), _parts("words", "2", "size - 1"))
    covers = words.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    stays = words.join(covers, ["lang", "phrase"], "left").where("cover IS NULL OR cover < a")
    cuts = stays.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang", "phrase", "a", "k", _parts("words", "1", "k").alias("first"), _parts("words", "k + 1", "size - k").alias("rest"))
    cuts = ws.save(cuts, "cuts")
    counts = ws.save(_counts_of_parts(cuts, automata, range_bits), "parts")
    first = counts.withColumnsRenamed({"part": "first", "f": "l"})
    rest = counts.withColumnsRenamed({"part": "rest", "f": "r"})
    wide = "CAST({} AS DECIMAL(38, 0))"
    score = F.expr(f"({wide.format('a')} * n * 1000) div ({wide.format('l')} * r)")
    valued = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang").withColumn("score", score)
    weakest = valued.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    return _best(ws.save(weakest, "scored"), shown)


def _counts_of_parts(cuts: DataFrame, automata: DataFrame, range_bits: dict[int, int]) -> DataFrame:
    """(lang, part, f) of all first and other parts. Each is in just one prefix range, that of its own length."""
    asked = cuts.select("lang", F.explode(F.array("first", "rest")).alias("part")).distinct()
    words = asked.withColumn("w", F.split("part", " "))
    bits = F.coalesce(*[F.when(F.size("w") == n, F.lit(b)) for n, b in range_bits.items()])
    hashed = words.withColumns({"bits": bits, "crc": F.crc32(_parts("w", "1", "2").cast("binary"))})
    asked = hashed.select(F.size("w").alias("size"), "lang", F.expr("CAST(shiftright(crc, 32 - bits) AS int)").alias("prefix"), "part")
    return asked.groupBy("size", "lang", "prefix").cogroup(automata.groupBy("size", "lang", "prefix")).applyInArrow(_look_up, _LOOKED_UP)


def _best(scored: DataFrame, shown: int) -> DataFrame:
    """The first of each language; of each part of it first, so that no task orders all of a language."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    few = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= shown)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= shown)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATION_SQL = f"""
WITH texts AS (
    SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM texts),
totals AS (SELECT lang, cast(sum(len(w)) AS bigint) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
    SELECT lang, s AS size, w[i:i + s - 1] AS words, count(*) AS f
    FROM places, (SELECT unnest(range(1, {MOST_WORDS + 1})) AS s) WHERE i + s - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {LEAST_COUNT}),
candidates AS (SELECT lang, size, words, f AS a FROM grams WHERE size > 1),
covered AS (
    SELECT DISTINCT lang, words[i:i + s - 1] AS words, a
    FROM candidates, (SELECT unnest(range(2, {MOST_WORDS})) AS s), (SELECT unnest(range(1, {MOST_WORDS})) AS i) WHERE s < size AND i + s - 1 <= size),
staying AS (SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = c.lang AND v.words = c.words AND 100 * v.a >= 100 * c.a)),
cuts AS (
    SELECT c.lang, c.words, c.a, k, x.f AS l, y.f AS r, n, cast((1000::hugeint * a * n) // (x.f::hugeint * y.f) AS bigint) AS score
    FROM staying c, (SELECT unnest(range(1, {MOST_WORDS})) AS k), grams x, grams y, totals t
    WHERE k < c.size AND x.lang = c.lang AND x.words = c.words[1:k] AND y.lang = c.lang AND y.words = c.words[k + 1:c.size] AND t.lang = c.lang),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
named AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score FROM weakest)
SELECT lang, cast(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS bigint) AS rank, phrase, a, l, r, n, score
FROM named QUALIFY rank <= {SHOWN}
"""
