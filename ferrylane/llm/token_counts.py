"""Token counts through a digest cache: only distinct contents that it lacks are encoded, and then stored.

The cache is a Parquet table (version, content, n_tokens): ``version`` is the digest of the tokenizer file, ``content``
that of the normalised text. Null counts as empty; nothing else is folded, since any other change may change the count.
Reading tolerates keys that were stored twice, as two runs at once may do.

Copies are dropped within each task before texts are dealt by content, so a hot text is moved once per task; counts
are joined back on digests alone. Empty tables give empty results and leave the cache as it is. Texts are encoded whole,
however long, each by one call of the library or word by word. Other columns are not looked at; rows count one by one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylane.llm.common import Batches, Workspace, text_of
from ferrylane.storage import exists

#: Words that a worker remembers the counts of; past it, it starts anew.
REMEMBERED_WORDS = 400_000
#: Up to so many missing digests may be held in hash tables, all partitions' together; beyond, the planner picks a join that spills.
HASHED_ROWS = 4_000_000
_CACHE = "version string, content binary, n_tokens long"
_SPACE_AFTER_SPACE = re.compile(r"\s ")


def version_of(tokenizer: bytes) -> str:
    return hashlib.sha256(tokenizer).hexdigest()


def splits_at_spaces(tokenizer: bytes) -> bool:
    """Whether no token can reach over the place before a space that follows a character which isn't one.

    So it is for byte-level tokenizers with the usual expression, no normaliser and no greedy added tokens.
    """
    spec = json.loads(tokenizer)
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and " " not in t["content"] for t in spec.get("added_tokens", []))
    return plain and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"]


def segments(text: str) -> list[str]:
    """The text cut before every space that follows a character which isn't one."""
    parts = text.split(" ")
    if parts[0] and not _SPACE_AFTER_SPACE.search(text):
        return [parts[0], *[f" {p}" for p in parts[1:]]]
    out, held = [], parts[0]
    for part in parts[1:]:
        if held and not held[-1].isspace():
            out.append(held)
            held = f" {part}"
        else:
            held += f" {part}"
    return [*out, held] if held else out


class Counter:
    """Counts tokens as the tokenizers library does, asking it once for each word it meets again and again."""

    def __init__(self, tokenizer: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_segment = splits_at_spaces(tokenizer)
        self.known: dict[str, int] = {}

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: Iterable[str]) -> list[int]:
        if not self.by_segment:
            return self._encode(list(texts))
        cut = [segments(t) for t in texts]
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        new = list({s for c in cut for s in c if s not in self.known})
        self.known.update(zip(new, self._encode(new), strict=True))
        known = self.known
        return [sum([known[s] for s in c]) for c in cut]


_counters: dict[str, Counter] = {}


def _counter(tokenizer: bytes, version: str) -> Counter:
    """One for each worker process and tokenizer: words met in one task serve the next."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if version not in _counters:
        _counters.clear()
        _counters[version] = Counter(tokenizer)
    return _counters[version]


def _first_of_each(batches: Batches) -> Batches:
    """Drops contents that the task has had."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for content in batch.column(0).to_pylist():
            keep.append(content not in seen)
            seen.add(content)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _encode(shared, version: str):
    def run(batches: Batches) -> Batches:
        counter, seen = _counter(shared.value, version), set()
        for batch in batches:
            texts = {}
            for content, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if content not in seen:
                    texts[content] = text
            seen.update(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(texts), pa.string()), pa.array(list(texts), pa.binary()), pa.array(counter.counts(texts.values()), pa.int64())],
                names=["version", "content", "n_tokens"])

    return run


def content_of(text: str = "text"):
    return F.unhex(F.sha2(text_of(text).cast("binary"), 256))


def cached_counts(cache: DataFrame, version: str) -> DataFrame:
    return cache.where(F.col("version") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens. Encodes and stores what the cache lacks."""
    spark = docs.sparkSession
    ws = Workspace(spark, "token-counts")
    with open(tokenizer_path, "rb") as file:
        tokenizer = file.read()
    version, shared = version_of(tokenizer), spark.sparkContext.broadcast(tokenizer)
    read = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    keyed = ws.save(read.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), content_of().alias("content")), "keys")

    stored = spark.read.schema(_CACHE).parquet(cache_path) if exists(spark, cache_path) else spark.createDataFrame([], _CACHE)
    contents = ws.save(keyed.select("content").distinct(), "contents")
    missing = ws.save(contents.join(stored.where(F.col("version") == version), "content", "left_anti"), "missing")
    n_missing = missing.count()
    if n_missing:
        once = read.select(content_of().alias("content"), "text").mapInArrow(_first_of_each, "content binary, text string")
        lacking = once.join(missing.hint("shuffle_hash") if n_missing <= HASHED_ROWS else missing, "content", "left_semi")
        lacking.mapInArrow(_encode(shared, version), _CACHE).write.mode("append").parquet(cache_path)
        stored = spark.read.schema(_CACHE).parquet(cache_path)
    counts = ws.save(cached_counts(stored.join(contents, "content", "left_semi"), version), "counts")
    return keyed.join(counts, "content").select("doc_id", "n_bytes", "n_tokens")
