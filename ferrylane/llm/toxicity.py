"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

Labels are of documents; sentences have none. A logistic model gives each sentence a probability from the words
in it and their beginnings; the document's is the noisy-or of its sentences', 1 - product of (1 - p). The weights are fitted on
document labels through that product, so blame falls on the sentences that explain the labels, and those are what
``locate`` reports.

Which features there are is counted over all labelled training rows: all those whose presence goes with the label beyond
``MIN_ASSOCIATION`` (chi square) and multiplies its odds by ``MIN_ODDS_RATIO``, whatever share of the labels is toxic. Words are told
apart by 2 ** ``BUCKET_BITS`` buckets, so a rare word may share its bucket with others. The weights are fitted on a sample, drawn by
hash and weighed back to its share: of each label at most ``SAMPLE_ROWS`` documents that hold at most ``SAMPLE_HITS`` feature
numbers between them, whatever their texts' length. It holds feature numbers, not texts.

Null and empty texts, and texts without words, have no sentences and the score 0. Long texts are scored whole. With no
labels, or labels all alike, every sentence gets the same low or high probability. Null labels are left out; of labels that
contradict each other for one id, toxic counts. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane.llm.bloom import IdFilter
from ferrylane.llm.common import Batches, Workspace, batch_map, free_name, text_of
from ferrylane.llm.shingles import mix, text_bytes, _BASE, _BYTE_VALUES

BUCKET_BITS = 18
PREFIX_BYTES = (3, 4, 5, 6, 7, 8)
MIN_ASSOCIATION = 20.0
MIN_ODDS_RATIO = 2.0
SAMPLE_ROWS, SAMPLE_HITS = 10_000, 4_000_000
STEPS = 300
#: What a label takes in memory, and how much of them may be broadcast.
BYTES_PER_LABEL, MAX_BROADCAST_BYTES = 32, 64 << 20
#: Labels of documents whose crc32(id) leaves no rest by this are never learned from.
HELD_OUT = 5

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[*b".!?\n"]] = True


@dataclass
class Words:
    """The words of a batch of texts, in order. ``buckets``: (words, features), -1 where a word is too short."""

    buckets: np.ndarray
    sentence: np.ndarray
    sentence_text: np.ndarray
    sentence_start: np.ndarray
    sentence_end: np.ndarray


def words_of(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    letter = _LETTER[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = letter[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        empty = np.zeros(0, dtype=np.int64)
        return Words(np.zeros((0, 1 + len(PREFIX_BYTES)), dtype=np.int64), empty, empty, empty, empty)
    index = np.flatnonzero(letter)
    at = np.searchsorted(index, starts)
    lengths = np.diff(np.append(at, len(index)))
    place = np.arange(len(index)) - np.repeat(at, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
    summed = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE_VALUES[data[index]] * powers[place])])
    shift = np.uint64(64 - BUCKET_BITS)
    columns = [mix(summed[at + lengths] - summed[at] + np.uint64(1)) >> shift]
    for size in PREFIX_BYTES:
        ends = np.minimum(at + size, len(index))
        hashed = mix(summed[ends] - summed[at] + np.uint64(2 + size)) >> shift
        columns.append(np.where(lengths >= size, hashed.astype(np.int64), -1))
    borders = np.union1d(np.flatnonzero(_STOP[data]) + 1, offsets)
    number, sentence = np.unique(np.searchsorted(borders, starts, side="right") - 1, return_inverse=True)
    return Words(np.stack([c.astype(np.int64) for c in columns], axis=1), sentence,
                 np.searchsorted(offsets, borders[number], side="right") - 1, borders[number], borders[number + 1])


@dataclass
class Model:
    """Weights by bucket (0 for most) and the bias of every sentence."""

    weights: np.ndarray
    bias: float

    def sentence_logits(self, words: Words) -> np.ndarray:
        each = np.append(self.weights, 0.0)[words.buckets].sum(axis=1)
        return self.bias + np.bincount(words.sentence, each, minlength=len(words.sentence_text))

    def scores(self, texts: pa.Array) -> np.ndarray:
        words = words_of(texts)
        spared = np.bincount(words.sentence_text, -_softplus(self.sentence_logits(words)), minlength=len(texts))
        return -np.expm1(spared)


def _softplus(z: np.ndarray) -> np.ndarray:
    """-log(1 - sigmoid(z))"""
    return np.logaddexp(0.0, z)


#: Stands for all texts where buckets are counted.
EVERY_TEXT = -1


def _count_buckets(batches: Batches) -> Batches:
    """For each bucket that a task meets: texts with it, toxic texts with it."""
    size = 1 << BUCKET_BITS
    texts, toxic = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    n = np.zeros(2, dtype=np.int64)
    for batch in batches:
        words = words_of(batch.column(0))
        label = np.asarray(batch.column(1).to_pylist(), dtype=np.int64)
        n += (len(label), label.sum())
        text = np.broadcast_to(words.sentence_text[words.sentence][:, None], words.buckets.shape)
        met = np.unique((text * size + words.buckets)[words.buckets >= 0])
        texts += np.bincount(met % size, minlength=size)
        toxic += np.bincount(met % size, label[met // size], minlength=size).astype(np.int64)
    found = np.flatnonzero(texts)
    columns = [np.append(found, EVERY_TEXT), np.append(texts[found], n[0]), np.append(toxic[found], n[1])]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "texts", "toxic"])


def _features(ws: Workspace, labelled: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """The buckets that go with the label, and how many training texts there are of each label."""
    counts = labelled.select("text", "toxic").mapInArrow(_count_buckets, "bucket long, texts long, toxic long")
    counts = counts.groupBy("bucket").agg(F.sum("texts").cast("double").alias("k"), F.sum("toxic").cast("double").alias("t"))
    counts = ws.save(counts, "buckets")
    every = counts.where(F.col("bucket") == EVERY_TEXT).first()
    n_texts, n_toxic = (int(every.k), int(every.t)) if every else (0, 0)
    n, p = F.lit(float(n_texts)), F.lit(float(n_toxic))
    covered = F.col("k") * (n - F.col("k")) * p * (n - p)
    chi = n * F.pow(F.col("t") * n - F.col("k") * p, 2) / covered
    with_clean = F.col("k") - F.col("t")
    lifted = F.col("t") * (n - p - with_clean) >= MIN_ODDS_RATIO * with_clean * (p - F.col("t"))
    best = counts.where((F.col("bucket") >= 0) & (covered > 0) & (chi >= MIN_ASSOCIATION) & lifted)
    found = np.array(sorted(row.bucket for row in best.select("bucket").collect()), dtype=np.int64)
    return found, {0: n_texts - n_toxic, 1: n_toxic}


_SAMPLE = "toxic int, n_sentences int, sentence array<int>, feature array<int>"


def _sampled(features: np.ndarray):
    """Texts as their sentences' feature numbers; sentences without any are only counted."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(batch.column(0))
        number = np.searchsorted(features, words.buckets)
        hit = np.isin(words.buckets, features)
        text = words.sentence_text[words.sentence]
        out = {"n": np.bincount(words.sentence_text, minlength=batch.num_rows), "s": [], "f": []}
        row, _ = np.nonzero(hit)
        ends = np.searchsorted(text[row], np.arange(batch.num_rows + 1))
        hits = number[hit]
        for start, end in zip(ends[:-1], ends[1:], strict=True):
            out["s"].append(words.sentence[row[start:end]])
            out["f"].append(hits[start:end])
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column(1).cast(pa.int32()), pa.array(out["n"], pa.int32()), pa.array(out["s"], ints), pa.array(out["f"], ints)],
            names=["toxic", "n_sentences", "sentence", "feature"])

    return batch_map(run)


def _fit(sample: pd.DataFrame, n_features: int, share: dict[int, float]) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the whole sample; ``share``: how many texts a sampled one of each label stands for."""
    label = sample.toxic.to_numpy(dtype=float)
    rate = float(np.average(label, weights=sample.toxic.map(share))) if len(sample) else 0.0
    if not 0 < rate < 1 or not n_features:
        sentences = max(1.0, float(sample.n_sentences.mean())) if len(sample) else 1.0
        spared = np.clip(1 - rate, 1e-6, 1 - 1e-6) ** (1 / sentences)
        return np.zeros(n_features), float(np.log((1 - spared) / spared))
    text = np.repeat(np.arange(len(sample)), sample.feature.map(len))
    within = np.concatenate(sample.sentence.to_list()).astype(np.int64)
    feature = np.concatenate(sample.feature.to_list()).astype(np.int64)
    width = int(within.max(initial=0)) + 1
    sentences, sentence = np.unique(text * width + within, return_inverse=True)
    owner = sentences // width
    plain = sample.n_sentences.to_numpy(dtype=float) - np.bincount(owner, minlength=len(sample))
    weigh = sample.toxic.map(share).to_numpy(dtype=float)
    weigh /= weigh.sum()
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(rate / max(1.0, sample.n_sentences.mean()))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = theta[-1] + np.bincount(sentence, theta[feature], minlength=len(owner))
        spared = np.bincount(owner, _softplus(z), minlength=len(sample)) + plain * _softplus(theta[-1])
        # d loss / d (sum of softplus): 1 for clean texts, -(1 - P) / P for toxic ones.
        pull = weigh * np.where(label > 0, -1 / np.expm1(np.maximum(spared, 1e-9)), 1.0)
        each = pull[owner] / (1 + np.exp(-z))
        gradient = np.append(np.bincount(feature, each[sentence], minlength=n_features),
                             each.sum() + (pull * plain).sum() / (1 + np.exp(-theta[-1])))
        gradient[:-1] += 1e-5 * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        theta -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % HELD_OUT == 0


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on the labels (columns doc_id and toxic) of documents that are not held out."""
    ws = Workspace(docs.sparkSession, "toxicity")
    known = labels.where(F.col("toxic").isNotNull() & ~held_out()).groupBy(F.col("doc_id").alias("label_id")).agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    known = ws.save(known, "labels")
    read = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    features, totals = _features(ws, _labelled(read, known))
    drawn = [known.where(F.col("toxic") == label).orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE_ROWS) for label in (0, 1)]
    rows = _labelled(read, ws.save(drawn[0].unionByName(drawn[1]), "sample"))
    sample = _bounded(ws, rows.select("text", "toxic").mapInArrow(_sampled(features), _SAMPLE)).toPandas()
    sampled = sample.toxic.value_counts().to_dict()
    weights, bias = _fit(sample, len(features), {k: totals[k] / n for k, n in sampled.items()})
    spread = np.zeros(1 << BUCKET_BITS)
    spread[features] = weights
    return Model(spread, bias)


def _bounded(ws: Workspace, sample: DataFrame) -> DataFrame:
    """Of each label as many rows, in the order of a hash, as hold no more than ``SAMPLE_HITS`` features between them."""
    hits = F.size("feature")
    # Some ten thousand rows of each label at most, so that one task can order each.
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("feature", "sentence"), hits).rowsBetween(Window.unboundedPreceding, 0)
    summed = ws.save(sample.withColumn("so_far", F.sum(hits).over(order)), "hits")
    return summed.where(F.col("so_far") <= SAMPLE_HITS).drop("so_far")


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the documents that have a label (columns label_id, toxic).

    Labels are broadcast if there are few enough, by count, so that texts stay where they are. Else texts whose id
    is not among them are filtered out before the rest is shuffled.
    """
    if labels.count() * BYTES_PER_LABEL <= MAX_BROADCAST_BYTES:
        return docs.join(F.broadcast(labels), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")
    flagged = docs.withColumn("may_have", IdFilter(labels.select("label_id")).may_hold("doc_id")).where("may_have")
    return flagged.join(labels, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")


def score(model: Model, spark):
    """A column function: the score of a text."""
    shared = spark.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.clip(shared.value.scores(pa.array(texts, pa.string())), 0.0, 1.0))

    return F.pandas_udf(run, "double")


SENTENCE = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("probability", T.DoubleType())]))


def locate(docs: DataFrame, model: Model, at_least: float = 0.5, text: str = "text", into: str = "offending") -> DataFrame:
    """``docs`` with the sentences whose own probability is high enough, by code points, ends exclusive."""
    shared, into, at = docs.sparkSession.sparkContext.broadcast(model), free_name(docs, into), docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, SENTENCE)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(batch.column(at))
        data, offsets = text_bytes(batch.column(at))
        logits = shared.value.sentence_logits(words)
        found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        for i in np.flatnonzero(logits >= np.log(at_least / (1 - at_least))):
            begin = offsets[words.sentence_text[i]]
            start = len(data[begin:words.sentence_start[i]].tobytes().decode())
            length = len(data[words.sentence_start[i]:words.sentence_end[i]].tobytes().decode())
            found[words.sentence_text[i]].append(
                {"start": start, "end": start + length, "probability": float(1 / (1 + np.exp(-logits[i])))})
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], schema=pa.schema([*batch.schema, pa.field(into, kind)]))

    return docs.mapInArrow(batch_map(run), schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels)
    rated = docs.select("doc_id", held_out().alias("held_out"), score(model, docs.sparkSession)(text_of()).alias("score"))
    return rated.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted toxic."""
    model, name = train(docs, labels), free_name(docs, "score")
    return docs.withColumn(name, score(model, docs.sparkSession)(text_of())).where(F.col(name) < 0.5).select(*docs.columns)
