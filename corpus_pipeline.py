"""Documents made ready for training: toxicity, exact dedup, near-dedup, mixing, pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ferrylane.llm import exact_dedup, minhash, mixing, pieces, toxicity
from ferrylane.llm.common import Workspace
from ferrylane.llm.queries import MERGE_DROPOUT, MERGE_SEED, MIX_SEED


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; the model learns from the labels table."""
    return toxicity.clean_only(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, the document with the smallest id."""
    return minhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight, in random order."""
    return mixing.mix(docs, seed=MIX_SEED).select(*docs.columns)


def cut_into_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text. Copies of one document are cut each in its own way."""
    return pieces.cut(docs, public_tokenizers.path("piece_bpe_32k.model"), MERGE_DROPOUT, MERGE_SEED, copies_differ=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", cut_into_pieces),
]
#: Neither a fitted model nor merge-dropout can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to shared storage for the next."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
