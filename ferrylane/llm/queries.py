"""The registered queries of this subpackage, with their SQL where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylane.llm import (
    chat, collisions, collocations, exact_dedup, minhash, mixing, pieces, secrets, spelling, token_counts, token_files, toxicity, vector_index)
from ferrylane.session import scratch_path

TOKEN_LIMIT = 512
END_ID = 2
MIX_SEED = 0
MERGE_DROPOUT, MERGE_SEED = 0.1, 0
NEAREST, QUERY_EVERY = 20, 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.text_classes(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.cut(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), MERGE_DROPOUT, MERGE_SEED)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache starts empty, in a folder of the call's own."""
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "token-cache"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weigh the square root of their rows; as many rows on average as there are."""
    return mixing.mix(table(spark, sf_dir, "documents"), seed=MIX_SEED)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return token_files.read_token_digests(spark, path)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_index.linked_vectors(table(spark, sf_dir, "embeddings"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by ``QUERY_EVERY`` is a query, every row a candidate."""
    return collisions.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0, NEAREST)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (
    op1_minhash_near_dedup, op2_chat_formatting, op3_exact_dedup, op4_sentencepiece, op5_secret_scan, op6_token_counts, op7_toxicity,
    op8_source_mixing, op9_token_files,
    op10_embedding_near_dedup, op11_collocations, op12_nearest_vectors, op13_spelling_variants)}
SQL = {
    "op2_chat_formatting": chat.CHAT_SQL,
    "op3_exact_dedup": exact_dedup.EQUAL_TEXTS_SQL,
    "op8_source_mixing": mixing.MIX_SQL,
    "op11_collocations": collocations.COLLOCATION_SQL,
}
