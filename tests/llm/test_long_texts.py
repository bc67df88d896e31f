"""Texts of a megabyte, whole: what the operators make of them is what short texts say it should be."""

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ferrylane.llm import exact_dedup, minhash, secrets, token_counts, token_files, toxicity
from ferrylane.session import scratch_path

LONG = " ".join(f"w{i % 9973}x{i % 7}" for i in range(130_000))
SECRET = " password = hunter2hunter2"


@pytest.fixture(scope="module")
def long_texts(llm):
    assert len(LONG) > 1_000_000
    rows = [(1, LONG), (2, LONG.upper()), (3, LONG + " and one more" + SECRET), (4, "short"), (5, "eyJ" * 350_000), (6, "a" * 1_000_000)]
    return llm.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_dedup_reads_all_of_them(long_texts):
    near = {r.doc_id: r for r in minhash.near_duplicates(long_texts).collect()}
    assert [near[i].component_id for i in range(1, 7)] == [1, 1, 1, 4, 5, 6] and near[3].n_shingles == near[1].n_shingles + 6
    exact = {r.doc_id: r.keep_id for r in exact_dedup.equal_texts(long_texts).collect()}
    assert exact == {1: 2, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}


def test_scans_and_scores_reach_the_end(llm, long_texts):
    spans = {r.doc_id: r.secrets for r in secrets.find_secrets(long_texts).collect()}
    assert [(s.kind, s.start) for s in spans[3]] == [("assign", len(LONG) + len(" and one more "))] and not spans[1] and not spans[5]
    labels = llm.createDataFrame([(i, int(i == 3)) for i in range(1, 7)], "doc_id long, toxic int")
    assert toxicity.scored(long_texts, labels).where("score BETWEEN 0 AND 1").count() == 6


def test_tokens_are_counted_and_stored_whole(llm, long_texts, path_of):
    texts = {r.doc_id: r.text for r in long_texts.collect()}
    bytes_, words = (Tokenizer.from_file(path_of(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    counted = token_counts.count_tokens(long_texts, path_of("byte_bpe_50k.json"), scratch_path(llm, "cache"))
    assert {r.doc_id: r.n_tokens for r in counted.collect()} == {i: len(bytes_.encode(t, add_special_tokens=False)) for i, t in texts.items()}
    path = scratch_path(llm, "files")
    token_files.write_tokens(long_texts.where(F.col("doc_id") != 6), path, path_of("word_bpe_49k.json"), 2)
    stored = {r.doc_id: r.n_tokens for r in token_files.read_token_digests(llm, path).collect()}
    assert stored == {i: len(words.encode(t, add_special_tokens=False)) + 1 for i, t in texts.items() if i != 6}
