"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from checks.compare import duckdb_rows, duckdb_with, spark_rows
from ferrylane.llm import toxicity
from ferrylane.llm.queries import QUERIES, SQL
from test_dedup import folded, grouped, similar

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(llm, name):
    assert spark_rows(QUERIES[name](llm, SF_DIR)) == duckdb_rows(duckdb_with(SF_DIR), SQL[name])


def test_everything_is_registered():
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_stages_of_the_pipeline(llm):
    docs = llm.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = llm.read.parquet(f"{SF_DIR}/labels.parquet")
    held, kept = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held[name] = kept.toPandas()
        kept = llm.createDataFrame(stage(llm, kept, SF_DIR).toPandas(), docs.schema)
        assert kept.columns == docs.columns
        held[name] = (held[name], kept.toPandas())
    scores = {r.doc_id: r.predicted for r in toxicity.scored(docs, labels).collect()}
    before, after = held["toxicity"]
    assert set(after.doc_id) == {i for i in before.doc_id if not scores[i]}
    before, after = held["exact dedup"]
    assert set(after.doc_id) == set(before.assign(t=before.text.map(folded)).groupby("t").doc_id.max())
    before, after = held["near-dedup"]
    texts = dict(zip(before.doc_id, before.text))
    assert set(after.doc_id) == {i for i, c in grouped(texts, similar(texts)[1]).items() if i == c}
    before, after = held["mixing"]
    assert set(after.doc_id) <= set(before.doc_id) and 0.6 * len(before) < len(after) < 1.4 * len(before)
    last = corpus_pipeline.STAGES[-1][1](llm, kept, SF_DIR)
    assert last.count() == len(after) and last.where("not lossless").isEmpty()


def test_the_whole_pipeline_runs(llm):
    got = driver.queries()["pipeline"](llm, SF_DIR)
    assert got.columns == ["doc_id", "pieces", "n_pieces", "lossless"] and got.where("lossless").count() == got.count() > 50
