"""Landing, reconciliation, stripping and transfer accounts."""

import pytest
from pyspark.sql import functions as F

from ferrylane.operators import landing
from ferrylane.session import scratch_path

BATCHED = "id bigint, v string, batch_index bigint"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def path(spark):
    where = scratch_path(spark, "landing")
    batched = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 1), (4, "d", 2)], BATCHED)
    return landing.land(batched, where, ["id"])


@pytest.mark.parametrize("clustered", [True, False])
def test_landing_a_batch_again_replaces_just_that_batch(spark, path, clustered):
    landing.land(spark.createDataFrame([(9, "z", 1)], BATCHED), path, clustered=clustered)
    back = landing.read_landed(spark, path, spark.createDataFrame([], "id bigint, v string").schema)
    assert rows(back) == [(1, "a", 0), (2, "b", 0), (4, "d", 2), (9, "z", 1)]


def test_landing_the_whole_replaces_everything(spark, path):
    landing.land(spark.createDataFrame([(9, "z", 7)], BATCHED), path, whole=True)
    assert rows(spark.read.parquet(path)) == [(9, "z", 7)]


def test_reconcile_states(spark, path):
    counts = landing.batch_counts(spark.read.parquet(path))
    expected = spark.createDataFrame([(0, 3), (1, 1), (5, 1)], "batch_index bigint, rows bigint")
    states = {r["batch_index"]: r["state"] for r in landing.reconcile(expected, counts).collect()}
    assert states == {0: "short", 1: "ok", 2: "unexpected", 5: "missing"}
    with pytest.raises(landing.LandingMismatch, match="3 batch.*batch 0 short.*batch 2 unexpected.*batch 5 missing"):
        landing.require_landed(landing.reconcile(expected, counts))
    landing.require_landed(landing.reconcile(counts, counts))


def test_strip_column(spark, path):
    types = dict(spark.read.parquet(path).dtypes)
    cleaned = landing.strip_column(spark, path, "v", scratch_path(spark, "landing"))
    assert cleaned != path and rows(spark.read.parquet(cleaned).select("id", "batch_index")) == [(1, 0), (2, 0), (3, 1), (4, 2)]
    assert dict(spark.read.parquet(cleaned).dtypes) == {c: t for c, t in types.items() if c != "v"}
    assert landing.strip_column(spark, cleaned, "v", scratch_path(spark, "landing")) == cleaned
    with pytest.raises(FileNotFoundError):
        landing.strip_column(spark, path + "-gone", "v", scratch_path(spark, "landing"))


@pytest.mark.parametrize("states, codes, verdict", [
    (["found", "copied"], [], "SUCCESS"),
    (["found", "found", "copied", "skipped"], [], "SUCCESS"),
    (["found", "failed"], [], "PARTIAL_FAILURE"),
    (["found", "found", "copied"], [], "PARTIAL_FAILURE"),
    (["found", "copied"], ["NOT_FOUND"], "PARTIAL_FAILURE"),
    (["copied"], [], "SUCCESS"),
])
def test_transfer_verdict(spark, states, codes, verdict):
    rows_ = [("dbo", "t", 0, "p", s, None, None) for s in states]
    rows_ += [("dbo", "t", 0, "p", "error", code, "detail") for code in codes]
    manifest = spark.createDataFrame(
        rows_, "schema_name string, table_name string, batch_index bigint, path string, state string, error_code string, error_detail string")
    account = landing.transfer_accounting(manifest).first()
    assert account["status"] == verdict
    assert [e["error_code"] for e in account["errors"]] == codes
    assert account["objects_found"] == states.count("found")


def test_counting_batches_reads_no_columns(spark, path, plan_of):
    assert "ReadSchema: struct<>" in plan_of(landing.batch_counts(spark.read.parquet(path).where(F.col("batch_index") > 0)))


def test_reading_some_batches_lists_their_folders_only(spark, path):
    schema = spark.createDataFrame([], "id bigint, v string").schema
    some = landing.read_landed(spark, path, schema, range(1, 3))
    assert rows(some) == [(3, "c", 1), (4, "d", 2)] and some.schema["batch_index"].dataType.simpleString() == "bigint"
    assert not any("batch_index=0" in f for f in some.inputFiles())
    with pytest.raises(Exception, match="batch_index=3"):
        landing.read_landed(spark, path, schema, range(2, 4)).count()
