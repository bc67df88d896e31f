"""Ranks, row numbers, batches and pages."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrylane.operators.batching import RANK, assign_batches, batch_edges, commit_groups, key_page, with_resume_point
from ferrylane.operators.ranking import Ranked, number_rows, planned_bytes, rank_by_key, ranges_for
from ferrylane.session import scratch_path


def ranks(frame, *columns):
    return [tuple(r) for r in frame.select(*columns, RANK).orderBy(RANK).collect()]


def test_rank_equals_a_global_row_number(spark, read):
    orders = read("orders").select("o_custkey", "o_orderkey")
    ranked = rank_by_key(orders.repartition(7), ["o_custkey", "o_orderkey"], scratch_path(spark, "t"))
    expected = sorted((r[0], r[1]) for r in orders.collect())
    assert ranks(ranked.frame, "o_custkey", "o_orderkey") == [(*k, i + 1) for i, k in enumerate(expected)]
    assert ranked.rows == len(expected)


def test_rank_plan_gathers_no_rows_in_one_task(spark, read, plan_of):
    ranked = rank_by_key(read("orders"), ["o_orderkey"], scratch_path(spark, "t"))
    plan = plan_of(assign_batches(ranked.frame, 100))
    assert "SinglePartition" not in plan and "Exchange hashpartitioning" not in plan
    assert "BroadcastExchange" in plan


def test_one_value_with_most_rows_is_spread_over_ranges(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") < 15_000, 7).otherwise(F.col("id")).alias("k"))
    spread = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_by_key(rows, ["k"], scratch_path(spark, "t"), ties=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", spread)
    sizes = [r["rows"] for r in spark.read.parquet(f"{ranked.path}/slices").collect()]
    assert len(sizes) == 4 and max(sizes) < 8_000
    got = ranks(ranked.frame, "k")
    assert [r for _, r in got] == list(range(1, 20_001)) and [k for k, _ in got] == sorted(k for k, _ in got)


def test_ranged_input_is_not_shuffled(spark):
    df = spark.range(0, 1000, 1, 5)
    ranked = rank_by_key(df, ["id"], scratch_path(spark, "t"), already_ranged=True)
    assert ranks(ranked.frame, "id") == [(i, i + 1) for i in range(1000)]
    assert spark.read.parquet(f"{ranked.path}/slices").count() == 5


def test_row_numbers_are_dense_unique_and_frozen(spark, read):
    lineitem = read("lineitem").repartition(5)
    frozen = number_rows(lineitem, scratch_path(spark, "t"))
    first, again = frozen.frame, Ranked(spark, frozen.path).frame
    assert sorted(r[RANK] for r in first.collect()) == list(range(1, 6001))
    assert first.exceptAll(again).isEmpty()
    assert first.drop(RANK).exceptAll(lineitem).isEmpty()
    assert frozen.is_complete()
    frozen.drop()
    assert not frozen.is_complete()


@pytest.mark.parametrize("size, ranges", [(0, 1), (1, 1), (100, 1), (101, 2), (100_000, 1000), (None, None)])
def test_ranges_follow_the_input(size, ranges):
    assert ranges_for(size, range_bytes=100) == ranges


def test_only_what_bounds_a_frame_is_taken_for_its_size(spark, read):
    orders, items = read("orders"), read("lineitem")
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
    assert planned_bytes(joined) is None and planned_bytes(orders.select(F.explode(F.array(F.lit(1), F.lit(2))))) is None
    assert planned_bytes(orders.join(items, items["l_orderkey"] == orders["o_orderkey"], "left_semi")) == planned_bytes(orders) + planned_bytes(items)
    assert planned_bytes(orders.unionAll(orders)) == 2 * planned_bytes(orders)


def test_ranked_slices_are_as_many_as_ranges(spark, read):
    orders = read("orders")
    assert 0 < planned_bytes(orders) < 1 << 30
    ranked = rank_by_key(orders, ["o_orderkey"], scratch_path(spark, "t"), ranges=11)
    assert spark.read.parquet(f"{ranked.path}/slices").count() == 11 and ranked.rows == 1500


def test_a_copy_that_dies_is_not_complete(spark):
    path = scratch_path(spark, "t")
    number_rows(spark.range(10), path)
    with pytest.raises(Exception, match="lost"):
        number_rows(spark.range(10).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id")), path)
    assert not Ranked(spark, path).is_complete()
    assert number_rows(spark.range(3), path).rows == 3


def test_empty_input(spark):
    ranked = rank_by_key(spark.createDataFrame([], "id bigint"), ["id"], scratch_path(spark, "t"))
    assert ranked.rows == 0 and ranked.frame.isEmpty()
    assert batch_edges(ranked.frame, ["id"], 0, 10).isEmpty()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.sets(st.tuples(st.integers(-50, 50), st.text("ab~Z", max_size=3)), min_size=1, max_size=60),
    size=st.integers(1, 25),
)
def test_batches_equal_repeated_pages(spark, keys, size):
    df = spark.createDataFrame(list(keys), "a bigint, b string")
    ranked = rank_by_key(df, ["a", "b"], scratch_path(spark, "t"))
    edges = batch_edges(ranked.frame, ["a", "b"], ranked.rows, size, first_index=3)
    batches = [(r["batch_index"], r["rows"], tuple(r["first_key"]), tuple(r["last_key"]))
               for r in edges.orderBy("batch_index").collect()]
    pages, last = [], None
    while True:
        page = [tuple(r) for r in key_page(df, ["a", "b"], size, last).collect()]
        if not page:
            break
        pages.append((3 + len(pages), len(page), page[0], page[-1]))
        last = dict(zip("ab", page[-1]))
        if len(page) < size:
            break
    assert batches == pages


def test_commit_groups_cover_all_batches(spark):
    ranked = rank_by_key(spark.range(95).select(F.col("id").alias("k")), ["k"], scratch_path(spark, "t"))
    edges = batch_edges(ranked.frame, ["k"], ranked.rows, 10, first_index=2)
    got = commit_groups(edges, 4, first_index=2).orderBy("commit").collect()
    assert [(r["first_batch"], r["last_batch"], r["rows"], r["last_pk_json"]) for r in got] == [
        (2, 5, 40, '{"k":39}'), (6, 9, 40, '{"k":79}'), (10, 11, 15, '{"k":94}')]


@pytest.mark.parametrize("status, index, pk, expected", [
    *[(status, index, f'{{"k":{index}}}', (f'{{"k":{index}}}', index + 1, True)) for status in ("IN_PROGRESS", "FAILED") for index in (0, 1, 38)],
    *[(status, index, None, (None, 0, True)) for status in ("IN_PROGRESS", "FAILED") for index in (-1, None)],
    ("COMPLETED", 17, '{"k":17}', (None, 0, False)),
    (None, None, None, (None, 0, False)),
])
def test_resume_point(spark, status, index, pk, expected):
    latest = spark.createDataFrame([(status, index, pk)], "status string, last_batch_index bigint, last_pk_json string")
    row = with_resume_point(latest).first()
    assert (row["resume_after_json"], row["next_batch_index"], row["is_resumed"]) == expected


@pytest.mark.parametrize("size, ranges", [(1, 1), (16 << 20, 1), (17 << 20, 2), (130 << 20, 8), (12 << 30, 96)])
def test_ranges_give_all_cores_work(size, ranges):
    assert ranges_for(size, cores=8) == ranges
