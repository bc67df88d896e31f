"""Insert-only merge: what comes in, and how the plan gets there."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrylane import storage
from ferrylane.operators import landing
from ferrylane.operators.merge import drop_target_column, merge_into, new_rows, with_target_column
from ferrylane.session import scratch_path
from ferrylane.storage import VersionedTable
from ferrylane.streaming.sync import sync_stream

SCHEMA = "a bigint, b string, v string"


@pytest.fixture
def target(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    table.replace(spark.createDataFrame([(1, "x", "old"), (2, "x", "old"), (None, "x", "old")], SCHEMA))
    return table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_only_absent_keys_come_in(spark, target, broadcast_bytes):
    staged = spark.createDataFrame(
        [(1, "x", "new"), (1, "y", "new"), (3, "x", "new"), (3, "x", "twin"), (None, "x", "new"), (4, None, "new")], SCHEMA)
    inserted = merge_into(target, staged, ["a", "b"], broadcast_bytes=broadcast_bytes)
    assert inserted == 5
    assert rows(target.read()) == rows(spark.createDataFrame(
        [(1, "x", "old"), (2, "x", "old"), (None, "x", "old"), (1, "y", "new"), (3, "x", "new"), (3, "x", "twin"),
         (None, "x", "new"), (4, None, "new")], SCHEMA))


def test_second_merge_adds_nothing(spark, target):
    staged = spark.createDataFrame([(5, "z", "new"), (1, "x", "new")], SCHEMA)
    assert [merge_into(target, staged, ["a", "b"], unique=True) for _ in range(3)] == [1, 0, 0]


def test_nothing_staged(spark, target):
    assert merge_into(target, spark.createDataFrame([], SCHEMA), ["a", "b"]) == 0


def test_no_key_is_an_error(spark, target):
    with pytest.raises(ValueError, match="no key"):
        merge_into(target, target.read(), [])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    loaded=st.lists(st.integers(0, 12) | st.none(), max_size=12),
    staged=st.lists(st.integers(0, 12) | st.none(), max_size=20),
    broadcast_bytes=st.sampled_from([0, 40, 1 << 20]),
)
def test_merge_equals_not_exists(spark, loaded, staged, broadcast_bytes):
    old = spark.createDataFrame([(k, "old") for k in loaded], "k bigint, v string")
    new = spark.createDataFrame([(k, str(i)) for i, k in enumerate(staged)], "k bigint, v string")
    got = rows(new_rows(new, old, ["k"], broadcast_bytes=broadcast_bytes))
    known = set(loaded) - {None}
    assert got == sorted(((k, str(i)) for i, k in enumerate(staged) if k not in known), key=repr)


def test_rows_are_not_shuffled_when_the_target_has_none_or_few(spark, read, plan_of):
    orders = read("orders")
    nothing = new_rows(orders, orders.where("o_orderkey < 0"), ["o_orderkey"], unique=True)
    few = new_rows(orders, orders.where("o_orderkey < 300"), ["o_orderkey"], unique=True)
    assert "Join" not in plan_of(nothing)
    assert "BroadcastHashJoin" in plan_of(few) and "Exchange hashpartitioning" not in plan_of(few)


def test_few_absent_keys_are_broadcast_to_the_rows(spark, read, plan_of):
    orders = read("orders")
    fresh = new_rows(orders, orders.where("o_orderkey > 2"), ["o_orderkey"], unique=True, broadcast_bytes=200)
    assert fresh.count() == 3
    assert "BroadcastHashJoin" in plan_of(fresh) and "LeftSemi" in plan_of(fresh)
    assert "Exchange hashpartitioning" not in plan_of(fresh)


def test_key_range_reaches_the_target_scan(spark, read, plan_of):
    orders = read("orders")
    fresh = new_rows(orders.where("o_orderkey between 10 and 20"), orders.where("o_custkey > 9"), ["o_orderkey"],
                     unique=True, key_range=(10, 20))
    assert "GreaterThanOrEqual(o_orderkey,10)" in plan_of(fresh) and "LessThanOrEqual(o_orderkey,20)" in plan_of(fresh)
    assert rows(fresh) == rows(orders.where("o_orderkey between 10 and 20 and o_custkey <= 9"))


def test_synthetic_column_comes_back_as_null_and_goes_again(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    table.replace(spark.createDataFrame([("a",), ("b",)], "v string"))
    assert not drop_target_column(table, "id")
    assert rows(with_target_column(table, "id")) == [("a", None), ("b", None)]
    table.append(spark.createDataFrame([("c", 1)], "v string, id bigint"))
    assert rows(with_target_column(table, "id")) == [("a", None), ("b", None), ("c", 1)]
    assert drop_target_column(table, "id")
    assert rows(table.read()) == [("a",), ("b",), ("c",)]
    assert not drop_target_column(table, "id")


def data_files(table):
    return sorted(storage.files(table.spark, table.current_path()))


def test_dropping_and_adding_a_column_writes_no_data_file(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    table.replace(spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "v string, ID bigint, `x.y` int"))
    for n in range(2, 4):
        before = data_files(table)
        assert drop_target_column(table, "ID") and not drop_target_column(table, "ID")
        assert table.read().columns == ["v", "x.y"] and data_files(table) == before
        assert {r[1] for r in with_target_column(table, "ID").select("v", "ID").collect()} == {None}
        assert data_files(table) == before
        table.append(spark.createDataFrame([(f"c{n}", n, 30)], "v string, ID bigint, `x.y` int"))
        # The values of the column that was dropped do not come back with the new one.
        assert rows(table.read("v string, ID bigint").where("ID IS NOT NULL")) == [(f"c{n}", n)]
        assert len(data_files(table)) > len(before)
    assert table.read("v string").count() == 4 and table.row_count() == 4
    kept = table.read("v string, ID bigint, `x.y` int")
    table.replace(kept)
    assert rows(table.read()) == rows(kept) and table.read().columns == ["v", "ID", "x.y"]


def test_keys_are_matched_under_the_name_that_is_shown(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    table.replace(spark.createDataFrame([(1, "old")], "id bigint, v string"))
    drop_target_column(table, "id")
    fresh = spark.createDataFrame([(1, "new"), (2, "new")], "id bigint, v string")
    assert merge_into(table, fresh, ["id"], unique=True) == 2 and merge_into(table, fresh, ["id"], unique=True) == 0
    assert rows(table.read("id bigint, v string")) == [(1, "new"), (2, "new"), (None, "old")]


def ranged_table(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    table.replace(spark.range(0).select("id", F.lit("x").alias("v")))
    for first in range(0, 50, 10):
        table.append(spark.range(first, first + 10, numPartitions=1).select("id", F.lit("x").alias("v")))
    return table


def opened(table, low, high):
    return len(table.read_within(table.read().schema, "id", F.lit(low), F.lit(high)).inputFiles())


def test_files_of_other_key_ranges_are_not_opened(spark):
    table = ranged_table(spark)
    assert opened(table, 12, 13) == len(data_files(table)) - data_files(table).count("_SUCCESS")
    assert table.index_files("id") >= 5 and table.index_files("id") == 0
    assert [opened(table, *r) for r in ((12, 13), (19, 20), (0, 49), (-5, -1), (99, 100))] == [1, 2, 5, 0, 0]
    table.append(spark.createDataFrame([(12, "late"), (None, "late")], "id bigint, v string").coalesce(1))
    assert opened(table, 12, 13) == 2 and opened(table, 30, 31) == 2  # the new file is not noted yet
    assert table.index_files("id", at_least=5) == 0 and table.index_files("id") == 1 and opened(table, 30, 31) == 1
    fresh = spark.createDataFrame([(n, "new") for n in (11, 12, 49, 50)], "id bigint, v string")
    assert merge_into(table, fresh, ["id"], unique=True, key_range=(11, 50)) == 1
    assert table.read().where("id IN (11, 12, 49, 50)").count() == 5


def test_a_column_that_came_back_has_ranges_of_its_own(spark):
    table = ranged_table(spark)
    table.index_files("id")
    drop_target_column(table, "id")
    table.append(spark.createDataFrame([(12, "new")], "id bigint, v string").coalesce(1))
    fresh = spark.createDataFrame([(12, "newer"), (13, "newer")], "id bigint, v string")
    assert merge_into(table, fresh, ["id"], unique=True, key_range=(12, 13)) == 1
    table.index_files("id")
    assert merge_into(table, fresh, ["id"], unique=True, key_range=(12, 13)) == 0


def test_a_rewrite_that_dies_leaves_the_old_version(spark, target):
    before = rows(target.read())
    broken = target.read().select(F.raise_error(F.lit("lost")).cast("bigint").alias("a"), "b", "v")
    with pytest.raises(Exception, match="lost"):
        target.replace(broken)
    assert rows(target.read()) == before
    target.replace(target.read().where("a = 1"))
    assert rows(target.read()) == [(1, "x", "old")]


def test_old_versions_go_but_the_last_one_stays(spark, target):
    for n in range(3):
        target.replace(target.read().withColumn("n", F.lit(n)))
    assert target.current_path().endswith("v=4") and target._versions() == [3, 4]


def test_a_staged_key_with_most_rows_is_split(spark, plan_of):
    """Many known and many absent keys, one of which holds a third of the staged rows."""
    tight = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000"}
    before = {name: spark.conf.get(name) for name in tight}
    for name, value in tight.items():
        spark.conf.set(name, value)
    try:
        ids = spark.range(300_000).repartition(8)
        staged = ids.select(F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("k"), F.uuid().alias("v"))
        path = scratch_path(spark, "staged")
        staged.write.parquet(path)
        fresh = new_rows(spark.read.parquet(path), ids.select(F.col("id").alias("k")).where("k < 100000"), ["k"], broadcast_bytes=0)
        counts = fresh.agg(F.count("*"), F.count_if(F.col("k") == -7), F.min(F.when(F.col("k") > 0, F.col("k"))))
        others = sum(1 for i in range(100_000, 300_000) if i % 3)
        assert tuple(counts.first()) == (100_000 + others, 100_000, 100_000)
        joined = fresh.select("v")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_stream_merges_what_has_landed_since(spark):
    schema = spark.createDataFrame([], "id bigint, v string").schema
    path, table = scratch_path(spark, "landing"), VersionedTable(spark, scratch_path(spark, "t"))
    table.create(schema)
    checkpoint = scratch_path(spark, "stream")

    def land(batch_index, ids):
        df = spark.createDataFrame([(i, f"batch {batch_index}", batch_index) for i in ids], "id bigint, v string, batch_index bigint")
        landing.land(df, path)
        sync_stream(spark, path, schema, ["id"], table, checkpoint).awaitTermination()

    land(0, [1, 2])
    land(1, [2, 3])
    assert rows(table.read()) == [(1, "batch 0"), (2, "batch 0"), (3, "batch 1")]


def test_the_file_index_is_read_once_however_many_files_there_are(spark, monkeypatch):
    table, read = ranged_table(spark), []
    table.index_files("id")
    monkeypatch.setattr(VersionedTable, "_indexed", lambda self, index, real=VersionedTable._indexed: read.append(index) or real(self, index))
    assert table.index_files("id") == 0 and len(read) == 1


def test_a_micro_batch_of_many_small_files_becomes_one_file(spark):
    rows_in = spark.range(40).select("id", F.col("id").cast("string").alias("v"), (F.col("id") % 8).alias("batch_index"))
    path, table = scratch_path(spark, "landing"), VersionedTable(spark, scratch_path(spark, "t"))
    landing.land(rows_in, path)
    table.create(rows_in.drop("batch_index").schema)
    before = len(data_files(table))
    sync_stream(spark, path, rows_in.drop("batch_index").schema, ["id"], table, scratch_path(spark, "stream"), max_files=1000).awaitTermination()
    assert len(data_files(table)) == before + 1
    assert sorted(map(tuple, table.read().collect())) == [(n, str(n)) for n in range(40)]


def test_a_listing_takes_few_calls_however_many_files_there_are(spark, tmp_path, monkeypatch):
    from py4j.clientserver import ClientServerConnection

    from ferrylane import storage

    calls, real = [], ClientServerConnection.send_command
    monkeypatch.setattr(ClientServerConnection, "send_command", lambda self, command: calls.append(1) or real(self, command))
    names = [f"part-{i:03d} (a; isDirectory=true; b)=ü.parquet" for i in range(200)]
    for name in names:
        (tmp_path / name).write_text("")
    (tmp_path / "v=1").mkdir()
    assert sorted(storage.files(spark, str(tmp_path))) == names and storage.folders(spark, str(tmp_path)) == ["v=1"]
    assert len(calls) < 200
    (tmp_path / "two\nlines").write_text("")
    assert sorted(storage.files(spark, str(tmp_path))) == [*names, "two\nlines"] and storage.files(spark, f"{tmp_path}/none") == []
    (tmp_path / "none yet").mkdir()
    assert storage.files(spark, f"{tmp_path}/none yet") == []
