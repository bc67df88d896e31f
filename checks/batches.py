"""Ranking, batches and resume points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import Registry, table
from ferrylane.operators.batching import assign_batches, batch_edges, commit_groups, rows_after, with_resume_point
from ferrylane.operators.ledger import latest_checkpoint
from ferrylane.operators.ranking import RANK, number_rows, rank_by_key
from ferrylane.operators.report import batch_totals
from ferrylane.session import scratch_path

registry = Registry()


def _edges(df: DataFrame, keys: list[str], size: int, first: int = 0) -> DataFrame:
    ranked = rank_by_key(df.select(*keys), keys, scratch_path(df.sparkSession, "ranked"))
    return batch_edges(ranked.frame, keys, ranked.rows, size, first)


def _by_orderkey(edges: DataFrame) -> DataFrame:
    return edges.select(
        "batch_index", "rows",
        F.col("first_key.o_orderkey").alias("first_key"), F.col("last_key.o_orderkey").alias("last_key"),
    )


_NUMBERED = "select *, row_number() over (order by {keys}) as rn from {source}"
_BATCHED = """
select cast((rn - 1) // {size} as bigint) + {first} as batch_index, count(*) as "rows",
       min_by({key}, rn) as first_key, max_by({key}, rn) as last_key
from (""" + _NUMBERED + """) group by 1
"""


@registry.add(_BATCHED.format(size=1000, first=0, key="o_orderkey", keys="o_orderkey", source="orders"))
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(table(spark, sf_dir, "orders"), ["o_orderkey"], 1000)
    return _by_orderkey(edges)


@registry.add("""
select cast((rn - 1) // 100 as bigint) as batch_index, count(*) as "rows",
       min_by(conv_id, rn) as first_conv, min_by(turn, rn) as first_turn,
       max_by(conv_id, rn) as last_conv, max_by(turn, rn) as last_turn
from (""" + _NUMBERED.format(keys="conv_id, turn", source="conversations") + ") group by 1")
def batch_assign_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], 100)
    return edges.select(
        "batch_index", "rows",
        F.col("first_key.conv_id").alias("first_conv"), F.col("first_key.turn").alias("first_turn"),
        F.col("last_key.conv_id").alias("last_conv"), F.col("last_key.turn").alias("last_turn"),
    )


@registry.add("select c_custkey, cast((rn - 1) // 128 as bigint) as batch_index, rn as row_rank from ("
              + _NUMBERED.format(keys="c_name", source="customer") + ")")
def batch_rows_string_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of every row, by a text key."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    ranked = rank_by_key(customer, ["c_name"], scratch_path(spark, "ranked"))
    return assign_batches(ranked.frame, 128).select("c_custkey", "batch_index", F.col(RANK).alias("row_rank"))


@registry.add(_BATCHED.format(
    size=1000, first=5, key="o_orderkey", keys="o_orderkey", source="(select * from orders where o_orderkey > 499)"))
def batch_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches after a checkpoint at batch 4, key 499."""
    rest = rows_after(table(spark, sf_dir, "orders"), ["o_orderkey"], {"o_orderkey": 499})
    edges = _edges(rest, ["o_orderkey"], 1000, first=5)
    return _by_orderkey(edges)


@registry.add("""
select batch_index // 4 as "commit", min(batch_index) as first_batch, max(batch_index) as last_batch,
       cast(sum(n) as bigint) as "rows", count(*) as batches,
       '{"event_id":' || min(lo) || '}' as first_pk_json, '{"event_id":' || max(hi) || '}' as last_pk_json
from (select cast((rn - 1) // 300 as bigint) as batch_index, count(*) as n, min(event_id) as lo, max(event_id) as hi
      from (""" + _NUMBERED.format(keys="event_id", source="events") + ") group by 1) group by 1")
def commit_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 300 events, committed four at a time."""
    return commit_groups(_edges(table(spark, sf_dir, "events"), ["event_id"], 300), per_commit=4)


@registry.add("select cast(ceil(count(*) / 700.0) as bigint) as batches_processed, count(*) as rows_processed from events")
def batch_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_totals(_edges(table(spark, sf_dir, "events"), ["event_id"], 700))


_ALL_LINEITEM = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                 "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@registry.add("select *, row_number() over (order by " + _ALL_LINEITEM + ") as source_row_id from lineitem")
def synthetic_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items have no key: number them by all their columns, repeated rows included."""
    lineitem = table(spark, sf_dir, "lineitem")
    ranked = rank_by_key(lineitem, lineitem.columns, scratch_path(spark, "frozen"), ties=True)
    return ranked.frame.withColumnRenamed(RANK, "source_row_id")


@registry.add("""
select count(*) as "rows", count(*) as numbered, cast(1 as bigint) as lowest, count(*) as highest,
       cast(sum(round(l_extendedprice * 100)) as bigint) as cents
from lineitem
""")
def synthetic_key_frozen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in scan order: dense from 1, no two alike, and the rows unchanged."""
    frozen = number_rows(table(spark, sf_dir, "lineitem"), scratch_path(spark, "frozen")).frame
    return frozen.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(RANK).alias("numbered"),
        F.min(RANK).alias("lowest"), F.max(RANK).alias("highest"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
    )


_STATUS_SQL = """case event_type when 'signup' then 'COMPLETED' when 'purchase' then 'COMPLETED'
    when 'error' then 'FAILED' else 'IN_PROGRESS' end"""


def event_checkpoints(events: DataFrame) -> DataFrame:
    """Events read as checkpoints: a user is a table, and its events are its history."""
    status = (
        F.when(F.col("event_type").isin("signup", "purchase"), "COMPLETED")
        .when(F.col("event_type") == "error", "FAILED")
        .otherwise("IN_PROGRESS")
    )
    return events.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
        F.lit("dbo").alias("schema_name"),
        F.when(F.col("value") > 5, F.col("props")).alias("last_pk_json"),
        F.when(F.col("value") > 5, F.col("event_id")).alias("last_batch_index"),
        status.alias("status"),
        F.col("event_type").alias("run_id"),
        F.col("ts").alias("updated_at"),
    )


@registry.add(f"""
with c as (select 'user_' || user_id as table_name, case when value > 5 then props end as pk,
                  case when value > 5 then event_id end as idx, {_STATUS_SQL} as status,
                  row_number() over (partition by user_id order by ts desc, event_id desc) as rn
           from events)
select table_name, status, status <> 'COMPLETED' as is_resumed,
       case when status <> 'COMPLETED' then pk end as resume_after_json,
       case when status <> 'COMPLETED' then coalesce(idx, -1) + 1 else 0 end as next_batch_index
from c where rn = 1
""")
def resume_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_checkpoint(event_checkpoints(table(spark, sf_dir, "events")))
    return with_resume_point(latest).select(
        "table_name", "status", "is_resumed", "resume_after_json", "next_batch_index"
    )
