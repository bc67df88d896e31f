"""Audits, skip decisions, counts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.batches import event_checkpoints
from checks.common import Registry, table
from ferrylane import schemas as S
from ferrylane.operators import ledger, report
from ferrylane.session import scratch_path

registry = Registry()


def _as_audit(events: DataFrame) -> DataFrame:
    """Events read as audit rows: a user is a table, an event is a run."""
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
        F.lit("dbo").alias("schema_name"),
        F.when(F.col("value") > 10, "full").otherwise("incremental").alias("load_mode"),
        F.upper("event_type").alias("outcome"),
        F.lit(1).cast("bigint").alias("batches_processed"),
        F.col("event_id").alias("rows_processed"),
        F.lit(0).cast("bigint").alias("resumed_from_batch"),
        F.col("ts").alias("started_at"),
        F.col("ts").alias("finished_at"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
    )


_LATEST_EVENT = "select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"


@registry.add(f"""
select 'user_' || user_id as table_name, upper(event_type) as outcome, event_id as rows_processed, ts as finished_at
from ({_LATEST_EVENT})
""")
def latest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ledger.latest_audit(_as_audit(table(spark, sf_dir, "events")))
    return latest.select("table_name", "outcome", "rows_processed", "finished_at")


@registry.add("""
with c as (select 'user_' || user_id as table_name, event_type,
                  event_type in ('signup', 'purchase') as completed
           from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1),
n as (select o_custkey, count(*) as target_rows from orders where o_orderstatus = 'F' group by 1),
p as (select c_custkey, 'user_' || c_custkey as table_name, case when c_acctbal > 2000 then 'full' else 'incremental' end as load_mode from customer)
select p.table_name, load_mode, coalesce(target_rows, 0) as target_rows,
       case when load_mode = 'full' and completed and coalesce(target_rows, 0) > 0 then 'skip'
            when completed is false then 'resume' else 'fresh' end as action
from p left join c on c.table_name = p.table_name left join n on n.o_custkey = p.c_custkey
""")
def skip_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as planned tables, their last event as checkpoint, their finished orders as target rows."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")

    def name(key: str):
        return F.concat(F.lit("user_"), F.col(key).cast("string")).alias("table_name")

    dbo = F.lit("dbo").alias("schema_name")
    mode = F.when(F.col("c_acctbal") > 2000, S.FULL).otherwise(S.INCREMENTAL)
    plan = customer.select(dbo, name("c_custkey"), mode.alias("load_mode"))
    counts = (
        orders.where(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("target_rows"))
        .select(dbo, name("o_custkey"), "target_rows")
    )
    latest = ledger.latest_checkpoint(event_checkpoints(table(spark, sf_dir, "events")))
    return ledger.decide(plan, latest, counts).select("table_name", "load_mode", "target_rows", "action")


@registry.add("""
select l_orderkey, l_linenumber, l_partkey,
       case when l_linestatus = 'O' and l_linenumber - 1 > 0 then 'RESUMED_SUCCESS'
            when l_linestatus = 'O' then 'SUCCESS' else 'FAILED' end as outcome
from lineitem
""")
def audit_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = F.when(F.col("l_linestatus") == "O", S.SUCCESS).otherwise(S.FAILED)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        ledger.audit_outcome(outcome, F.col("l_linenumber") - 1).alias("outcome"),
    )


_COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
            "pages", "benchmark", "labels", "conversations"]


@registry.add("\nunion all\n".join(
    f"select 'dbo' as schema_name, '{t}' as table_name, count(*) as target_rows from {t}" for t in _COUNTED))
def live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables counted in one scan; one that is not there is left out."""
    paths = {("dbo", name): f"{sf_dir}/{name}.parquet" for name in _COUNTED}
    return report.live_counts(spark, {**paths, ("dbo", "not_there"): None})


@registry.add(f"""
with n as (select o_custkey, count(*) as target_rows from orders where o_totalprice > 150000 group by 1)
select 'user_' || user_id as table_name, 'dbo' as schema_name, 'dbo' as target_dataset,
       case when value > 10 then 'full' else 'incremental' end as load_mode, upper(event_type) as last_run_outcome,
       event_id as last_run_rows_processed, ts as last_run_started_at, ts as last_run_finished_at,
       case when event_type = 'error' then props end as last_error_message, target_rows as total_rows_in_target
from ({_LATEST_EVENT}) e left join n on n.o_custkey = e.user_id
""")
def status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 150000)
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("target_rows")).select(
        F.lit("dbo").alias("schema_name"), F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("table_name"),
        "target_rows",
    )
    return report.status_report(_as_audit(table(spark, sf_dir, "events")), counts)


def _as_log(events: DataFrame) -> DataFrame:
    """Events read as stage events: sign-ups start a stage, the rest end one."""
    start = F.col("event_type") == "signup"
    no_text = F.lit(None).cast("string")
    return events.select(
        F.concat(F.lit("run_"), F.to_date("ts").cast("string")).alias("run_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
        F.lit("dbo").alias("schema_name"),
        F.when(F.col("value") > 10, "load").otherwise("extraction").alias("stage"),
        F.when(start, "STARTED").when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("user_id").alias("batch_index"),
        F.when(~start, F.col("event_id")).alias("rows_processed"),
        F.when(~start, F.length("props").cast("bigint")).alias("bytes_processed"),
        F.when(start, F.col("ts").cast("timestamp")).alias("started_at"),
        F.when(~start, F.col("ts").cast("timestamp")).alias("finished_at"),
        no_text.alias("error_message"),
        F.col("props").alias("extra_json"),
    )


_LOG_SQL = """
select event_id, 'run_' || ts::date as run_id, case when value > 10 then 'load' else 'extraction' end as stage,
       case event_type when 'signup' then 'STARTED' when 'error' then 'FAILED' else 'SUCCESS' end as status,
       case when event_type <> 'signup' then event_id end as rows_processed,
       case when event_type <> 'signup' then length(props) end as bytes_processed, ts::date as event_date, props
from events
"""


@registry.add(f"""
select stage, status, count(*) as events, cast(sum(rows_processed) as bigint) as rows_processed,
       cast(sum(bytes_processed) as bigint) as bytes_processed
from ({_LOG_SQL}) group by stage, status
""")
def log_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.log_by_stage(_as_log(table(spark, sf_dir, "events")))


@registry.add(f"select event_date, stage, count(*) as events from ({_LOG_SQL}) group by all")
def log_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """START and END events fall on the day of whichever time they have."""
    dated = ledger.with_event_date(_as_log(table(spark, sf_dir, "events")))
    return dated.groupBy("event_date", "stage").agg(F.count(F.lit(1)).alias("events"))


@registry.add(f"select run_id, stage, status, rows_processed, props as extra_json from ({_LOG_SQL})")
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON objects by run and read back."""
    path = scratch_path(spark, "raw_events")
    ledger.write_raw_events(_as_log(table(spark, sf_dir, "events")), path)
    schema = "stage string, status string, rows_processed bigint, extra_json string, run_id string"
    return spark.read.schema(schema).json(path).select("run_id", "stage", "status", "rows_processed", "extra_json")


def _as_results(documents: DataFrame) -> DataFrame:
    """Documents read as tables that ended in one of four states."""
    return documents.select(
        F.col("source").alias("schema"), F.col("doc_id").cast("string").alias("name"), F.upper("lang").alias("status")
    )


@registry.add("select upper(lang) as status, count(*) as tables from documents group by lang")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.run_summary(_as_results(table(spark, sf_dir, "documents")))


@registry.add("""select upper(lang) as status, source || '.' || doc_id as "table" from documents""")
def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.run_outcomes(_as_results(table(spark, sf_dir, "documents")))
