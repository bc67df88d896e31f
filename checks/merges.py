"""Landing, merging, syncing and whole runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.common import Registry, table
from ferrylane import schemas as S
from ferrylane.job import LAND_ONLY, Settings, TableRun, run_estate, run_regions, run_table
from ferrylane.operators import landing
from ferrylane.operators.batching import assign_batches, batch_edges
from ferrylane.operators.ledger import Ledger
from ferrylane.operators.merge import drop_target_column, merge_into, new_rows, union_new_rows, with_target_column
from ferrylane.operators.ranking import RANK, rank_by_key
from ferrylane.plans.planner import build_plan, find_table
from ferrylane.session import local_frame, scratch_path
from ferrylane.sources.catalog import Catalog
from ferrylane.sources.tables import FrameSource, ParquetSource
from ferrylane.storage import VersionedTable
from ferrylane.streaming.sync import sync_rows, sync_stream

registry = Registry()


def _loaded(orders: DataFrame) -> DataFrame:
    """What the target holds already: all orders but the open ones."""
    return orders.where(F.col("o_orderstatus") != "O")


def _staged(orders: DataFrame) -> DataFrame:
    """The whole source again, with prices that differ from those loaded."""
    return orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)


_MERGED_SQL = """
select * from orders where o_orderstatus <> 'O'
union all
select * replace (o_totalprice + 1 as o_totalprice) from orders s
where not exists (select 1 from orders t where t.o_orderstatus <> 'O' and t.o_orderkey = s.o_orderkey)
"""


@registry.add(_MERGED_SQL)
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded rows keep their price; open orders come in with the staged one."""
    orders = table(spark, sf_dir, "orders")
    return union_new_rows(_staged(orders), _loaded(orders), ["o_orderkey"], unique=True)


@registry.add("""
select * from conversations where role <> 'assistant'
union all
select * replace (upper(role) as role) from conversations s
where not exists (select 1 from conversations t where t.role <> 'assistant' and t.conv_id = s.conv_id and t.turn = s.turn)
""")
def merge_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    staged = conversations.withColumn("role", F.upper("role"))
    loaded = conversations.where(F.col("role") != "assistant")
    return union_new_rows(staged, loaded, ["conv_id", "turn"], unique=True)


@registry.add("""
with s as (select * replace (case when o_orderpriority <> '5-LOW' then o_orderkey end as o_orderkey) from orders)
select * from orders where o_orderstatus <> 'O'
union all
select * from s where not exists (select 1 from orders t where t.o_orderstatus <> 'O' and t.o_orderkey = s.o_orderkey)
""")
def merge_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-priority orders arrive without a key: they match nothing and all come in."""
    orders = table(spark, sf_dir, "orders")
    known_key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    return union_new_rows(orders.withColumn("o_orderkey", known_key), _loaded(orders), ["o_orderkey"])


@registry.add("""
with s as (select * from orders union all select * from orders)
select * from orders where o_orderstatus <> 'O'
union all
select * from s where not exists (select 1 from orders t where t.o_orderstatus <> 'O' and t.o_orderkey = s.o_orderkey)
""")
def merge_staging_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return union_new_rows(orders.unionAll(orders), _loaded(orders), ["o_orderkey"])


@registry.add("""
select l_returnflag, count(*) as "rows", cast(sum(l_quantity) as bigint) as quantity
from (select * from lineitem where l_returnflag = 'A'
      union all
      select * from lineitem s where not exists
          (select 1 from lineitem t where t.l_returnflag = 'A' and t.l_returnflag = s.l_returnflag))
group by l_returnflag
""")
def merge_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys hold all rows: they are collapsed before any shuffle, and their rows stay where they are."""
    lineitem = table(spark, sf_dir, "lineitem")
    loaded = lineitem.where(F.col("l_returnflag") == "A")
    merged = union_new_rows(lineitem, loaded, ["l_returnflag"])
    return merged.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@registry.add("""
with b as (select *, cast((row_number() over (order by o_orderkey) - 1) // 1000 as bigint) as batch_index from orders)
select batch_index, count(*) as rows_inserted from b
where not exists (select 1 from orders t where t.o_orderstatus <> 'O' and t.o_orderkey = b.o_orderkey)
group by batch_index
""")
def merge_rows_inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ranked = rank_by_key(orders.select("o_orderkey"), ["o_orderkey"], scratch_path(spark, "ranked"))
    fresh = new_rows(assign_batches(ranked.frame, 1000), _loaded(orders), ["o_orderkey"], unique=True)
    return fresh.groupBy("batch_index").agg(F.count(F.lit(1)).alias("rows_inserted"))


@registry.add("""
with s as (select * replace (case when l_linestatus = 'O' then l_orderkey end as l_orderkey) from lineitem),
t as (select * from lineitem where l_returnflag = 'A')
select l_returnflag, l_linestatus, count(*) as rows_inserted from s
where not exists (select 1 from t where t.l_orderkey = s.l_orderkey and t.l_linenumber = s.l_linenumber)
group by all
""")
def merge_beyond_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated and NULL keys against more target keys than may be broadcast."""
    lineitem = table(spark, sf_dir, "lineitem")
    staged = lineitem.withColumn("l_orderkey", F.when(F.col("l_linestatus") == "O", F.col("l_orderkey")))
    loaded = lineitem.where(F.col("l_returnflag") == "A")
    fresh = new_rows(staged, loaded, ["l_orderkey", "l_linenumber"], broadcast_bytes=0)
    return fresh.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("rows_inserted"))


@registry.add(_MERGED_SQL)
def merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored target after the same rows were merged into it twice."""
    orders = table(spark, sf_dir, "orders")
    target = VersionedTable(spark, scratch_path(spark, "target"))
    target.replace(_loaded(orders))
    for _ in range(2):
        merge_into(target, _staged(orders), ["o_orderkey"], unique=True)
    return target.read()


def _land(df: DataFrame, keys: list[str], size: int) -> tuple[str, DataFrame]:
    """Land a frame in batches; returns the path and the expected counts."""
    ranked = rank_by_key(df, keys, scratch_path(df.sparkSession, "ranked"))
    path = landing.land(assign_batches(ranked.frame, size).drop(RANK), scratch_path(df.sparkSession, "landing"))
    return path, batch_edges(ranked.frame, keys, ranked.rows, size)


@registry.add("""
select *, cast((row_number() over (order by o_orderkey) - 1) // 4000 as bigint) as batch_index from orders
""")
def land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path, _ = _land(orders, ["o_orderkey"], 4000)
    return landing.read_landed(spark, path, orders.schema)


@registry.add("""
with o as (select *, cast((row_number() over (order by o_orderkey) - 1) // 1000 as bigint) as batch_index from orders),
e as (select batch_index, count(*) as rows_expected from o group by 1),
a as (select case when batch_index = 3 then 900 else batch_index end as batch_index, count(*) as rows_landed
      from o where not (batch_index = 1 and o_orderstatus = 'P') group by 1)
select coalesce(e.batch_index, a.batch_index) as batch_index, rows_expected, rows_landed,
       case when rows_landed is null then 'missing' when rows_expected is null then 'unexpected'
            when rows_landed < rows_expected then 'short' else 'ok' end as state
from e full outer join a on e.batch_index = a.batch_index
""")
def landing_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 lost some rows on the way, and batch 3 landed under another number."""
    orders = table(spark, sf_dir, "orders")
    ranked = rank_by_key(orders, ["o_orderkey"], scratch_path(spark, "ranked"))
    batched = assign_batches(ranked.frame, 1000)
    lost = (F.col("batch_index") == 1) & (F.col("o_orderstatus") == "P")
    moved = F.when(F.col("batch_index") == 3, F.lit(900).cast("bigint")).otherwise(F.col("batch_index"))
    path = landing.land(batched.where(~lost).withColumn("batch_index", moved), scratch_path(spark, "landing"))
    arrived = landing.batch_counts(landing.read_landed(spark, path, orders.schema))
    return landing.reconcile(batch_edges(ranked.frame, ["o_orderkey"], ranked.rows, 1000), arrived)


@registry.add("""
with m as (
  select source || '/' || lang as table_name, 'found' as state, null as error_code, null as error_detail from documents
  union all
  select source || '/' || lang, case when l.toxic = 1 and l.quality = 0 then 'failed'
                                     when l.doc_id is not null then 'copied' else 'skipped' end,
         case when l.toxic = 1 and l.quality = 0 then 'PERMISSION_DENIED' when l.toxic = 1 then 'NOT_FOUND' end,
         case when l.toxic = 1 then 'object ' || lpad(d.doc_id::varchar, 12, '0') end
  from documents d left join labels l on d.doc_id = l.doc_id where d.n_chars > 120 or l.doc_id is not null),
t as (select table_name, count(*) filter (state = 'found') as objects_found, count(*) filter (state = 'copied') as objects_copied,
        count(*) filter (state = 'skipped') as objects_skipped, count(*) filter (state = 'failed') as objects_failed
      from m group by 1),
e as (select table_name, string_agg(error_code || ':' || n || ':' || sample, ',' order by error_code) as errors
      from (select table_name, error_code, count(*) as n, min(error_detail) as sample
            from m where error_code is not null group by all) group by 1)
select t.*, coalesce(errors, '') as errors,
       case when objects_copied + objects_skipped >= objects_found and objects_failed = 0 and errors is null
            then 'SUCCESS' else 'PARTIAL_FAILURE' end as status
from t left join e on t.table_name = e.table_name
""")
def transfer_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as objects found; their labels tell which were copied and which failed."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    named = documents.select(
        "doc_id", "n_chars", F.lit("dbo").alias("schema_name"), F.concat_ws("/", "source", "lang").alias("table_name")
    )
    no_text = F.lit(None).cast("string")
    found = named.select("schema_name", "table_name", F.lit("found").alias("state"),
                         no_text.alias("error_code"), no_text.alias("error_detail"))
    labelled = named.join(labels, "doc_id", "left")
    is_labelled, toxic = F.col("quality").isNotNull(), F.coalesce(F.col("toxic") == 1, F.lit(False))
    failed = toxic & (F.col("quality") == 0)
    state = F.when(failed, "failed").when(is_labelled, "copied").otherwise("skipped")
    code = F.when(failed, "PERMISSION_DENIED").when(toxic, "NOT_FOUND")
    detail = F.when(toxic, F.format_string("object %012d", "doc_id"))
    moved = labelled.where((F.col("n_chars") > 120) | is_labelled).select(
        "schema_name", "table_name", state.alias("state"), code.alias("error_code"), detail.alias("error_detail")
    )
    accounts = landing.transfer_accounting(found.unionByName(moved))
    shown = F.transform("errors", lambda e: F.concat_ws(":", e["error_code"], e["count"].cast("string"), e["sample_detail"]))
    return accounts.withColumn("errors", F.array_join(shown, ",")).drop("schema_name")


@registry.add("select * from supplier")
def strip_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column brought back as NULL and dropped again leaves the rows as they were."""
    target = VersionedTable(spark, scratch_path(spark, "target"))
    target.replace(table(spark, sf_dir, "supplier"))
    target.replace(with_target_column(target, "source_row_id"))
    drop_target_column(target, "source_row_id")
    return target.read()


@registry.add("""
select *, cast((row_number() over (order by event_id) - 1) // 2500 as bigint) as batch_index
from (select event_id, ts, user_id, event_type, value from events)
""")
def strip_landed_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _land(table(spark, sf_dir, "events"), ["event_id"], 2500)
    cleaned = landing.strip_column(spark, path, "props", scratch_path(spark, "landing"))
    kept = T.StructType([f for f in table(spark, sf_dir, "events").schema.fields if f.name != "props"])
    return landing.read_landed(spark, cleaned, kept)


@registry.add(_MERGED_SQL)
def batch_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole source against a half-loaded target, twice."""
    orders = table(spark, sf_dir, "orders")
    target = VersionedTable(spark, scratch_path(spark, "target"))
    target.replace(_loaded(orders))
    for _ in range(2):
        sync_rows(target, _staged(orders), ["o_orderkey"])
    return target.read()


@registry.add(_MERGED_SQL)
def stream_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed batches merged by a stream into a half-loaded target; a second call finds nothing to do."""
    orders = table(spark, sf_dir, "orders")
    path, _ = _land(_staged(orders), ["o_orderkey"], 4000)
    target = VersionedTable(spark, scratch_path(spark, "target"))
    target.replace(_loaded(orders))
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):
        sync_stream(spark, path, orders.schema, ["o_orderkey"], target, checkpoint, max_files=16).awaitTermination()
    return target.read()


_SOURCE_TYPES = {"bigint": "bigint", "int": "int", "string": "nvarchar", "double": "decimal", "timestamp_ntz": "date"}


def catalog_of(spark: SparkSession, sf_dir: str, keys: dict[str, list[str]]) -> Catalog:
    """The given tables as one schema of a source database, with these primary keys."""
    schemas = {name: table(spark, sf_dir, name).schema for name in keys}

    def objects(names, **values):
        return [{"table_schema": "dbo", "table_name": name, **values} for name in names]

    def column(name: str, position: int, field: T.StructField) -> dict:
        kind = _SOURCE_TYPES[field.dataType.simpleString()]
        size = {"numeric_precision": 18, "numeric_scale": 2} if kind == "decimal" else {}
        return {"table_schema": "dbo", "table_name": name, "column_name": field.name, "data_type": kind,
                "ordinal_position": position, **size}

    constraints = [{**row, "constraint_name": f"PK_{row['table_name']}"}
                   for row in objects([n for n, key in keys.items() if key], constraint_type="PRIMARY KEY")]
    key_columns = [{"table_schema": "dbo", "constraint_name": f"PK_{name}", "column_name": c, "ordinal_position": i}
                   for name, key in keys.items() for i, c in enumerate(key)]
    return Catalog(
        local_frame(spark, objects(keys, table_type="BASE TABLE"), S.TABLES),
        local_frame(spark, [column(n, i, f) for n, s in schemas.items() for i, f in enumerate(s.fields)], S.COLUMNS),
        local_frame(spark, constraints, S.CONSTRAINTS),
        local_frame(spark, key_columns, S.KEY_COLUMNS),
    )


def _as_double(df: DataFrame) -> DataFrame:
    """Decimals of two places as the doubles they came from."""

    def plain(f: T.StructField) -> Column:
        return F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)

    return df.select([plain(f) for f in df.schema.fields])


@registry.add("select * replace (o_orderdate::date as o_orderdate) from orders")
def table_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table copied from plan to target, in four commits."""
    settings = Settings(scratch_path(spark, "estate"), batch_size=2000, max_commits=4)
    row = find_table(build_plan(catalog_of(spark, sf_dir, {"orders": ["o_orderkey"]})), "orders")
    run_table(spark, settings, row, ParquetSource(spark, sf_dir))
    return _as_double(VersionedTable(spark, settings.target_path(row)).read())


@registry.add("""
with b as (select cast((rn - 1) // 2000 as bigint) as batch, max(o_orderkey) as pk
           from (select o_orderkey, row_number() over (order by o_orderkey) as rn from orders) group by 1)
select 'orders' as table_name, 'IN_PROGRESS' as status, batch as last_batch_index, '{"o_orderkey":' || pk || '}' as last_pk_json from b
union all
select 'orders', 'COMPLETED', max(batch), '{"o_orderkey":' || max(pk) || '}' from b
""")
def checkpoint_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoints a run leaves: one per batch, and the closing one."""
    settings = Settings(scratch_path(spark, "estate"), batch_size=2000)
    row = find_table(build_plan(catalog_of(spark, sf_dir, {"orders": ["o_orderkey"]})), "orders")
    run_table(spark, settings, row, ParquetSource(spark, sf_dir))
    history = Ledger(spark, settings.control_path(None)).checkpoints()
    return history.select("table_name", "status", "last_batch_index", "last_pk_json")


@registry.add("""
select * replace (l_shipdate::date as l_shipdate) from lineitem where l_shipdate < timestamp '1999-01-01'
""")
def keyless_table_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a key, copied up to a cutoff by frozen row numbers that are gone afterwards."""
    settings = Settings(
        scratch_path(spark, "estate"), batch_size=20_000, max_commits=3, cutoff="1998-12-31", cutoff_column="l_shipdate"
    )
    row = find_table(build_plan(catalog_of(spark, sf_dir, {"lineitem": []})), "lineitem")
    run_table(spark, settings, row, ParquetSource(spark, sf_dir))
    return _as_double(VersionedTable(spark, settings.target_path(row)).read())


@registry.add("""
select 'lineitem' as name, 'SUCCESS_LANDED_ONLY' as status, cast(ceil(count(*) / 25000.0) as bigint) as batches_processed,
       count(*) as rows_processed, count(*) as rows_landed, cast(11 as bigint) as columns_landed from lineitem
""")
def landing_only_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land and verify only: no row number in the files, no checkpoint, nothing in the target."""
    settings = Settings(scratch_path(spark, "estate"), batch_size=25_000)
    row = find_table(build_plan(catalog_of(spark, sf_dir, {"lineitem": []})), "lineitem")
    done = run_table(spark, settings, row, ParquetSource(spark, sf_dir), run_id="once", stage=LAND_ONLY)
    landed = spark.read.parquet(settings.landing_path(row)).drop("batch_index")
    return landed.agg(F.count(F.lit(1)).alias("rows_landed")).select(
        F.lit(done["name"]).alias("name"), F.lit(done["status"]).alias("status"),
        F.lit(done["batches_processed"]).cast("bigint").alias("batches_processed"),
        F.lit(done["rows_processed"]).cast("bigint").alias("rows_processed"),
        "rows_landed", F.lit(len(landed.columns)).cast("bigint").alias("columns_landed"),
    )


_ESTATE = {"customer": ["c_custkey"], "orders": ["o_orderkey"], "conversations": ["conv_id", "turn"], "lineitem": []}


@registry.add("\nunion all\n".join(
    f"select '{name}' as table_name, 'SUCCESS' as last_run_outcome, count(*) as last_run_rows_processed, "
    f"count(*) as total_rows_in_target from {name}" for name in _ESTATE))
def estate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables copied side by side; the status report that follows."""
    settings = Settings(scratch_path(spark, "estate"), batch_size=10_000, max_commits=2)
    plan = build_plan(catalog_of(spark, sf_dir, _ESTATE))
    _, reports = run_estate(spark, settings, plan, ParquetSource(spark, sf_dir))
    return reports[0].read().select(
        "table_name", "last_run_outcome", "last_run_rows_processed", "total_rows_in_target"
    )


class _Reversed(ParquetSource):
    """The same rows the other way round, as a database without ORDER BY may give them."""

    def scan(self, table):
        return super().scan(table).orderBy(F.desc("l_orderkey"), F.desc("l_linenumber"))


class _Killed(BaseException):
    """The end of a driver: no handler runs."""


def _killed_after_first_append(run: TableRun) -> None:
    """Let a run die between its first append to the target and the checkpoint that follows."""

    def die(*_, **__):
        raise _Killed

    run.ledger.commit_batches = die
    try:
        run.run()
    except _Killed:
        pass


@registry.add("select * replace (l_shipdate::date as l_shipdate) from lineitem")
def keyless_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a key whose driver dies after an append; then the source gives another order."""
    settings = Settings(scratch_path(spark, "estate"), batch_size=5_000, max_commits=4)
    row = find_table(build_plan(catalog_of(spark, sf_dir, {"lineitem": []})), "lineitem")
    _killed_after_first_append(TableRun(spark, settings, row, ParquetSource(spark, sf_dir), "first"))
    run_table(spark, settings, row, _Reversed(spark, sf_dir))
    return _as_double(VersionedTable(spark, settings.target_path(row)).read())


#: Orders are cut into five batches, so that a break at the third is one at every scale.
_FIFTH_SQL = "s as (select cast(ceil(count(*) / 5.0) as bigint) as size, count(*) as total from orders)"


def _fifth(orders: DataFrame) -> int:
    return -(-orders.count() // 5)


def _break_at_batch(run: TableRun, index: int) -> None:
    """Let a run fail when it comes to merge that batch."""
    merge_one = run._merge

    def flaky(commit, edges):
        if commit["first_batch"] == index:
            raise OSError("link down")
        merge_one(commit, edges)

    run._merge = flaky
    try:
        run.run()
    except OSError:
        pass


@registry.add("""
with s as (select least(1000, cast(ceil(count(*) / 5.0) as bigint)) as size, count(*) as total from orders)
select 'FAILED' as outcome, cast(2 as bigint) as batches_processed, 2 * size as rows_processed, cast(0 as bigint) as resumed_from_batch,
       2 * size as rows_in_target from s
union all
select 'RESUMED_SUCCESS', cast(ceil(total * 1.0 / size) as bigint) - 2, total - 2 * size, 2, total from s
""")
def resumed_table_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails at its third commit, and the one that picks up there: what both audits say, and the target's rows.

    Batches have 1,000 orders and are committed one by one; fewer than 5,000 orders are cut into five, so that the break is there.
    """
    size = min(1000, _fifth(table(spark, sf_dir, "orders")))
    settings = Settings(scratch_path(spark, "estate"), batch_size=size, batches_per_commit=1)
    row = find_table(build_plan(catalog_of(spark, sf_dir, {"orders": ["o_orderkey"]})), "orders")
    target = VersionedTable(spark, settings.target_path(row))
    _break_at_batch(TableRun(spark, settings, row, ParquetSource(spark, sf_dir), "first"), 2)
    rows = [target.row_count()]
    run_table(spark, settings, row, ParquetSource(spark, sf_dir), "second")
    rows.append(target.row_count())
    audit = Ledger(spark, settings.control_path(None)).audit()
    seen = F.when(F.col("run_id") == "first", F.lit(rows[0])).otherwise(F.lit(rows[1])).cast("bigint")
    return audit.select("outcome", "batches_processed", "rows_processed", "resumed_from_batch", seen.alias("rows_in_target"))


@registry.add(f"""
with {_FIFTH_SQL},
b as (select (row_number() over (order by o_orderkey) - 1) // size as batch, o_orderkey from orders, s)
select cast(batch as bigint) as batch_index, count(*) as rows_landed, min(o_orderkey) as first_key, max(o_orderkey) as last_key,
       count(*) as rows_expected, case when batch < 2 then 'load' else 'landing' end as landed_by
from b group by batch
""")
def resumed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that breaks at its third batch, then a landing-only run for the rest: every batch is there, and in the manifest."""
    settings = Settings(scratch_path(spark, "estate"), batch_size=_fifth(table(spark, sf_dir, "orders")), batches_per_commit=1)
    row = find_table(build_plan(catalog_of(spark, sf_dir, {"orders": ["o_orderkey"]})), "orders")
    _break_at_batch(TableRun(spark, settings, row, ParquetSource(spark, sf_dir), "load"), 2)
    run_table(spark, settings, row, ParquetSource(spark, sf_dir), "landing", stage=LAND_ONLY)
    area = landing.LandingArea(spark, settings.landing_path(row))
    landed = spark.read.parquet(area.path).groupBy("batch_index").agg(
        F.count(F.lit(1)).alias("rows_landed"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    landed = landed.withColumn("batch_index", F.col("batch_index").cast("bigint"))
    expected = area.manifest().select("batch_index", F.col("rows").alias("rows_expected"), F.col("run_id").alias("landed_by"))
    return landed.join(expected, "batch_index", "full_outer")


@registry.add("""
select 'SUCCESS' as first_status, 'SKIPPED' as second_status, 'SUCCESS' as forced_status, count(*) as rows_in_target,
       cast(2 as bigint) as audits from orders
""")
def skipped_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A completed table is skipped, leaves no audit row then, and is read again when forced; nothing comes twice."""
    settings = Settings(scratch_path(spark, "estate"), batch_size=4000)
    row = find_table(build_plan(catalog_of(spark, sf_dir, {"orders": ["o_orderkey"]})), "orders")
    first, second, forced = (run_table(spark, settings, row, ParquetSource(spark, sf_dir), force=f)["status"] for f in (False, False, True))
    target, audits = VersionedTable(spark, settings.target_path(row)).read(), Ledger(spark, settings.control_path(None)).audit().count()
    return target.agg(F.count(F.lit(1)).alias("rows_in_target")).select(
        F.lit(first).alias("first_status"), F.lit(second).alias("second_status"), F.lit(forced).alias("forced_status"),
        "rows_in_target", F.lit(audits).cast("bigint").alias("audits"))


@registry.add("""
select * replace (o_orderdate::date as o_orderdate) from orders where o_orderstatus <> 'O'
union all
select * replace (o_orderdate::date as o_orderdate, o_totalprice + 1 as o_totalprice) from orders where o_orderstatus = 'O'
""")
def incremental_table_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs: the second sees changed prices and adds only the orders that are new."""
    orders = table(spark, sf_dir, "orders")
    settings = Settings(scratch_path(spark, "estate"), batch_size=4000)
    plan = build_plan(catalog_of(spark, sf_dir, {"orders": ["o_orderkey"]})).withColumn("load_mode", F.lit(S.INCREMENTAL))
    row = find_table(plan, "orders")
    for rows in (_loaded(orders), _staged(orders)):
        run_table(spark, settings, row, FrameSource({"orders": rows}))
    return _as_double(VersionedTable(spark, settings.target_path(row)).read())


@registry.add(f"""
with {_FIFTH_SQL},
n as (select count(*) as lacking from orders where o_orderstatus = 'O')
select 'FAILED' as outcome, cast(1 as bigint) as batches_processed, least(size, lacking) as rows_processed,
       cast(0 as bigint) as resumed_from_batch, cast(total as bigint) as rows_in_target, cast(total as bigint) as keys_in_target from s, n
union all
select 'RESUMED_SUCCESS', cast(ceil(lacking * 1.0 / size) as bigint) - 1,
       (select count(*) from orders where o_orderkey > (select max(o_orderkey) from
            (select o_orderkey from orders where o_orderstatus = 'O' order by 1 limit (select cast(ceil(count(*) / 5.0) as bigint) from orders)))),
       1, total, total from s, n
""")
def incremental_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental run that breaks after the first batch of what the target lacked, and the one that finishes it."""
    orders = table(spark, sf_dir, "orders")
    settings = Settings(scratch_path(spark, "estate"), batch_size=_fifth(orders), batches_per_commit=1)
    plan = build_plan(catalog_of(spark, sf_dir, {"orders": ["o_orderkey"]})).withColumn("load_mode", F.lit(S.INCREMENTAL))
    row = find_table(plan, "orders")
    run_table(spark, settings, row, FrameSource({"orders": _loaded(orders)}), "loaded")
    _break_at_batch(TableRun(spark, settings, row, FrameSource({"orders": orders}), "broken"), 1)
    run_table(spark, settings, row, FrameSource({"orders": orders}), "finished")
    target = VersionedTable(spark, settings.target_path(row)).read()
    held = target.agg(F.count(F.lit(1)).alias("rows_in_target"), F.countDistinct("o_orderkey").alias("keys_in_target"))
    audit = Ledger(spark, settings.control_path(None)).audit().where("run_id <> 'loaded'")
    return audit.select("outcome", "batches_processed", "rows_processed", "resumed_from_batch").crossJoin(F.broadcast(held))


@registry.add("""
select 'r' || r_regionkey || '_dbo' as dataset, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def regional_estate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's customers from that region's own source, under one table name; one more region cannot be reached."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    settings = Settings(scratch_path(spark, "estate"), batch_size=1000, max_commits=2)
    keys = [r["r_regionkey"] for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect()]
    regions = local_frame(spark, [{"region": f"R {k}", "host": f"h{k}"} for k in [*keys, "gone"]], S.REGIONS)
    plan = build_plan(catalog_of(spark, sf_dir, {"customer": ["c_custkey"]}))

    def connect(region):
        key = region["region"].split()[1]
        if key == "gone":
            raise OSError("no such host")
        slug = f"r{key}"
        own = plan.withColumns({"region": F.lit(region["region"]), "region_slug": F.lit(slug), "dataset": F.lit(f"{slug}_dbo")})
        nations = nation.where(F.col("n_regionkey") == int(key)).select(F.col("n_nationkey").alias("c_nationkey"))
        return own, FrameSource({"customer": customer.join(nations, "c_nationkey", "left_semi")})

    run_regions(spark, settings, regions, "all", connect)
    targets = [VersionedTable(spark, f"{settings.root}/data/r{k}_dbo/customer").read().withColumn("dataset", F.lit(f"r{k}_dbo")) for k in keys]
    return _as_double(reduce(DataFrame.unionByName, targets)).select("dataset", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _two_runs(spark: SparkSession, sf_dir: str) -> Ledger:
    settings = Settings(scratch_path(spark, "estate"), batch_size=5000, max_commits=1)
    plan = build_plan(catalog_of(spark, sf_dir, {"orders": ["o_orderkey"], "customer": ["c_custkey"]}))
    for name in ("orders", "customer"):
        run_table(spark, settings, find_table(plan, name), ParquetSource(spark, sf_dir), run_id=f"run of {name}")
    return Ledger(spark, settings.control_path(None))


_STAGES_SQL = " union all ".join(
    f"select '{stage}' as stage, {rows} as counted" for stage, rows in
    [("pipeline", "true"), ("extraction", "true"), ("upload", "false"), ("transfer", "false"), ("load", "true")])


@registry.add(f"""
with t as (select 'orders' as table_name, count(*) as n from orders union all select 'customer', count(*) from customer),
s as ({_STAGES_SQL})
select 'run of ' || table_name as run_id, table_name, stage, status,
       case when status = 'SUCCESS' and counted then n end as rows_processed, status = 'STARTED' as is_start
from t, s, (select unnest(['STARTED', 'SUCCESS']) as status)
""")
def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage events that two runs wrote, read back."""
    return _two_runs(spark, sf_dir).events().select(
        "run_id", "table_name", "stage", "status", "rows_processed", F.col("finished_at").isNull().alias("is_start"))


@registry.add("""
with t as (select 'orders' as table_name, count(*) as n from orders union all select 'customer', count(*) from customer)
select 'run of ' || table_name as run_id, table_name, 'dbo' as schema_name, 'full' as load_mode, 'SUCCESS' as outcome,
       cast(ceil(n / 5000.0) as bigint) as batches_processed, n as rows_processed, cast(0 as bigint) as resumed_from_batch from t
""")
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit rows that two runs wrote, read back."""
    return _two_runs(spark, sf_dir).audit().drop("started_at", "finished_at", "error_message", "run_date")
