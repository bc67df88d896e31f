"""Discovery and planning over a catalog that grows with the data: every order is a table,
every line item a column of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import Registry, table
from ferrylane.functions.types import with_target_types
from ferrylane.plans import planner
from ferrylane.session import local_frame
from ferrylane.sources import catalog as C

registry = Registry()


def _catalog(spark: SparkSession, sf_dir: str) -> C.Catalog:
    orders, customer, nation, region, lineitem = (
        table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region", "lineitem")
    )
    priority = F.col("o_orderpriority")
    schema = F.when(priority == "1-URGENT", "SYS").otherwise(F.regexp_replace(priority, " ", "-"))
    name = F.concat(F.when(F.col("o_totalprice") < 20000, C.SHADOW_PREFIX).otherwise("T"), F.col("o_orderkey").cast("string"))
    located = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    objects = located.select(
        F.col("r_name").alias("region"), schema.alias("table_schema"), name.alias("table_name"), "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "VIEW").otherwise("BASE TABLE").alias("table_type"),
        F.when(F.col("o_totalprice") > 250000, "PRIMARY KEY").otherwise("UNIQUE").alias("constraint_type"),
        F.concat(F.lit("K_"), F.col("o_orderkey").cast("string")).alias("constraint_name"),
    )
    lines = lineitem.join(objects, lineitem.l_orderkey == objects.o_orderkey)
    taken = (F.col("l_linenumber") == 7) & (F.col("l_linestatus") == "O")
    own_name = F.concat_ws("_", F.lit("c"), "l_linenumber", "l_partkey", "l_suppkey")
    exact = F.col("l_returnflag") == "A"
    columns = lines.select(
        "region", "table_schema", "table_name",
        F.when(taken, "Source_Row_ID").otherwise(own_name).alias("column_name"),
        F.when(exact, "decimal").when(F.col("l_returnflag") == "N", "varchar(20)").otherwise("datetime2").alias("data_type"),
        F.when(exact, 18).alias("numeric_precision"),
        F.when(exact, F.col("l_linenumber")).alias("numeric_scale"),
        F.col("l_linenumber").alias("ordinal_position"),
    )
    key_columns = lines.where(F.col("l_linestatus") == "F").select(
        "region", "table_schema", "constraint_name", own_name.alias("column_name"),
        (10 - F.col("l_linenumber")).alias("ordinal_position"),
    )
    return C.Catalog(
        objects.select("region", "table_schema", "table_name", "table_type"),
        columns,
        objects.select("region", "table_schema", "table_name", "constraint_name", "constraint_type"),
        key_columns,
    )


_CATALOG_SQL = """
with o as (
  select o_orderkey, r_name as region, case when o_orderpriority = '1-URGENT' then 'SYS'
             else replace(o_orderpriority, ' ', '-') end as table_schema,
         case when o_totalprice < 20000 then '__migration_rownum__' else 'T' end || o_orderkey as table_name,
         case when o_orderstatus = 'P' then 'VIEW' else 'BASE TABLE' end as table_type,
         o_totalprice > 250000 as has_key
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey),
t as (select * from o where table_type = 'BASE TABLE' and lower(table_schema) <> 'sys'
         and not starts_with(table_name, '__migration_rownum__')),
l as (select l_orderkey, l_linenumber, 'c_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey as own_name,
             l_linestatus, case when l_linenumber = 7 and l_linestatus = 'O' then 'Source_Row_ID'
                 else 'c_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey end as column_name,
             case l_returnflag when 'A' then 'decimal' when 'N' then 'varchar(20)' else 'datetime2' end as data_type,
             case when l_returnflag = 'A' then 'decimal(18,' || l_linenumber || ')'
                  when l_returnflag = 'N' then 'string' else 'timestamp' end as spark_type
      from lineitem),
k as (select o_orderkey, string_agg(own_name, ',' order by 10 - l_linenumber, own_name) as primary_key
      from o join l on l_orderkey = o_orderkey where has_key and l_linestatus = 'F' group by 1),
c as (select o_orderkey, string_agg(column_name || ' ' || spark_type, ',' order by l_linenumber, column_name, data_type) as columns,
             bool_or(lower(column_name) = 'source_row_id') as taken
      from o join l on l_orderkey = o_orderkey group by 1)
"""


@registry.add(_CATALOG_SQL + """
select distinct region, table_schema as "schema" from o where table_type = 'BASE TABLE' and lower(table_schema) <> 'sys'
""")
def schema_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.discover_schemas(_catalog(spark, sf_dir).tables)


@registry.add(_CATALOG_SQL + 'select region, table_schema as "schema", table_name as name from t')
def table_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.discover_tables(_catalog(spark, sf_dir).tables)


@registry.add(_CATALOG_SQL + """
select region, table_schema as "schema", table_name as name, primary_key from k join o on o.o_orderkey = k.o_orderkey
""")
def pk_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _catalog(spark, sf_dir)
    keys = C.primary_keys(found.constraints, found.key_columns)
    return keys.withColumn("primary_key", F.array_join("primary_key", ","))


def _described(columns: str = "columns"):
    return F.array_join(F.transform(columns, lambda c: F.concat_ws(" ", c["name"], c["spark_type"])), ",")


@registry.add(_CATALOG_SQL + """
select region, table_schema as "schema", table_name as name, columns from c join o on o.o_orderkey = c.o_orderkey
""")
def column_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = C.table_columns(with_target_types(_catalog(spark, sf_dir).columns), extra=("spark_type",))
    return columns.withColumn("columns", _described())


@registry.add(_CATALOG_SQL + """
select region, table_schema as "schema", table_name as name, 'full' as load_mode,
       coalesce(primary_key, case when taken then '_migration_row_id' else 'source_row_id' end) as primary_key,
       primary_key is null as synthetic_key,
       concat_ws(',', nullif(columns, ''), case when primary_key is null then
           case when taken then '_migration_row_id' else 'source_row_id' end || ' bigint' end) as columns,
       replace(lower(region), ' ', '_') || '_' || regexp_replace(table_schema, '[^A-Za-z0-9_]', '_', 'g') as dataset
from t left join k on k.o_orderkey = t.o_orderkey left join c on c.o_orderkey = t.o_orderkey
""")
def plan_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan row for every base table of five regions, keyless ones with a synthetic key."""
    plan = planner.build_plan(_catalog(spark, sf_dir))
    return plan.select(
        "region", "schema", "name", "load_mode", F.array_join("primary_key", ",").alias("primary_key"),
        "synthetic_key", _described().alias("columns"), "dataset",
    )


@registry.add(_CATALOG_SQL + """
select region, table_schema as "schema", table_name as name, k.o_orderkey is null as synthetic_key
from t left join k on k.o_orderkey = t.o_orderkey where table_name = (select max(table_name) from t)
""")
def table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan row of one table out of all: the one whose name comes last."""
    plan = planner.build_plan(_catalog(spark, sf_dir))
    row = planner.find_table(plan, plan.agg(F.max("name")).first()[0])
    shown = {name: row[name] for name in ("region", "schema", "name", "synthetic_key")}
    return local_frame(spark, [shown], "region string, schema string, name string, synthetic_key boolean")


_OVERRIDES_SQL = """
with v as (select s_suppkey as position, n_name as name,
             case when s_acctbal < 3000 then null when s_acctbal < 5000 then 'BUILDING'
                  when s_acctbal < 7000 then 'MACHINERY' else 'HOUSEHOLD' end as "schema",
             case when s_acctbal - floor(s_acctbal) < 0.3 then null
                  when s_acctbal - floor(s_acctbal) < 0.6 then 'A-S-I-A ' else r_name end as region,
             case when s_acctbal - floor(s_acctbal) < 0.5 then 'incremental' end as load_mode,
             case when s_acctbal > 9000 then true when s_acctbal < 1000 then false end as exclude
      from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
t as (select c_custkey, r_name as region, c_mktsegment as "schema", n_name as name
      from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
m as (select t.c_custkey, v.load_mode, coalesce(v.exclude, false) as exclude, row_number() over (
             partition by c_custkey order by v."schema" is not null desc, v.region is not null desc, v.position desc) as rn
      from t join v on v.name = t.name and (v."schema" is null or v."schema" = t."schema")
           and (v.region is null or regexp_replace(lower(v.region), '[^a-z0-9]', '', 'g') = regexp_replace(lower(t.region), '[^a-z0-9]', '', 'g')))
select t.c_custkey, m.load_mode, m.exclude from t left join m on m.c_custkey = t.c_custkey and rn = 1
"""


@registry.add(_OVERRIDES_SQL)
def override_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tables, suppliers as overrides for their nation's tables."""
    customer, supplier, nation, region = (table(spark, sf_dir, t) for t in ("customer", "supplier", "nation", "region"))
    located = nation.join(region, nation.n_regionkey == region.r_regionkey)
    tables = customer.join(located, customer.c_nationkey == located.n_nationkey).select(
        "c_custkey", F.col("r_name").alias("region"), F.col("c_mktsegment").alias("schema"), F.col("n_name").alias("name")
    )
    balance = F.col("s_acctbal")
    cents = balance - F.floor(balance)
    overrides = supplier.join(located, supplier.s_nationkey == located.n_nationkey).select(
        F.col("s_suppkey").alias("position"),
        F.col("n_name").alias("name"),
        F.when(balance < 3000, None).when(balance < 5000, "BUILDING").when(balance < 7000, "MACHINERY")
        .otherwise("HOUSEHOLD").alias("schema"),
        F.when(cents < 0.3, None).when(cents < 0.6, "A-S-I-A ").otherwise(F.col("r_name")).alias("region"),
        F.when(cents < 0.5, "incremental").alias("load_mode"),
        F.when(balance > 9000, True).when(balance < 1000, False).alias("exclude"),
    )
    chosen = planner.resolve_overrides(tables, overrides)
    return chosen.select("c_custkey", F.col("override.load_mode").alias("load_mode"), F.col("override.exclude").alias("exclude"))


@registry.add("""
select case when s_acctbal > 5000 then 'incremental' else 'full' end as load_mode, count(*) as tables
from supplier group by 1
""")
def plan_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = F.when(F.col("s_acctbal") > 5000, "incremental").otherwise("full")
    return planner.load_mode_counts(table(spark, sf_dir, "supplier").withColumn("load_mode", mode))
