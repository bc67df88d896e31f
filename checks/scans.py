"""Predicates, types and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.common import Registry, table
from ferrylane.functions import naming
from ferrylane.functions.keys import key_from_json, key_schema, key_to_json, scan_filter
from ferrylane.functions.types import conform, with_target_types
from ferrylane.operators.batching import key_page
from ferrylane.plans.regions import union_of_regions

registry = Registry()


@registry.add("""
select * from orders
where o_custkey > 75 or (o_custkey = 75 and o_orderkey > 400)
order by o_custkey, o_orderkey limit 500
""")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = {"o_custkey": 75, "o_orderkey": 400}
    return key_page(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey"], 500, last)


@registry.add("select * from events where ts < timestamp '2024-01-16 00:00:00'")
def cutoff_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.where(scan_filter(events.schema, ["event_id"], cutoff="2024-01-15", cutoff_column="ts"))


@registry.add("select * from events where ts <= timestamp '2024-01-15 12:00:00'")
def cutoff_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.where(scan_filter(events.schema, ["event_id"], cutoff="2024-01-15T12:00:00", cutoff_column="ts"))


@registry.add("""
select * from orders
where (o_custkey > 75 or (o_custkey = 75 and o_orderkey > 400)) and o_orderdate < timestamp '1999-07-01 00:00:00'
""")
def keyset_with_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    last = {"o_custkey": 75, "o_orderkey": 400}
    return orders.where(
        scan_filter(orders.schema, ["o_custkey", "o_orderkey"], last, "1999-06-30", cutoff_column="o_orderdate")
    )


@registry.add("select event_id, ts, value from events")
def checkpoint_key_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's key through checkpoint JSON and back, microseconds included."""
    events = table(spark, sf_dir, "events")
    keys = ["ts", "event_id"]
    stored = events.select(key_to_json(F.struct(*keys)).alias("pk"), "value")
    decoded = key_from_json(F.col("pk"), key_schema(events.schema, keys))
    return stored.select(decoded["event_id"].alias("event_id"), decoded["ts"].alias("ts"), "value")


@registry.add("""
select o_orderkey, round_even(o_totalprice::decimal(15,2), 1)::decimal(15,1) as o_totalprice
from orders
""")
def decimal_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType.fromDDL("o_orderkey bigint, o_totalprice decimal(15,1)")
    return conform(table(spark, sf_dir, "orders"), schema)


@registry.add("""
with t as (select l_orderkey, l_linenumber, (l_orderkey + 1)::hugeint * 1000000000000000000 + l_partkey as whole,
                  l_linenumber - 1 as kept, (l_suppkey % 3) * 25 + 25 as dropped, l_quantity > 40 as more from lineitem)
select l_orderkey, l_linenumber,
       ((whole::decimal(38,0) * 10 + kept + case when dropped > 50 or dropped = 50 and (more or kept % 2 = 1) then 1 else 0 end)::decimal(38,0))::varchar as value
from t
""")
def decimal_conform_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of more than 18 integer digits as text, over, under and exactly at half of the last digit kept."""
    lineitem = table(spark, sf_dir, "lineitem")
    whole = F.concat((F.col("l_orderkey") + 1).cast("string"), F.lpad(F.col("l_partkey").cast("string"), 18, "0"))
    dropped = ((F.col("l_suppkey") % 3) * 25 + 25).cast("string")
    text = F.concat(whole, F.lit("."), (F.col("l_linenumber") - 1).cast("string"), dropped, F.when(F.col("l_quantity") > 40, "000000001").otherwise("000"))
    typed = conform(lineitem.select("l_orderkey", "l_linenumber", text.alias("value")),
                    T.StructType.fromDDL("l_orderkey bigint, l_linenumber bigint, value decimal(38,1)"))
    return typed.select("l_orderkey", "l_linenumber", F.regexp_replace(F.col("value").cast("string"), "[.]", "").alias("value"))


@registry.add("""
select l_linenumber::bigint as l_linenumber, l_orderkey,
       l_extendedprice::decimal(15,2)::decimal(18,4) as l_extendedprice,
       round_even(l_discount::decimal(15,2), 1)::decimal(3,1) as l_discount,
       l_shipdate::date as l_shipdate, l_returnflag
from lineitem
""")
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan order and plan types: widened integers, exact decimals, dates."""
    schema = T.StructType.fromDDL(
        "l_linenumber bigint, l_orderkey bigint, l_extendedprice decimal(18,4), "
        "l_discount decimal(3,1), l_shipdate date, l_returnflag string"
    )
    return conform(table(spark, sf_dir, "lineitem"), schema)


_COLUMN_TYPES_SQL = """
select l_orderkey, l_linenumber, l_partkey,
       case l_returnflag
            when 'A' then (case l_linestatus when 'O' then 'decimal' else 'Numeric(38)' end)
            when 'N' then (case l_linestatus when 'O' then 'VARCHAR(50)' else 'datetime2' end)
            else (case l_linestatus when 'O' then 'rowversion' else 'xml' end) end as data_type,
       cast(l_quantity as int) - 11 as p, cast(l_linenumber * 2 as int) as s
from lineitem
"""


@registry.add(f"""
with c as ({_COLUMN_TYPES_SQL}),
d as (select *, case when p > s then p end as numeric_precision, case when p > s then s end as numeric_scale from c),
l as (select *, case
    when data_type in ('decimal', 'Numeric(38)') then
        case when numeric_scale > 9 or numeric_precision - coalesce(numeric_scale, 0) > 29 then 'BIGNUMERIC' else 'NUMERIC' end
    when data_type = 'datetime2' then 'TIMESTAMP' when data_type = 'rowversion' then 'BYTES' else 'STRING' end as logical_type
  from d)
select l_orderkey, l_linenumber, l_partkey, data_type, logical_type, case
    when logical_type in ('NUMERIC', 'BIGNUMERIC') then
        case when numeric_precision is null then 'decimal(38,9)'
             else 'decimal(' || numeric_precision || ',' || numeric_scale || ')' end
    when logical_type = 'TIMESTAMP' then 'timestamp' when logical_type = 'BYTES' then 'binary' else 'string' end as spark_type
from l
""")
def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as column descriptions: one type rule for all of them at once."""
    lineitem = table(spark, sf_dir, "lineitem")
    open_line = F.col("l_linestatus") == "O"
    data_type = (
        F.when(F.col("l_returnflag") == "A", F.when(open_line, "decimal").otherwise("Numeric(38)"))
        .when(F.col("l_returnflag") == "N", F.when(open_line, "VARCHAR(50)").otherwise("datetime2"))
        .otherwise(F.when(open_line, "rowversion").otherwise("xml"))
    )
    precision, scale = F.col("l_quantity").cast("int") - 11, F.col("l_linenumber") * 2
    columns = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", data_type.alias("data_type"),
        F.when(precision > scale, precision).alias("numeric_precision"),
        F.when(precision > scale, scale).alias("numeric_scale"),
    )
    return with_target_types(columns).drop("numeric_precision", "numeric_scale")


@registry.add("""
select c_custkey, r_name as region, regexp_replace(lower(r_name), '[^a-z0-9]', '', 'g') as region_key,
       trim(regexp_replace(lower(r_name), '[^a-z0-9]+', '_', 'g'), '_') as region_slug,
       trim(regexp_replace(lower(r_name), '[^a-z0-9]+', '_', 'g'), '_') || '_' ||
           regexp_replace(n_name || '-' || c_mktsegment, '[^A-Za-z0-9_]', '_', 'g') as dataset
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def region_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's customers as a frame of their own, tagged and put together."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))

    def of_region(key: int) -> DataFrame:
        nations = nation.where(F.col("n_regionkey") == key)
        return customer.join(nations, customer.c_nationkey == nations.n_nationkey).select(
            "c_custkey", F.concat_ws("-", "n_name", "c_mktsegment").alias("schema")
        )

    regions = region.collect()
    frames = {r["r_name"]: (lambda key=r["r_regionkey"]: of_region(key)) for r in regions}
    union, _ = union_of_regions(frames)
    slug = naming.region_slug(F.col("region"))
    return union.select(
        "c_custkey", "region", naming.normalise_region(F.col("region")).alias("region_key"),
        slug.alias("region_slug"), naming.dataset_name(F.col("schema"), slug).alias("dataset"),
    )


@registry.add("""
select p_partkey, lower(p_type) || '/' || p_brand || '/' || p_name || '/' || p_name || '_part' ||
       lpad(p_size::varchar, 4, '0') as batch_file,
       'replica_' || lower(p_type) as control, 'landing-' || lower(p_type) as bucket
from part
""")
def destination_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = naming.region_slug(F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        naming.batch_file(slug, F.col("p_brand"), F.col("p_name"), F.col("p_size")).alias("batch_file"),
        naming.control_dataset("replica", slug).alias("control"),
        naming.landing_bucket("landing", slug).alias("bucket"),
    )
