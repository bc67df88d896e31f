"""What a source database says about itself: tables, keys and columns as frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane import schemas as S

# Schemas that belong to the database system itself.
SYSTEM_SCHEMAS = (
    "db_accessadmin",
    "db_backupoperator",
    "db_datareader",
    "db_datawriter",
    "db_ddladmin",
    "db_denydatareader",
    "db_denydatawriter",
    "db_owner",
    "db_securityadmin",
    "guest",
    "information_schema",
    "sys",
)

# The prefix of tables that hold frozen row numbers, and the names the
# row-number column may take.
SHADOW_PREFIX = "__migration_rownum__"
SYNTHETIC_KEY = "source_row_id"
SYNTHETIC_KEY_IF_TAKEN = "_migration_row_id"


@dataclass(frozen=True)
class Catalog:
    """Four frames, each with a ``region`` column; see ``schemas`` for their columns."""

    tables: DataFrame
    columns: DataFrame
    constraints: DataFrame
    key_columns: DataFrame

    @staticmethod
    def union(catalogs: Sequence["Catalog"]) -> "Catalog":
        merged = {
            f.name: reduce(DataFrame.unionByName, [getattr(c, f.name) for c in catalogs])
            for f in fields(Catalog)
        }
        return Catalog(**merged)


def jdbc_catalog(spark: SparkSession, region: str | None, url: str, properties: Mapping[str, str]) -> Catalog:
    """The catalog of one database, read from its INFORMATION_SCHEMA."""

    def view(name: str, ddl: str) -> DataFrame:
        df = spark.read.jdbc(url, f"INFORMATION_SCHEMA.{name}", properties=dict(properties))
        fields = [f for f in T.StructType.fromDDL(ddl).fields if f.name != "region"]
        picked = [F.col(f.name.upper()).cast(f.dataType).alias(f.name) for f in fields]
        return df.select(F.lit(region).cast("string").alias("region"), *picked)

    return Catalog(
        tables=view("TABLES", S.TABLES),
        columns=view("COLUMNS", S.COLUMNS),
        constraints=view("TABLE_CONSTRAINTS", S.CONSTRAINTS),
        key_columns=view("KEY_COLUMN_USAGE", S.KEY_COLUMNS),
    )


def is_shadow(table_name: Column) -> Column:
    return table_name.startswith(SHADOW_PREFIX)


def shadow_name(table_name: Column) -> Column:
    return F.concat(F.lit(SHADOW_PREFIX), table_name)


def _base_tables(tables: DataFrame, schemas: Sequence[str] | str | None) -> DataFrame:
    base = tables.where(F.col("table_type") == "BASE TABLE")
    if schemas and schemas != "*":
        return base.where(F.col("table_schema").isin(list(schemas)))
    return base.where(~F.lower("table_schema").isin(*SYSTEM_SCHEMAS))


def discover_schemas(tables: DataFrame, schemas: Sequence[str] | str | None = None) -> DataFrame:
    """(region, schema) of every schema to copy. A configured list is used as it stands,
    whether or not its schemas hold tables."""
    if schemas and schemas != "*":
        wanted = F.explode(F.array(*[F.lit(s) for s in schemas]))
        return tables.select("region").distinct().select("region", wanted.alias("schema"))
    return _base_tables(tables, None).select("region", F.col("table_schema").alias("schema")).distinct()


def discover_tables(tables: DataFrame, schemas: Sequence[str] | str | None = None) -> DataFrame:
    """(region, schema, name) of every base table, without the engine's own frozen tables."""
    found = _base_tables(tables, schemas).where(~is_shadow(F.col("table_name")))
    return found.select("region", F.col("table_schema").alias("schema"), F.col("table_name").alias("name"))


def primary_keys(constraints: DataFrame, key_columns: DataFrame) -> DataFrame:
    """(region, schema, name, primary_key) with key columns in ordinal order, for all tables
    at once. Tables without a key have no row."""
    primary = constraints.where(F.col("constraint_type") == "PRIMARY KEY")
    on = [
        primary.constraint_name == key_columns.constraint_name,
        primary.table_schema == key_columns.table_schema,
        primary.region.eqNullSafe(key_columns.region),
    ]
    pairs = primary.join(key_columns, on).select(
        primary.region,
        primary.table_schema.alias("schema"),
        primary.table_name.alias("name"),
        key_columns.ordinal_position,
        key_columns.column_name,
    )
    ordered = F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name")))
    grouped = pairs.groupBy("region", "schema", "name").agg(ordered.alias("parts"))
    return grouped.select("region", "schema", "name", F.col("parts.column_name").alias("primary_key"))


def table_columns(columns: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(region, schema, name, columns) with column descriptions in ordinal order."""
    described = F.struct(
        "ordinal_position",
        F.col("column_name").alias("name"),
        F.col("data_type").alias("source_type"),
        F.col("numeric_precision").alias("precision"),
        F.col("numeric_scale").alias("scale"),
        *extra,
    )
    grouped = columns.groupBy("region", F.col("table_schema").alias("schema"), F.col("table_name").alias("name")).agg(
        F.array_sort(F.collect_list(described)).alias("columns")
    )
    without_ordinal = F.transform("columns", lambda c: c.dropFields("ordinal_position"))
    return grouped.withColumn("columns", without_ordinal)
