"""The plan: one row per table to copy, with its key, columns, mode and names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane.functions import naming
from ferrylane.functions.types import with_target_types
from ferrylane.schemas import FULL, LOAD_MODES
from ferrylane.sources.catalog import (
    SYNTHETIC_KEY,
    SYNTHETIC_KEY_IF_TAKEN,
    Catalog,
    discover_schemas,
    discover_tables,
    primary_keys,
    table_columns,
)

TABLE_KEY = ["region", "schema", "name"]
MAX_BROADCAST_OVERRIDES = 200_000


class TableNotFound(LookupError):
    """No planned table has this name (in this schema)."""


class AmbiguousTable(LookupError):
    """The name exists in several schemas and none was given."""


class SchemaNotFound(LookupError):
    """No schema of this name holds tables."""


def resolve_overrides(tables: DataFrame, overrides: DataFrame) -> DataFrame:
    """Attach to each table the one override that applies, as a struct, or NULL.

    A NULL schema or region in an override means any. An exact schema beats any
    schema; then a matching region beats any region; then the later entry wins.
    Each of the four kinds is reduced to one row per key before an equi-join, so
    no table ever meets more than one candidate of a kind.
    """
    entry = F.struct("load_mode", F.coalesce("exclude", F.lit(False)).alias("exclude"))
    # An empty region name counts as none given.
    keyed = overrides.where(F.coalesce("name", F.lit("")) != "").select(
        F.col("name"),
        F.col("schema"),
        F.when(F.col("region") != "", naming.normalise_region(F.col("region"))).alias("region_key"),
        "position",
        entry.alias("entry"),
    )
    # Overrides are written by hand and few. Counted, not assumed: beyond the limit Spark picks the join.
    few = overrides.limit(MAX_BROADCAST_OVERRIDES + 1).count() <= MAX_BROADCAST_OVERRIDES
    resolved = tables.withColumn("region_key", naming.normalise_region(F.col("region")))
    candidates = []
    for exact_schema in (True, False):
        for exact_region in (True, False):
            kind = keyed.where(F.col("schema").isNotNull() if exact_schema else F.col("schema").isNull())
            kind = kind.where(F.col("region_key").isNotNull() if exact_region else F.col("region_key").isNull())
            on = ["name"] + ["schema"] * exact_schema + ["region_key"] * exact_region
            column = f"__override_{len(candidates)}"
            latest = kind.groupBy(*on).agg(F.max_by("entry", "position").alias(column))
            resolved = resolved.join(F.broadcast(latest) if few else latest, on, "left")
            candidates.append(column)
    chosen = F.coalesce(*candidates).alias("override")
    return resolved.select(*[F.col(c) for c in tables.columns], chosen)


def _with_synthetic_key(tables: DataFrame) -> DataFrame:
    """Give tables without a key a bigint row-number column, placed last."""
    taken = F.exists("columns", lambda c: F.lower(c["name"]) == SYNTHETIC_KEY)
    row_id = F.when(taken, SYNTHETIC_KEY_IF_TAKEN).otherwise(SYNTHETIC_KEY)
    no_size = F.lit(None).cast("int")
    described = F.struct(
        row_id.alias("name"),
        F.lit("bigint").alias("source_type"),
        no_size.alias("precision"),
        no_size.alias("scale"),
        F.lit("INT64").alias("logical_type"),
        F.lit("bigint").alias("spark_type"),
    )
    missing = F.size("primary_key") == 0
    return tables.select(
        *[F.col(c) for c in tables.columns if c not in ("primary_key", "columns")],
        F.when(missing, F.array(row_id)).otherwise(F.col("primary_key")).alias("primary_key"),
        missing.alias("synthetic_key"),
        F.when(missing, F.concat("columns", F.array(described))).otherwise(F.col("columns")).alias("columns"),
    )


def build_plan(
    catalog: Catalog,
    overrides: DataFrame | None = None,
    schemas: Sequence[str] | str | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Plan every discovered table of every region, or only those of one ``schema``."""
    tables = discover_tables(catalog.tables, schemas)
    if schema is not None:
        known = discover_schemas(catalog.tables, schemas)
        if known.where(F.col("schema") == schema).isEmpty():
            names = [r["schema"] for r in known.select("schema").distinct().orderBy("schema").collect()]
            raise SchemaNotFound(f"schema {schema!r} was not found; known: {', '.join(names) or '(none)'}")
        tables = tables.where(F.col("schema") == schema)

    if overrides is None:
        kept = tables.withColumn("load_mode", F.lit(FULL))
    else:
        chosen = resolve_overrides(tables, overrides)
        mode = F.coalesce(F.nullif("override.load_mode", F.lit("")), F.lit(FULL))
        bad = F.raise_error(F.concat(F.lit("unknown load_mode "), mode, F.lit(" for table "), F.col("name")))
        kept = chosen.where(~F.coalesce("override.exclude", F.lit(False))).select(
            *TABLE_KEY, F.when(mode.isin(*LOAD_MODES), mode).otherwise(bad.cast("string")).alias("load_mode")
        )

    keys = primary_keys(catalog.constraints, catalog.key_columns)
    columns = table_columns(with_target_types(catalog.columns), extra=("logical_type", "spark_type"))
    planned = _left_on_table(_left_on_table(kept, keys), columns)
    planned = planned.withColumns({
        "primary_key": F.coalesce("primary_key", F.array().cast("array<string>")),
        "columns": F.coalesce("columns", F.array().cast(columns.schema["columns"].dataType)),
    })
    slug = naming.region_slug(F.col("region"))
    return _with_synthetic_key(planned).withColumns({
        "region_slug": slug,
        "dataset": naming.dataset_name(F.col("schema"), slug),
    })


def _left_on_table(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on (region, schema, name); a missing region equals a missing region."""
    renamed = right.withColumnsRenamed({c: f"__right_{c}" for c in TABLE_KEY})
    same = [F.col(c).eqNullSafe(F.col(f"__right_{c}")) for c in TABLE_KEY]
    return left.join(renamed, same, "left").drop(*[f"__right_{c}" for c in TABLE_KEY])


def split_schema_table(raw: str, schema: str | None = None) -> tuple[str, str | None]:
    """``dbo.orders`` -> (``orders``, ``dbo``); a bare name keeps the given schema."""
    if "." not in raw:
        return raw, schema
    parts = raw.split(".")
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"{raw!r} is not of the form schema.table")
    if schema and schema != parts[0]:
        raise ValueError(f"{raw!r} and schema {schema!r} disagree")
    return parts[1], parts[0]


def find_table(plan: DataFrame, name: str, schema: str | None = None, region: str | None = None) -> T.Row:
    """The plan row of one table. Only rows of that name are planned and looked at."""
    named = plan.where(F.col("name") == name)
    if region is not None:
        named = named.where(naming.same_region(F.col("region"), F.lit(region)))
    # At most one row per region and schema.
    rows = named.collect()
    found = sorted({r["schema"] for r in rows})
    where_found = ", ".join(found)
    if schema is not None and schema not in found:
        hint = f"; it exists in: {where_found}" if found else ""
        raise TableNotFound(f"table {name!r} was not found in schema {schema!r}{hint}")
    if not found:
        raise TableNotFound(f"table {name!r} was not found in any schema")
    if schema is None and len(found) > 1:
        raise AmbiguousTable(f"table {name!r} exists in several schemas: {where_found}; say which")
    matches = [r for r in rows if r["schema"] == (schema or found[0])]
    if len(matches) > 1:
        regions = ", ".join(sorted(str(r["region"]) for r in matches))
        raise AmbiguousTable(f"table {name!r} exists in several regions: {regions}; say which")
    return matches[0]


def load_mode_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("load_mode").agg(F.count(F.lit(1)).alias("tables"))
