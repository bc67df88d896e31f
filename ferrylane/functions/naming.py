"""Names derived from regions and schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DatasetCollision(ValueError):
    """Two source schemas would land in the same dataset."""


def normalise_region(name: Column) -> Column:
    """Letters and digits only, lower case: the form in which region names compare."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def region_slug(name: Column) -> Column:
    """``North Central US`` -> ``north_central_us``."""
    return F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


def same_region(a: Column, b: Column) -> Column:
    return F.coalesce((normalise_region(a) == normalise_region(b)) & (a != "") & (b != ""), F.lit(False))


def dataset_name(schema: Column, slug: Column | None = None) -> Column:
    """``[slug_]schema`` with anything but letters, digits and ``_`` replaced by ``_``."""
    given = F.when(F.coalesce(schema, F.lit("")) == "", F.raise_error(F.lit("a schema name is required")).cast("string"))
    safe = given.otherwise(F.regexp_replace(schema, "[^A-Za-z0-9_]", "_"))
    return safe if slug is None else F.concat_ws("_", slug, safe)


def control_dataset(base: str, slug: Column) -> Column:
    """The region's namespace for control tables."""
    return F.concat_ws("_", F.lit(base), slug)


def landing_bucket(base: str, slug: Column) -> Column:
    return F.concat_ws("-", F.lit(base), F.regexp_replace(slug, "_", "-"))


def batch_file(slug: Column, schema: Column, table: Column, batch_index: Column) -> Column:
    """``<slug>/<schema>/<table>/<table>_part0007`` for batch 7; no slug, no first segment."""
    return F.concat_ws("/", slug, schema, table, F.format_string("%s_part%04d", table, batch_index))


def require_distinct_datasets(plan: DataFrame) -> DataFrame:
    """Fail when different schemas of a plan map to one dataset name."""
    clashes = (
        plan.groupBy("dataset")
        .agg(F.min("schema").alias("one"), F.max("schema").alias("other"))
        .where(F.col("one") != F.col("other"))
        .orderBy("dataset")
        .take(10)
    )
    if clashes:
        listed = "; ".join(f"{c['dataset']} <- {c['one']}, {c['other']}" for c in clashes)
        raise DatasetCollision(f"schemas share a dataset name: {listed}")
    return plan
