"""Row counts of many tables at once, the status report and the run summary."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylane import storage
from ferrylane.functions.naming import dataset_name
from ferrylane.operators.ledger import latest_audit
from ferrylane.session import local_frame

log = logging.getLogger(__name__)

LIVE_COUNTS = "schema_name string, table_name string, target_rows bigint"


def live_counts(spark: SparkSession, paths: Mapping[tuple[str, str], str | None]) -> DataFrame:
    """(schema_name, table_name, target_rows) of every readable table, counted in one scan.

    ``paths`` has each table's folder or file of Parquet. Counting reads no columns, only file
    footers, and files are told apart by where they lie. Tables given as None and tables that
    cannot be read are left out, so that joins show them as NULL; an empty table counts 0.
    """
    readable = {who: path for who, path in paths.items() if path is not None}
    if not readable:
        return spark.createDataFrame([], LIVE_COUNTS)
    names = [{"schema_name": s, "table_name": n, "path": p} for (s, n), p in readable.items()]
    found = _counts_by_path(spark, list(readable.values()))
    rows = [{**row, "target_rows": found[row["path"]]} for row in names if row["path"] in found]
    return local_frame(spark, rows, LIVE_COUNTS)


def _counts_by_path(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Rows below each path. If a scan fails, its halves are scanned apart, until what can't be read stands alone."""
    try:
        counted = counts_scan(spark, paths).collect()
        return {**dict.fromkeys(paths, 0), **{r["path"]: r["rows"] for r in counted}}
    except Exception as error:
        if len(paths) == 1:
            log.warning("%s could not be counted: %s", paths[0], error)
            return {}
        middle = len(paths) // 2
        return {**_counts_by_path(spark, paths[:middle]), **_counts_by_path(spark, paths[middle:])}


def counts_scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, rows) of Parquet folders or files, one scan for all of them; as many rows as paths."""
    file = F.regexp_replace(F.col("_metadata.file_path"), "^([A-Za-z0-9+.-]+):/+", "$1:/")
    # No file has this column, so nothing but footers is read.
    files = spark.read.schema("`(none)` tinyint").parquet(*paths).groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    places = files.select(F.explode(F.array("file", F.regexp_replace("file", "/[^/]*$", ""))).alias("place"), "rows")
    named = local_frame(spark, [{"place": storage.qualified(spark, p), "path": p} for p in dict.fromkeys(paths)], "place string, path string")
    return places.join(named, "place").groupBy("path").agg(F.sum("rows").alias("rows"))


def status_report(audit: DataFrame, counts: DataFrame, region_slug: str | None = None) -> DataFrame:
    """The last run of every table next to the rows its target holds now."""
    slug = F.lit(region_slug) if region_slug else None
    report = latest_audit(audit).join(counts, ["schema_name", "table_name"], "left")
    return report.select(
        "table_name",
        "schema_name",
        dataset_name(F.col("schema_name"), slug).alias("target_dataset"),
        "load_mode",
        F.col("outcome").alias("last_run_outcome"),
        F.col("rows_processed").alias("last_run_rows_processed"),
        F.col("started_at").alias("last_run_started_at"),
        F.col("finished_at").alias("last_run_finished_at"),
        F.col("error_message").alias("last_error_message"),
        F.col("target_rows").alias("total_rows_in_target"),
    )


def write_report(report: DataFrame, root: str) -> storage.VersionedTable:
    """Replace the report table and leave a copy in JSON under today's date."""
    spark = report.sparkSession
    table = storage.VersionedTable(spark, storage.join_path(root, "report"))
    table.replace(report.withColumn("report_generated_at", F.current_timestamp()).coalesce(1))
    today = spark.range(1).select(F.current_date().cast("string")).first()[0]
    snapshot = storage.join_path(root, "report_snapshots", f"report_date={today}")
    table.read().coalesce(1).write.mode("overwrite").json(snapshot)
    return table


def run_summary(results: DataFrame) -> DataFrame:
    """How many tables ended in each status; ``results`` itself says which."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))


def run_outcomes(results: DataFrame) -> DataFrame:
    """The names behind the summary: (status, table) with ``schema.name`` labels."""
    return results.select("status", F.concat_ws(".", "schema", "name").alias("table"))


def batch_totals(batches: DataFrame) -> DataFrame:
    """Batches and rows of a run, from its (batch_index, rows) frame."""
    return batches.agg(
        F.count(F.lit(1)).alias("batches_processed"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_processed")
    )
