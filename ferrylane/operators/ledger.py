"""Checkpoints, audit rows and stage events, and what they say about the next run."""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrylane import schemas as S
from ferrylane import storage
from ferrylane.operators.batching import BATCH, with_resume_point
from ferrylane.session import column_names, local_frame

log = logging.getLogger(__name__)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group. Spark trims every input partition to one row per
    group before the shuffle, so a group with a long history is no larger than others."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") == 1).drop("__rn")


def latest_audit(audit: DataFrame) -> DataFrame:
    """One row per (schema_name, table_name): its last finished run."""
    order = [F.desc("finished_at"), F.desc("started_at"), F.desc("run_id")]
    return latest_per(audit, ["schema_name", "table_name"], order)


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """One row per (schema_name, table_name): its last checkpoint.

    Of rows with equal times the higher batch wins, then the more final status.
    """
    finality = (
        F.when(F.col("status") == S.COMPLETED, 2).when(F.col("status") == S.FAILED, 1).otherwise(0)
    )
    order = [F.desc("updated_at"), F.desc("last_batch_index"), F.desc(finality)]
    return latest_per(checkpoints, ["schema_name", "table_name"], order)


def audit_outcome(outcome: Column, resumed_from_batch: Column) -> Column:
    resumed = (outcome == S.SUCCESS) & (resumed_from_batch > 0)
    return F.when(resumed, S.RESUMED_SUCCESS).otherwise(outcome)


def decide(plan: DataFrame, checkpoints: DataFrame, counts: DataFrame, force: bool = False) -> DataFrame:
    """What to do with each planned table: ``skip``, ``resume`` or ``fresh``.

    ``plan`` has schema_name, table_name and load_mode; ``checkpoints`` is the
    latest one per table; ``counts`` has schema_name, table_name and target_rows.
    A completed full load is skipped while its target holds rows; an unreadable
    target counts as empty. Incremental tables are never skipped.
    """
    table = ["schema_name", "table_name"]
    joined = plan.join(with_resume_point(checkpoints), table, "left").join(counts, table, "left")
    rows = F.coalesce("target_rows", F.lit(0))
    skip = (
        F.lit(not force)
        & (F.col("load_mode") == S.FULL)
        & F.coalesce(F.col("status") == S.COMPLETED, F.lit(False))
        & (rows > 0)
    )
    resumed = F.coalesce("is_resumed", F.lit(False))
    return joined.select(
        *[F.col(c) for c in plan.columns],
        F.when(skip, "skip").when(resumed, "resume").otherwise("fresh").alias("action"),
        "resume_after_json",
        F.coalesce("next_batch_index", F.lit(0)).cast("bigint").alias("next_batch_index"),
        resumed.alias("is_resumed"),
        rows.alias("target_rows"),
        F.col("run_id").alias("checkpoint_run_id"),
    )


def log_by_stage(events: DataFrame) -> DataFrame:
    return events.groupBy("stage", "status").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("rows_processed").alias("rows_processed"),
        F.sum("bytes_processed").alias("bytes_processed"),
    )


def with_event_date(events: DataFrame) -> DataFrame:
    """START rows have only a start time and END rows only an end time; date them by either."""
    return events.withColumn("event_date", F.to_date(F.coalesce("started_at", "finished_at")))


class EventBuffer:
    """Stage events of one run, kept until they are written together."""

    def __init__(self, run_id: str, schema_name: str, table_name: str):
        self._who = {"run_id": run_id, "schema_name": schema_name, "table_name": table_name}
        self.rows: list[dict[str, Any]] = []

    def start(self, stage: str) -> None:
        self._add(stage, S.STARTED, started_at=utc_now())

    def end(self, stage: str, status: str = S.SUCCESS, extra: Mapping[str, Any] | None = None, **values: Any) -> None:
        self._add(stage, status, finished_at=utc_now(), extra_json=json.dumps(dict(extra or {}), default=str), **values)

    def _add(self, stage: str, status: str, **values: Any) -> None:
        empty = dict.fromkeys(
            ["batch_index", "rows_processed", "bytes_processed", "started_at", "finished_at", "error_message"]
        )
        self.rows.append({**self._who, "stage": stage, "status": status, **empty, "extra_json": "{}", **values})


#: How many small files a control table may have before they are folded, and how many folds before those are put together.
LOOSE_FILES, MOST_PARTS = 500, 8
#: Each control table's columns, its file format, and what its rows are dated by.
_TABLES = {
    "checkpoint": (S.CHECKPOINT, "parquet", "updated_at"),
    "audit": (S.AUDIT, "parquet", "coalesce(started_at, finished_at)"),
    "log": (S.LOG, "parquet", "coalesce(started_at, finished_at)"),
    "raw_events": (S.LOG, "json", "coalesce(started_at, finished_at)"),
}


class Ledger:
    """The control tables of one region, append-only under ``root``.

    Every run appends to a folder of its own under its table's: Spark appends to one
    folder must not overlap, and a table finds its history without reading others'.

    ``compact`` folds those small files into parts by day, sorted by table. A numbered pointer file says which parts there
    are and which small files they hold; readers take the newest pointer and leave those files out. So a compaction that
    dies at any step changes nothing or is done, and since the files that one fold took go with the next, a reader that began
    before it finds them still. One compaction at a time, please.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, name: str) -> str:
        return storage.join_path(self.root, name)

    def _table_path(self, name: str, schema_name: str | None, table_name: str) -> str:
        return storage.join_path(self.path(name), f"of={storage.path_segment(f'{schema_name}.{table_name}')}")

    def _writer_path(self, name: str, row: Mapping[str, Any]) -> str:
        table = self._table_path(name, row["schema_name"], row["table_name"])
        return storage.join_path(table, f"run={storage.path_segment(row['run_id'])}")

    def _pointers(self, name: str) -> list[str]:
        return sorted(f for f in storage.files(self.spark, storage.join_path(self.path(name), "_parts")) if f.endswith(".json"))

    def _pointer(self, name: str) -> dict[str, list[str]]:
        """The parts of a control table, and the small files that they hold already."""
        found = self._pointers(name)
        if not found:
            return {"parts": [], "folded": []}
        return json.loads(storage.read_text(self.spark, storage.join_path(self.path(name), "_parts", found[-1])))

    def _small_rows(self, name: str, path: str, folded: Sequence[str]) -> DataFrame | None:
        schema, kind, _ = _TABLES[name]
        if not storage.exists(self.spark, path):
            return None
        rows = self.spark.read.schema(schema).format(kind).load(path)
        if folded:
            file = F.regexp_replace(F.col("_metadata.file_path"), "^([A-Za-z0-9+.-]+):/+", "$1:/")
            known = local_frame(self.spark, [{"folded_file": storage.qualified(self.spark, f)} for f in folded], "folded_file string")
            rows = rows.withColumn("in_file", file).join(F.broadcast(known), F.col("in_file") == F.col("folded_file"), "left_anti")
        return rows.select(*column_names(schema))

    def _part_rows(self, name: str, parts: Sequence[str]) -> DataFrame:
        """The rows of parts, with the column ``day`` that they are stored by."""
        schema, kind, _ = _TABLES[name]
        below = [storage.join_path(self.path(name), "_parts", part) for part in parts]
        return reduce(DataFrame.unionByName, [self.spark.read.schema(f"{schema}, day date").format(kind).load(path) for path in below])

    def read(self, name: str, schema_name: str | None = None, table_name: str | None = None, since: dt.date | None = None) -> DataFrame:
        """A control table: all of it, one table's rows, or those dated ``since`` or later. Parts prune by both."""
        schema, _, dated = _TABLES[name]
        pointer = self._pointer(name)
        path = self.path(name) if table_name is None else self._table_path(name, schema_name, table_name)
        small = self._small_rows(name, path, pointer["folded"])
        parts = self._part_rows(name, pointer["parts"]) if pointer["parts"] else None
        if since is not None:
            small = None if small is None else small.where(F.to_date(F.expr(dated)) >= F.lit(since))
            parts = None if parts is None else parts.where(F.col("day") >= F.lit(since))
        if table_name is not None and parts is not None:
            parts = parts.where(F.col("schema_name").eqNullSafe(F.lit(schema_name)) & (F.col("table_name") == table_name))
        there = [rows.select(*column_names(schema)) for rows in (small, parts) if rows is not None]
        return reduce(DataFrame.unionByName, there) if there else self.spark.createDataFrame([], schema)

    def checkpoints(self, schema_name: str | None = None, table_name: str | None = None) -> DataFrame:
        """Every table's checkpoints, or one table's."""
        return self.read("checkpoint", schema_name, table_name)

    def audit(self) -> DataFrame:
        return self.read("audit")

    def events(self) -> DataFrame:
        return self.read("log")

    def raw_events(self) -> DataFrame:
        """The events as they were written in JSON."""
        return self.read("raw_events")

    def compact(self, name: str, loose_files: int = LOOSE_FILES) -> bool:
        """Fold a control table's small files once it has ``loose_files`` of them; False when it does not.

        A fold writes those rows only; every ``MOST_PARTS`` folds the parts become one.
        """
        schema, kind, dated = _TABLES[name]
        root, pointer = self.path(name), self._pointer(name)
        below = storage.join_path(root, "_parts")
        # What the last fold took has had readers of the pointer before it; they are gone by now.
        storage.delete_files(self.spark, pointer["folded"], root)
        loose = storage.files_below(self.spark, root)
        if len(loose) < max(1, loose_files):
            return False
        listed = self.spark.read.schema(f"{schema}, of string, run string").option("basePath", root).format(kind).load(loose)
        day = F.coalesce(F.to_date(F.expr(dated)), F.to_date(F.lit("1970-01-01"))).alias("day")
        rows, parts = listed.select(*column_names(schema), day), list(pointer["parts"])
        if len(parts) >= MOST_PARTS:
            rows, parts = rows.unionByName(self._part_rows(name, parts).select(*column_names(schema), "day")), []
        number = 1 + max((int(f.split(".")[0]) for f in self._pointers(name)), default=0)
        part = f"{number:08d}"
        dealt = rows.repartition("day").sortWithinPartitions("day", "schema_name", "table_name")
        dealt.write.mode("overwrite").partitionBy("day").format(kind).save(storage.join_path(below, part))
        folded = {"parts": [*parts, part], "folded": loose}
        storage.write_text(self.spark, storage.join_path(below, f"{part}.json"), json.dumps(folded))
        self._drop_unused(name, below)
        return True

    def _drop_unused(self, name: str, below: str) -> None:
        """Keep what the last two pointers name: a reader may still go by the last but one."""
        pointers = self._pointers(name)
        for old in pointers[:-2]:
            storage.delete(self.spark, storage.join_path(below, old))
        used = {p for f in pointers[-2:] for p in json.loads(storage.read_text(self.spark, storage.join_path(below, f)))["parts"]}
        for folder in storage.folders(self.spark, below):
            if folder not in used:
                storage.delete(self.spark, storage.join_path(below, folder))

    def commit(
        self, run_id: str, schema_name: str, table_name: str, batch_index: int, last_pk_json: str | None, status: str
    ) -> None:
        """Append a checkpoint. A failure here is an error: the run could not be resumed."""
        row = {
            "table_name": table_name,
            "schema_name": schema_name,
            "last_pk_json": last_pk_json,
            "last_batch_index": batch_index,
            "status": status,
            "run_id": run_id,
            "updated_at": utc_now(),
        }
        local_frame(self.spark, [row], S.CHECKPOINT).write.mode("append").parquet(self._writer_path("checkpoint", row))

    def commit_batches(self, run_id: str, schema_name: str, table_name: str, batches: DataFrame, status: str) -> None:
        """Append a checkpoint for each row of ``batches`` (batch_index, last_pk_json), all at once.

        Rows that lie in the driver are written there, without a job.
        """
        who = {"table_name": table_name, "schema_name": schema_name, "run_id": run_id}
        if batches.isLocal():
            done = {**who, "status": status, "updated_at": utc_now()}
            rows = [{**done, "last_batch_index": row[BATCH], "last_pk_json": row["last_pk_json"]} for row in batches.collect()]
            storage.append_rows(self.spark, self._writer_path("checkpoint", who), rows, S.CHECKPOINT)
            return
        rows = batches.select(
            F.lit(table_name).alias("table_name"), F.lit(schema_name).cast("string").alias("schema_name"), "last_pk_json",
            F.col(BATCH).cast("bigint").alias("last_batch_index"), F.lit(status).alias("status"), F.lit(run_id).alias("run_id"),
            F.lit(utc_now()).alias("updated_at"))
        rows.coalesce(1).write.mode("append").parquet(self._writer_path("checkpoint", who))

    def append_audit(self, **row: Any) -> None:
        """Append an audit row, dated by its start. A failure only warns."""
        try:
            frame = local_frame(self.spark, [row], S.AUDIT)
            outcome = audit_outcome(F.col("outcome"), F.col("resumed_from_batch"))
            dated = frame.withColumn("outcome", outcome).withColumn("run_date", F.to_date("started_at"))
            dated.write.mode("append").partitionBy("run_date").parquet(self._writer_path("audit", row))
        except Exception as error:
            log.warning("audit row of %s was not written: %s", row.get("table_name"), error)

    def append_events(self, events: EventBuffer) -> None:
        """Append a run's events to the log table and as JSON. A failure only warns."""
        if not events.rows:
            return
        try:
            frame, first = local_frame(self.spark, events.rows, S.LOG), events.rows[0]
            dated = with_event_date(frame)
            dated.write.mode("append").partitionBy("event_date").parquet(self._writer_path("log", first))
            write_raw_events(frame, self._writer_path("raw_events", first))
        except Exception as error:
            log.warning("events were not written: %s", error)


def write_raw_events(events: DataFrame, path: str) -> None:
    """One JSON object per event, under its run."""
    events.write.mode("append").partitionBy("run_id").json(path)
