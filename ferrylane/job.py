"""Copying one table, and copying an estate."""

from __future__ import annotations

import logging
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import BoundedSemaphore
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane import schemas as S
from ferrylane import storage
from ferrylane.functions import keys as K
from ferrylane.functions.naming import require_distinct_datasets
from ferrylane.functions.types import conform, struct_of
from ferrylane.operators import batching, landing, merge, report
from ferrylane.operators.batching import BATCH
from ferrylane.operators.ledger import EventBuffer, Ledger, decide, latest_checkpoint, utc_now
from ferrylane.operators.ranking import RANK, Ranked, number_rows, planned_bytes, rank_by_key, ranges_for
from ferrylane.plans.regions import RegionError, regions_to_run, union_of_regions
from ferrylane.session import local_frame
from ferrylane.sources.tables import TableSource
from ferrylane.storage import VersionedTable, join_path, path_segment

log = logging.getLogger(__name__)

LOAD = "load"
LAND_ONLY = "land"


@dataclass(frozen=True)
class Settings:
    """Where an estate lives, and how it is cut up."""

    root: str
    control: str = "migrated_data"
    batch_size: int = 1_000_000
    # Batches merged in one step; by default a table takes at most max_commits steps. Every batch
    # gets its own checkpoint row either way, so the ledger does not depend on either.
    batches_per_commit: int | None = None
    max_commits: int = 32
    cutoff: Any = None
    cutoff_column: str = "updatedAt"
    parallel_tables: int = 4

    def control_path(self, slug: str | None) -> str:
        return join_path(self.root, "control", f"{self.control}_{slug}" if slug else self.control)

    def target_path(self, table: Row | dict[str, Any]) -> str:
        return join_path(self.root, "data", table["dataset"], path_segment(table["name"]))

    def landing_path(self, table: Row) -> str:
        """One place per table: a run replaces the batches of the last, a resumed one those that it reads again."""
        return join_path(self.root, "landing", table["region_slug"], path_segment(table["schema"]), path_segment(table["name"]))

    def work_path(self, kind: str, table: Row) -> str:
        return join_path(self.root, kind, table["dataset"], path_segment(table["name"]))


@dataclass
class Progress:
    """How far a run has come; what the checkpoint and the audit row report."""

    first_batch: int = 0
    last_pk_json: str | None = None
    batches: int = 0
    rows: int = 0

    @property
    def last_batch(self) -> int:
        return self.first_batch + self.batches - 1


@dataclass
class TableRun:
    """One table, one run. ``run`` does the steps in order and records each."""

    spark: SparkSession
    settings: Settings
    table: Row
    source: TableSource
    run_id: str
    stage: str = LOAD
    force: bool = False
    progress: Progress = field(default_factory=Progress)
    #: Rows that an incremental run looked at, and the last of their keys.
    seen: tuple[int, str | None] = (0, None)
    #: The smallest and largest leading key among them.
    key_range: tuple[Any, Any] | None = None
    #: The batches of which the target may hold keys when they are merged; None where that was not looked up.
    meeting: set[int] | None = None

    def __post_init__(self) -> None:
        self.schema_name, self.table_name = self.table["schema"], self.table["name"]
        self.keys = list(self.table["primary_key"])
        self.types = struct_of(self.table["columns"])
        self.ledger = Ledger(self.spark, self.settings.control_path(self.table["region_slug"]))
        self.target = VersionedTable(self.spark, self.settings.target_path(self.table))
        self.landing = landing.LandingArea(self.spark, self.settings.landing_path(self.table))
        # An incremental run copies only what the target lacks. What a landing-only run lands does not depend on the target.
        self.is_incremental = self.table["load_mode"] == S.INCREMENTAL and self.stage == LOAD and not self.table["synthetic_key"]
        self.events = EventBuffer(self.run_id, self.schema_name, self.table_name)

    def run(self) -> dict[str, Any]:
        if not self.keys:
            raise ValueError(f"{self.table_name} has no key to merge on")
        if BATCH in map(str.lower, self.types.names):
            raise ValueError(f"{self.table_name} has a column {BATCH}, the name of the landing partitions")
        started_at = utc_now()
        decision = self._decide()
        try:
            if decision["action"] == "skip":
                # No audit row: the report keeps showing the run that loaded the data.
                reason = {"reason": "checkpoint COMPLETED", "completed_run_id": decision["checkpoint_run_id"],
                          "rows_in_target": decision["target_rows"]}
                self.events.end(S.STAGE_PIPELINE, S.SKIPPED, reason, rows_processed=0)
                return self._result(S.SKIPPED)
            self.progress = Progress(decision["next_batch_index"], decision["resume_after_json"])
            self.events.start(S.STAGE_PIPELINE)
            try:
                outcome = self._copy(decision["is_resumed"])
            except Exception as error:
                self._fail(error, started_at)
                raise
            self.events.end(S.STAGE_PIPELINE, outcome, rows_processed=self.progress.rows)
            self._audit(outcome, started_at)
            return self._result(outcome)
        finally:
            self.ledger.append_events(self.events)

    def _decide(self) -> Row:
        who = {"schema_name": self.schema_name, "table_name": self.table_name}
        plan = local_frame(
            self.spark, [{**who, "load_mode": self.table["load_mode"]}],
            "schema_name string, table_name string, load_mode string",
        )
        found = latest_checkpoint(self.ledger.checkpoints(self.schema_name, self.table_name)).collect()
        latest = local_frame(self.spark, [row.asDict() for row in found], S.CHECKPOINT)
        # Only a completed table can be skipped, so only then does its row count matter.
        completed = any(row["status"] == S.COMPLETED for row in found)
        rows = self.target.row_count() if completed and not self.force else None
        counts = local_frame(self.spark, [{**who, "target_rows": rows}], report.LIVE_COUNTS)
        return decide(plan, latest, counts, self.force).first()

    def _copy(self, resumed: bool) -> str:
        self.target.create(self.types)
        if self.stage == LAND_ONLY and not self.landing.holds(self.progress.first_batch):
            # The landed files are what such a run is for, so it starts over where earlier ones are gone.
            self.progress = Progress()
        ranked, total, scratch = self._extract(resumed)
        size, first = self.settings.batch_size, self.progress.first_batch
        batches = math.ceil(total / size)
        edges = self._kept("batches", batching.batch_edges(ranked, self.keys, total, size, first))
        self._land(batching.assign_batches(ranked, size, first) if total else None, edges)
        if scratch is not None:
            scratch.drop()
        if self.stage == LAND_ONLY:
            self._discard("batches")
            if self.table["synthetic_key"] and not resumed:
                self._frozen().drop()
            self.progress.batches, self.progress.rows = batches, total
            return S.SUCCESS_LANDED_ONLY
        if self.table["synthetic_key"] and not resumed:
            # From now on the target may hold these row numbers: whatever happens to this run, the next uses them again.
            self.ledger.commit(self.run_id, self.schema_name, self.table_name, first - 1, None, S.IN_PROGRESS)
        commits = self._commits(edges, batches, first)
        self.meeting = self._meeting_batches(edges) if len(commits) > 1 else None
        for commit in commits:
            self._merge(commit, edges)
        self._discard("batches")
        if self.is_incremental:
            # The rows that the target had already were looked at as well.
            self.progress.rows, self.progress.last_pk_json = self.seen[0], self.seen[1] or self.progress.last_pk_json
        self.ledger.commit(
            self.run_id, self.schema_name, self.table_name, self.progress.last_batch, self.progress.last_pk_json, S.COMPLETED
        )
        if self.table["synthetic_key"]:
            self._forget_row_numbers()
        else:
            self._index_target()
        return S.SUCCESS

    def _index_target(self) -> None:
        """Note the key ranges of the files written, so that later runs over few keys open few of them. Without it they open all."""
        try:
            self.target.index_files(self.keys[0])
        except Exception as error:
            log.warning("the files of %s were not indexed: %s", self.table_name, error)

    def _extract(self, resumed: bool) -> tuple[DataFrame, int, Ranked | None]:
        """Ranked rows in plan types, how many, and the scratch copy to drop once they have landed."""
        with self._stage(S.STAGE_EXTRACTION) as done:
            synthetic, ranged = self.table["synthetic_key"], False
            if synthetic:
                frame = self._row_numbers(resumed)
                if self.settings.cutoff is None:
                    # Row numbers are ranks already; those up to the checkpoint are behind us.
                    offset = self._last_row_number()
                    total = self._frozen().rows - offset
                    done(rows_processed=total)
                    return frame.withColumn(RANK, K.column(self.keys[0]) - offset).where(F.col(RANK) > 0), total, None
            else:
                frame = self.source.scan(self.table)
                ranged = self.source.is_ranged(self.table)
            rows = conform(self._wanted(frame), self.types)
            if self.source.is_remote(self.table) and not synthetic and (self.is_incremental or not ranged):
                # Range partitioning samples its input first, which would read the source twice.
                rows, ranged = self._kept("raw", rows), False
            if self.is_incremental:
                key = F.struct(*K.columns(self.keys))
                total, first, last = rows.agg(F.count(F.lit(1)), K.key_to_json(F.min(key)), K.key_to_json(F.max(key))).first()
                self.seen, self.key_range = (total, last), None
                if total:
                    low, high = (K.key_from_json(text, K.key_schema(self.types, self.keys)) for text in (first, last))
                    self.key_range = merge.key_bounds(low, high, self.keys)
                lacking = self._lacking(rows)
                rows, ranged = lacking, ranged and lacking is rows
            size = None if ranged else planned_bytes(rows)
            if size is None and not ranged:
                # Written first, then measured: how much a join gives is not known before.
                rows = self._kept("unranked", rows)
                size = planned_bytes(rows)
            scratch = rank_by_key(
                rows, self.keys, self.settings.work_path("ranked", self.table), already_ranged=ranged,
                ranges=None if ranged else ranges_for(size, cores=self.spark.sparkContext.defaultParallelism),
            )
            for kind in ("raw", "lacking", "unranked"):
                self._discard(kind)
            done(rows_processed=self.seen[0] if self.is_incremental else scratch.rows)
            return scratch.frame, scratch.rows, scratch

    def _lacking(self, rows: DataFrame) -> DataFrame:
        """The rows whose key the target does not have, written down; ``rows`` itself if it has none of them.

        Keys alone are compared, so a re-check of a large table for a few new rows moves keys and those rows.
        """
        target = merge.read_for(self.target, rows.schema, self.keys, self.key_range)
        found = merge.new_rows(
            rows, target, self.keys, unique=True, key_range=self.key_range, scratch=self.settings.work_path("keys", self.table))
        if found is not rows:
            found = self._kept("lacking", found)
        self._discard("keys")
        return found

    def _kept(self, kind: str, rows: DataFrame) -> DataFrame:
        """``rows`` written to this table's work folder and read back."""
        path = self.settings.work_path(kind, self.table)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _discard(self, kind: str) -> None:
        storage.delete(self.spark, self.settings.work_path(kind, self.table))

    def _wanted(self, frame: DataFrame) -> DataFrame:
        last = None
        if self.progress.last_pk_json is not None:
            last = K.key_from_json(self.progress.last_pk_json, K.key_schema(self.types, self.keys))
        wanted = K.scan_filter(frame.schema, self.keys, last, self.settings.cutoff, self.settings.cutoff_column)
        return frame if wanted is None else frame.where(wanted)

    def _frozen(self) -> Ranked:
        return Ranked(self.spark, self.settings.work_path("frozen", self.table))

    def _row_numbers(self, resumed: bool) -> DataFrame:
        """The table with its row numbers. An unfinished run's numbers are used again,
        since its checkpoint refers to them; otherwise the table is numbered afresh."""
        frozen = self._frozen()
        if not (resumed and frozen.is_complete()):
            if self.progress.last_pk_json is not None:
                raise RuntimeError(f"the frozen row numbers that {self.table_name} was being loaded by are gone")
            if self.stage == LOAD:
                # Numbers that an earlier run left in the target mean other rows.
                merge.drop_target_column(self.target, self.keys[0])
            number_rows(self.source.scan(self.table), frozen.path)
        return conform(frozen.frame.withColumnRenamed(RANK, self.keys[0]), self.types)

    def _last_row_number(self) -> int:
        if self.progress.last_pk_json is None:
            return 0
        last = K.key_from_json(self.progress.last_pk_json, K.key_schema(self.types, self.keys))
        return self.spark.range(1).select(last[self.keys[0]].alias("n")).first()["n"]

    def _land(self, batched: DataFrame | None, edges: DataFrame) -> None:
        """Land this run's batches (None: there are none) beside those of the run it resumes, and check the whole area."""
        first = self.progress.first_batch
        with self._stage(S.STAGE_UPLOAD) as done:
            kept = [c for c in self.types.names if self._is_landed(c)]
            self.landing.write(None if batched is None else batched.select(*K.columns(kept), BATCH), first)
            done(bytes_processed=storage.size_in_bytes(self.spark, self.landing.path), extra={"path": self.landing.path})
        with self._stage(S.STAGE_TRANSFER) as done:
            self.landing.verify(edges, self._landed_schema(), first, self.run_id)
            done()

    def _is_landed(self, column: str) -> bool:
        """Row numbers are of no use to readers of the landed files, so a run that ends there leaves them out,
        unless it adds to the batches of a load, which have them."""
        return not (self.stage == LAND_ONLY and self.table["synthetic_key"] and column == self.keys[0] and not self.progress.first_batch)

    def _landed_schema(self) -> T.StructType:
        return T.StructType([f for f in self.types.fields if self._is_landed(f.name)])

    def _landed(self, commit: Row) -> DataFrame:
        """The batches of one group; a run then lists every folder once, not once per group."""
        group = range(commit["first_batch"], commit["last_batch"] + 1)
        return landing.read_landed(self.spark, self.landing.path, self._landed_schema(), group)

    def _commits(self, edges: DataFrame, batches: int, first: int) -> list[Row]:
        """The groups to merge, at most as many as the run has commits."""
        per_commit = self.settings.batches_per_commit or max(1, math.ceil(batches / self.settings.max_commits))
        return sorted(batching.commit_groups(edges, per_commit, first).collect(), key=lambda group: group["commit"])

    def _meeting_batches(self, edges: DataFrame) -> set[int]:
        """The batches whose keys the target may hold already, or will by the time they are merged.

        Nobody else adds to the target meanwhile, and batches are runs of sorted keys: so one look at the target's keys in the
        range of all batches, and at keys that open a batch and closed the last, tells which of them need none.
        """
        lead, schema = self.keys[0], K.key_schema(self.types, self.keys[:1])
        opens, closes = F.col("first_key").getField(lead), F.col("last_key").getField(lead)
        bounds = [K.key_to_json(F.struct(bound.alias(lead))) for bound in (F.min(F.coalesce(opens, closes)), F.max(closes))]
        key_range = tuple(K.key_from_json(text, schema)[lead] for text in edges.agg(*bounds).first())
        known = merge.known_keys(merge.read_for(self.target, self.types, self.keys, key_range), self.keys, key_range)
        held = known.agg(F.min(K.column(lead)).alias("low"), F.max(K.column(lead)).alias("high"))
        before = Window.orderBy(BATCH)
        again = F.col("first_key").eqNullSafe(F.lag("last_key").over(before))
        marked = edges.withColumn("again", again).crossJoin(F.broadcast(held))
        meets = F.col("again") | ((closes >= F.col("low")) & (opens <= F.col("high")))
        return {row[BATCH] for row in marked.where(meets).select(BATCH).collect()}

    def _merge(self, commit: Row, edges: DataFrame) -> None:
        """Merge one group, then commit its batches: a crash in between repeats a merge that adds nothing."""
        with self._stage(S.STAGE_LOAD, batch_index=commit["last_batch"]) as done:
            in_group = F.col(BATCH).between(commit["first_batch"], commit["last_batch"])
            staged = self._landed(commit).select(*K.columns(self.types.names))
            options: dict[str, Any] = {"all_new": True}
            if self.meeting is None or not self.meeting.isdisjoint(range(commit["first_batch"], commit["last_batch"] + 1)):
                keys = K.key_schema(self.types, self.keys)
                first, last = (K.key_from_json(commit[c], keys) for c in ("first_pk_json", "last_pk_json"))
                options = {"unique": True, "key_range": merge.key_bounds(first, last, self.keys)}
            inserted = merge.merge_into(self.target, staged, self.keys, **options)
            done(rows_processed=commit["rows"], extra={"rows_inserted": inserted})
        if commit["batches"] == 1:
            one = {BATCH: commit["last_batch"], "last_pk_json": commit["last_pk_json"]}
            merged = local_frame(self.spark, [one], f"{BATCH} bigint, last_pk_json string")
        else:
            merged = edges.where(in_group).select(BATCH, K.key_to_json("last_key").alias("last_pk_json"))
        self.ledger.commit_batches(self.run_id, self.schema_name, self.table_name, merged, S.IN_PROGRESS)
        self.progress.batches += commit["batches"]
        self.progress.rows += commit["rows"]
        self.progress.last_pk_json = commit["last_pk_json"]

    def _forget_row_numbers(self) -> None:
        """Drop the numbers from the target, then the frozen copy. A failure here loses no data:
        numbers that stay in the target go when the table is numbered afresh."""
        for step in (lambda: merge.drop_target_column(self.target, self.keys[0]), self._frozen().drop):
            try:
                step()
            except Exception as error:
                log.warning("row numbers of %s were not cleaned up: %s", self.table_name, error)

    def _fail(self, error: Exception, started_at: Any) -> None:
        if self.stage == LOAD:
            self.ledger.commit(
                self.run_id, self.schema_name, self.table_name,
                self.progress.last_batch, self.progress.last_pk_json, S.FAILED,
            )
        self.events.end(S.STAGE_PIPELINE, S.FAILED, error_message=str(error))
        self._audit(S.FAILED, started_at, str(error))

    def _audit(self, outcome: str, started_at: Any, error_message: str | None = None) -> None:
        self.ledger.append_audit(
            run_id=self.run_id, table_name=self.table_name, schema_name=self.schema_name,
            load_mode=self.table["load_mode"], outcome=outcome,
            batches_processed=self.progress.batches, rows_processed=self.progress.rows,
            resumed_from_batch=self.progress.first_batch,
            started_at=started_at, finished_at=utc_now(), error_message=error_message,
        )

    def _result(self, status: str) -> dict[str, Any]:
        return {"schema": self.schema_name, "name": self.table_name, "status": status,
                "batches_processed": self.progress.batches, "rows_processed": self.progress.rows}

    def _stage(self, name: str, **values: Any) -> "_Stage":
        return _Stage(self.events, name, values)


class _Stage:
    """Writes a START event, then SUCCESS with what the step reported, or FAILED."""

    def __init__(self, events: EventBuffer, name: str, values: dict[str, Any]):
        self.events, self.name, self.values = events, name, values

    def __enter__(self) -> Callable[..., None]:
        self.events.start(self.name)
        return self.values.update

    def __exit__(self, kind: Any, error: BaseException | None, trace: Any) -> None:
        if error is None:
            self.events.end(self.name, **self.values)
        else:
            self.events.end(self.name, S.FAILED, error_message=str(error), batch_index=self.values.get("batch_index"))


def run_table(
    spark: SparkSession,
    settings: Settings,
    table: Row,
    source: TableSource,
    run_id: str | None = None,
    stage: str = LOAD,
    force: bool = False,
) -> dict[str, Any]:
    """Copy one planned table and return its status, batches and rows.

    With ``stage="land"`` the run ends once the batches have landed: nothing is
    merged and no checkpoint is written.
    """
    return TableRun(spark, settings, table, source, run_id or str(uuid.uuid4()), stage, force).run()


#: What the reports need of a table.
_REPORTED = ("region", "region_slug", "schema", "name", "dataset")


def run_estate(
    spark: SparkSession,
    settings: Settings,
    plan: DataFrame,
    source: TableSource | Mapping[str | None, TableSource],
    load_mode: str | None = None,
    stage: str = LOAD,
    force: bool = False,
) -> tuple[DataFrame, list[VersionedTable]]:
    """Copy every planned table, several at a time, then write each region's report.

    ``source`` is one source, or one for each region; a region without one fails, with all its
    tables. A table that fails does not stop the others. Returns one row per table
    (region, schema, name, status, batches, rows, error) and the reports. The plan is read a
    partition at a time, no faster than tables are copied: what stays of a table is its name and outcome.
    """
    wanted = plan if load_mode is None else plan.where(F.col("load_mode") == load_mode)
    require_distinct_datasets(wanted)
    batch = str(uuid.uuid4())

    def copy(table: Row) -> dict[str, Any]:
        who = {name: table[name] for name in ("region", "schema", "name")}
        # Tables get a pool each, so that under a FAIR scheduler a large one does not hold up the rest.
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", ".".join(p or "" for p in who.values()))
        try:
            run_id = f"{batch}:{table['schema']}.{table['name']}"
            if isinstance(source, Mapping) and table["region"] not in source:
                raise RegionError(f"no source for region {table['region']!r}")
            own = source[table["region"]] if isinstance(source, Mapping) else source
            return {**who, **run_table(spark, settings, table, own, run_id, stage, force)}
        except Exception as error:
            log.warning("table %s.%s failed: %s", table["schema"], table["name"], error)
            return {**who, "status": S.FAILED, "error_message": str(error)}

    copied: list[tuple[dict[str, Any], Future]] = []
    waiting = BoundedSemaphore(2 * settings.parallel_tables)
    with ThreadPoolExecutor(max_workers=settings.parallel_tables) as pool:
        for table in wanted.orderBy("region", "schema", "name").toLocalIterator():
            waiting.acquire()
            future = pool.submit(inheritable_thread_target(spark)(copy), table)
            future.add_done_callback(lambda _: waiting.release())
            copied.append(({name: table[name] for name in _REPORTED}, future))
    tables, results = [who for who, _ in copied], [future.result() for _, future in copied]
    columns = ("region string, schema string, name string, status string, "
               "batches_processed bigint, rows_processed bigint, error_message string")
    return local_frame(spark, results, columns), write_reports(spark, settings, tables)


def run_regions(
    spark: SparkSession,
    settings: Settings,
    regions: DataFrame,
    requested: str | None,
    connect: Callable[[Row], tuple[DataFrame, TableSource]],
    load_mode: str | None = None,
    **options: Any,
) -> tuple[DataFrame, list[VersionedTable], dict[str, str]]:
    """Plan and copy the requested regions, each from its own source.

    ``connect`` gives a region's plan and source. A region that cannot be reached is named in the
    third result and does not stop the others; if none can be, the call fails.
    """
    wanted = {row["region"]: row for row in regions_to_run(regions, requested).collect()}
    sources: dict[str | None, TableSource] = {}

    def plan_of(region: str | None) -> DataFrame:
        plan, source = connect(wanted[region])
        sources[region] = source
        return plan

    plan, errors = union_of_regions({region: lambda region=region: plan_of(region) for region in wanted}, load_mode)
    results, reports = run_estate(spark, settings, plan, sources, **options)
    return results, reports, errors


def write_reports(spark: SparkSession, settings: Settings, tables: Sequence[Row | dict[str, Any]]) -> list[VersionedTable]:
    """One status report per region. A report that fails only warns."""
    written = []
    for slug in sorted({t["region_slug"] for t in tables}, key=str):
        own = [t for t in tables if t["region_slug"] == slug]
        try:
            paths = {(t["schema"], t["name"]): VersionedTable(spark, settings.target_path(t)).current_path() for t in own}
            ledger = Ledger(spark, settings.control_path(slug))
            rows = report.status_report(ledger.audit(), report.live_counts(spark, paths), slug)
            written.append(report.write_report(rows, ledger.root))
            for name in ("checkpoint", "audit", "log", "raw_events"):
                ledger.compact(name)
        except Exception as error:
            log.warning("report of region %s failed: %s", slug, error)
    return written
