"""Ledgers, decisions and reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ferrylane import schemas as S
from ferrylane import storage
from ferrylane.operators import ledger as L
from ferrylane.operators import report
from ferrylane.session import local_frame, scratch_path
from ferrylane.storage import VersionedTable


def at(minute):
    return dt.datetime(2026, 1, 1, 12, minute, tzinfo=dt.timezone.utc)


@pytest.fixture
def book(spark):
    return L.Ledger(spark, scratch_path(spark, "control"))


CASES = [("COMPLETED", "full", False, 100, "skip"), ("COMPLETED", "full", True, 100, "fresh"),
         ("COMPLETED", "incremental", False, 100, "fresh"), ("COMPLETED", "full", False, 0, "fresh"),
         ("COMPLETED", "full", False, None, "fresh"), ("FAILED", "full", False, 100, "resume"),
         ("IN_PROGRESS", "full", True, 100, "resume"), (None, "full", False, 100, "fresh")]


@pytest.mark.parametrize("status, mode, force, rows, action", CASES)
def test_decision(spark, status, mode, force, rows, action):
    who = {"schema_name": "dbo", "table_name": "t"}
    plan = local_frame(spark, [{**who, "load_mode": mode}], "schema_name string, table_name string, load_mode string")
    found = [{**who, "status": status, "last_batch_index": 3, "last_pk_json": '{"id":4}', "run_id": "r"}] if status else []
    counts = local_frame(spark, [{**who, "target_rows": rows}], report.LIVE_COUNTS)
    row = L.decide(plan, local_frame(spark, found, S.CHECKPOINT), counts, force).first()
    assert row["action"] == action
    assert row["next_batch_index"] == (4 if action == "resume" else 0)
    assert row["resume_after_json"] == ('{"id":4}' if action == "resume" else None)


def test_latest_checkpoint_keeps_schemas_apart_and_breaks_ties(spark):
    rows = [("t", "dbo", 1, "IN_PROGRESS", at(1)), ("t", "dbo", 2, "IN_PROGRESS", at(2)), ("t", "dbo", 2, "COMPLETED", at(2)),
            ("t", "sales", 7, "FAILED", at(0)), ("t", None, 9, "FAILED", at(3))]
    names = ["table_name", "schema_name", "last_batch_index", "status", "updated_at"]
    frame = local_frame(spark, [dict(zip(names, r)) for r in rows], S.CHECKPOINT)
    got = {r["schema_name"]: (r["last_batch_index"], r["status"]) for r in L.latest_checkpoint(frame).collect()}
    assert got == {"dbo": (2, "COMPLETED"), "sales": (7, "FAILED"), None: (9, "FAILED")}


def test_latest_row_is_picked_before_the_shuffle(spark, read, plan_of):
    latest = L.latest_per(read("events"), ["user_id"], [F.desc("ts")])
    plan = plan_of(latest)
    assert plan.index("WindowGroupLimit") and "Partial" in plan.split("WindowGroupLimit")[-1]


def test_checkpoints_append_and_are_read_back(spark, book):
    assert book.checkpoints().isEmpty()
    book.commit("r:1", "dbo", "t 1", 0, '{"id":5}', S.IN_PROGRESS)
    book.commit("r:1", "dbo", "t 1", 1, '{"id":9}', S.COMPLETED)
    book.commit("r:2", "dbo", "u", -1, None, S.FAILED)
    got = sorted((r["table_name"], r["last_batch_index"], r["last_pk_json"], r["status"]) for r in book.checkpoints().collect())
    assert got == [("t 1", 0, '{"id":5}', "IN_PROGRESS"), ("t 1", 1, '{"id":9}', "COMPLETED"), ("u", -1, None, "FAILED")]


def test_a_checkpoint_that_cannot_be_written_is_fatal_but_audit_and_events_are_not(spark, tmp_path):
    (tmp_path / "control").write_text("a file where the folder should be")
    book = L.Ledger(spark, str(tmp_path / "control"))
    with pytest.raises(Exception):
        book.commit("r", "dbo", "t", 0, None, S.FAILED)
    book.append_audit(run_id="r", table_name="t", schema_name="dbo", outcome=S.FAILED, resumed_from_batch=0, started_at=at(0))
    events = L.EventBuffer("r", "dbo", "t")
    events.start(S.STAGE_LOAD)
    book.append_events(events)


def test_audit_outcome_and_dating(spark, book):
    for outcome, first in [("SUCCESS", 0), ("SUCCESS", 3), ("FAILED", 3)]:
        book.append_audit(run_id=f"{outcome}{first}", table_name="t", schema_name="dbo", load_mode="full", outcome=outcome,
                          batches_processed=1, rows_processed=2, resumed_from_batch=first, started_at=at(0), finished_at=at(1))
    got = {r["run_id"]: r["outcome"] for r in book.audit().collect()}
    assert got == {"SUCCESS0": "SUCCESS", "SUCCESS3": "RESUMED_SUCCESS", "FAILED3": "FAILED"}
    assert "run_date=2026-01-01" in book.audit().inputFiles()[0]


def test_events_pair_up_and_are_kept_twice(spark, book):
    events = L.EventBuffer("r:1", "dbo", "t")
    events.start(S.STAGE_LOAD)
    events.end(S.STAGE_LOAD, rows_processed=5, batch_index=1, extra={"rows_inserted": 4})
    book.append_events(events)
    start, end = book.events().orderBy(F.col("status") != "STARTED").collect()
    assert (start["started_at"] is not None, start["finished_at"]) == (True, None)
    assert (end["started_at"], end["finished_at"] is not None) == (None, True)
    assert end["extra_json"] == '{"rows_inserted": 4}' and end["rows_processed"] == 5
    raw = spark.read.json(book.path("raw_events"))
    assert raw.count() == 2 and [r[0] for r in raw.select("run_id").distinct().collect()] == ["r:1"]


def filled(book, runs, first=0):
    for i in range(first, first + runs):
        table = f"t {i % 3}"
        book.commit(f"r:{i}", "dbo" if i % 2 else None, table, i, f'{{"id":{i}}}', S.COMPLETED)
        book.append_audit(run_id=f"r:{i}", table_name=table, schema_name="dbo", load_mode="full", outcome="SUCCESS", batches_processed=1,
                          rows_processed=i, resumed_from_batch=0, started_at=at(i), finished_at=at(i + 1))


def contents(book):
    return {name: sorted(map(repr, book.read(name).collect())) for name in ("checkpoint", "audit", "log", "raw_events")}


def small_files(book, name):
    return storage.files_below(book.spark, book.path(name))


def test_compaction_folds_small_files_and_loses_no_row(spark, book):
    events = L.EventBuffer("r:1", "dbo", "t 1")
    events.start(S.STAGE_LOAD)
    events.end(S.STAGE_LOAD, rows_processed=5)
    book.append_events(events)
    filled(book, 4)
    before = contents(book)
    assert not book.compact("audit", loose_files=50)
    assert all(book.compact(name, loose_files=1) for name in before)
    assert contents(book) == before and sum(map(len, before.values())) == 4 + 4 + 2 + 2
    filled(book, 2, first=4)
    after = contents(book)
    assert len(after["audit"]) == len(after["checkpoint"]) == 6
    assert book.compact("audit", loose_files=2) and contents(book) == after
    assert len(small_files(book, "audit")) == 2  # those of the fold before are gone, those of this one go with the next
    assert not book.compact("audit", loose_files=1) and small_files(book, "audit") == [] and contents(book) == after


def test_compacted_rows_are_found_by_table_and_by_day(spark, book, plan_of):
    filled(book, 4)
    book.compact("checkpoint", 1)
    filled(book, 1, first=7)
    assert [r["last_batch_index"] for r in book.checkpoints("dbo", "t 1").orderBy("last_batch_index").collect()] == [1, 7]
    assert [r["last_batch_index"] for r in book.checkpoints(None, "t 2").collect()] == [2]
    text = plan_of(book.read("checkpoint", "dbo", "t 1", since=dt.date(2026, 1, 1)))
    assert "PartitionFilters: [isnotnull(day" in text and "EqualTo(table_name,t 1)" in text
    assert book.read("checkpoint", since=dt.date(2100, 1, 1)).isEmpty()


def test_many_runs_leave_few_files(spark, book, monkeypatch):
    monkeypatch.setattr(L, "MOST_PARTS", 2)
    for round_ in range(5):
        filled(book, 3, first=3 * round_)
        assert book.compact("audit", loose_files=3)
    assert book.audit().count() == 15 and len(small_files(book, "audit")) == 3
    parts = storage.folders(spark, f"{book.path('audit')}/_parts")
    assert len(parts) <= 4 and len(book._pointers("audit")) == 2


@pytest.mark.parametrize("step", ["write_text", "delete_files"])
def test_a_compaction_that_dies_changes_nothing(spark, book, monkeypatch, step):
    filled(book, 2)
    book.compact("audit", 1)
    filled(book, 2, first=2)
    before = contents(book)
    monkeypatch.setattr(storage, step, lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        book.compact("audit", 1)
    assert contents(book) == before
    monkeypatch.undo()
    assert book.compact("audit", 1) and contents(book) == before


def stored(spark, rows, name="table"):
    path = f"{scratch_path(spark, 'counted')}/{name}"
    spark.range(rows).repartition(2).write.parquet(path)
    return path


def test_a_table_that_cannot_be_read_is_left_out(spark, tmp_path):
    paths = {("dbo", f"t{i}"): stored(spark, i) for i in range(5)}
    (tmp_path / "part-0.parquet").write_bytes(b"not a table")
    paths["dbo", "broken"] = str(tmp_path)
    got = {r[1]: r[2] for r in report.live_counts(spark, paths).collect()}
    assert got == {f"t{i}": i for i in range(5)}


def test_many_tables_are_one_scan(spark, plan_of):
    path = stored(spark, 1)
    paths = [f"{path}/{f}" for f in __import__("os").listdir(path) if f.endswith(".parquet")] * 1000
    assert plan_of(report.counts_scan(spark, paths)).split("== Physical Plan ==")[1].count("FileScan") == 1


def test_live_counts_of_present_empty_and_missing_tables(spark):
    tables = {("dbo", "a"): stored(spark, 7), ("dbo", "b"): stored(spark, 0), ("s", "a"): stored(spark, 2, "a name"), ("dbo", "gone"): None}
    got = {(r[0], r[1]): r[2] for r in report.live_counts(spark, tables).collect()}
    assert got == {("dbo", "a"): 7, ("dbo", "b"): 0, ("s", "a"): 2}
    assert report.live_counts(spark, {("dbo", "gone"): None}).isEmpty()


def test_report_is_replaced_each_time(spark, book):
    root = scratch_path(spark, "control")
    for rows in (10, 30):
        audit = local_frame(spark, [
            {"run_id": "a", "table_name": "t", "schema_name": "my-schema", "load_mode": "full", "outcome": "FAILED",
             "rows_processed": 1, "started_at": at(0), "finished_at": at(1), "error_message": "x"},
            {"run_id": "b", "table_name": "t", "schema_name": "my-schema", "load_mode": "full", "outcome": "SUCCESS",
             "rows_processed": rows, "started_at": at(2), "finished_at": at(3)},
            {"run_id": "c", "table_name": "never", "schema_name": "dbo", "outcome": "FAILED", "finished_at": at(3)},
        ], S.AUDIT)
        counts = report.live_counts(spark, {("my-schema", "t"): stored(spark, rows)})
        report.write_report(report.status_report(audit, counts, "east_us"), root)
    got = VersionedTable(spark, f"{root}/report").read()
    assert [f.split()[0] for f in S.REPORT.split(", ")] == got.columns
    by_name = {r["table_name"]: r for r in got.collect()}
    assert by_name["t"]["last_run_outcome"] == "SUCCESS" and by_name["t"]["total_rows_in_target"] == 30
    assert by_name["t"]["target_dataset"] == "east_us_my_schema"
    assert by_name["never"]["total_rows_in_target"] is None
    assert spark.read.json(f"{root}/report_snapshots").count() == 2


def test_an_empty_report_is_still_a_table(spark):
    root = scratch_path(spark, "control")
    none = report.status_report(local_frame(spark, [], S.AUDIT), report.live_counts(spark, {}))
    assert report.write_report(none, root).read().count() == 0
