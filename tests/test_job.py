"""Whole runs: failures, resumption, skipping, row numbers and estates."""

import pytest
from pyspark.sql import functions as F

from checks.merges import catalog_of, resumed_table_run
from ferrylane import schemas as S
from ferrylane import storage
from ferrylane.job import LAND_ONLY, Settings, TableRun, run_estate, run_table
from ferrylane.operators import landing, merge
from ferrylane.operators.landing import LandingArea
from ferrylane.operators.ledger import Ledger
from ferrylane.plans.planner import build_plan, find_table
from ferrylane.session import local_frame, scratch_path
from ferrylane.sources.catalog import Catalog
from ferrylane.sources.tables import FrameSource, ParquetSource
from ferrylane.storage import VersionedTable

KEYS = {"orders": ["o_orderkey"], "conversations": ["conv_id", "turn"], "lineitem": [], "customer": ["c_custkey"]}


@pytest.fixture(scope="module")
def plan(spark):
    return build_plan(catalog_of(spark, "/root/testdata/sf0.001", KEYS)).cache()


class Estate:
    """One root with its tables, ledgers and a source."""

    def __init__(self, spark, plan, sf_dir, **settings):
        self.spark, self.plan = spark, plan
        self.settings = Settings(scratch_path(spark, "estate"), **settings)
        self.source = ParquetSource(spark, sf_dir)
        self.ledger = Ledger(spark, self.settings.control_path(None))

    def row(self, name):
        return find_table(self.plan, name)

    def run(self, name, **options):
        return run_table(self.spark, self.settings, self.row(name), options.pop("source", self.source), **options)

    def target(self, name):
        return VersionedTable(self.spark, self.settings.target_path(self.row(name)))

    def statuses(self):
        return [(r["status"], r["last_batch_index"], r["last_pk_json"])
                for r in self.ledger.checkpoints().orderBy("updated_at").collect()]

    def outcomes(self):
        return [(r["outcome"], r["batches_processed"], r["rows_processed"], r["resumed_from_batch"])
                for r in self.ledger.audit().orderBy("finished_at").collect()]

    def stages(self):
        return {(r["stage"], r["status"]): r["n"] for r in self.ledger.events().groupBy("stage", "status").agg(F.count("*").alias("n")).collect()}


@pytest.fixture
def estate(spark, plan, sf_dir):
    return lambda **settings: Estate(spark, plan, sf_dir, **settings)


@pytest.fixture
def breaking(monkeypatch):
    """Make a merge fail when it reaches the n-th commit, once per call."""

    def break_at(n):
        calls, real = {"n": 0}, merge.merge_into

        def flaky(*args, **options):
            calls["n"] += 1
            if calls["n"] == n:
                raise OSError("link down")
            return real(*args, **options)

        monkeypatch.setattr(merge, "merge_into", flaky)
        return lambda: monkeypatch.setattr(merge, "merge_into", real)

    return break_at


def same_rows(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(*a.columns)).isEmpty()


def test_a_run_from_start_to_end(estate, read):
    e = estate(batch_size=200, batches_per_commit=1)
    assert e.run("orders", run_id="r") == {
        "schema": "dbo", "name": "orders", "status": "SUCCESS", "batches_processed": 8, "rows_processed": 1500}
    assert e.statuses()[:2] == [("IN_PROGRESS", 0, '{"o_orderkey":199}'), ("IN_PROGRESS", 1, '{"o_orderkey":399}')]
    assert e.statuses()[-1] == ("COMPLETED", 7, '{"o_orderkey":1499}')
    assert e.outcomes() == [("SUCCESS", 8, 1500, 0)]
    assert e.stages() == {(stage, status): 8 if stage == "load" else 1 for stage in ("pipeline", "extraction", "upload", "transfer", "load")
                          for status in ("STARTED", "SUCCESS")}
    target = e.target("orders").read()
    assert target.schema["o_totalprice"].dataType.simpleString() == "decimal(18,2)"
    assert same_rows(target.select("o_orderkey", F.col("o_totalprice").cast("double"), "o_orderpriority"), read("orders"))
    assert e.ledger.events().where("stage = 'upload' and status = 'SUCCESS'").first()["bytes_processed"] > 0


def test_completed_tables_are_skipped_unless_forced_or_emptied(estate, spark):
    e = estate(batch_size=500)
    e.run("orders")
    assert e.run("orders")["status"] == "SKIPPED"
    assert len(e.outcomes()) == 1 and e.stages()["pipeline", "SKIPPED"] == 1
    assert e.run("orders", force=True)["status"] == "SUCCESS"
    assert e.target("orders").row_count() == 1500
    e.target("orders").replace(e.target("orders").read().limit(0))
    assert e.run("orders")["status"] == "SUCCESS"
    assert e.target("orders").row_count() == 1500


def test_incremental_tables_are_read_again_and_only_grow(estate, spark, plan, read, sf_dir):
    orders = read("orders")
    incremental = plan.withColumn("load_mode", F.lit("incremental"))
    e = Estate(spark, incremental, sf_dir, batch_size=400)
    half = FrameSource({"orders": orders.where("o_orderkey >= 700")})
    assert e.run("orders", source=half)["rows_processed"] == 800
    changed = FrameSource({"orders": orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)})
    assert e.run("orders", source=changed)["rows_processed"] == 1500
    added = e.target("orders").read().join(orders.select("o_orderkey", F.col("o_totalprice").alias("was")), "o_orderkey")
    assert added.where((F.col("o_totalprice") > F.col("was") + 0.5) != (F.col("o_orderkey") < 700)).isEmpty()
    assert added.count() == 1500


@pytest.mark.parametrize("name, broken_at", [("orders", 1), ("orders", 3), ("conversations", 2), ("lineitem", 2)])
def test_resuming_gives_what_an_unbroken_run_gives(estate, breaking, name, broken_at):
    size = {"orders": 200, "conversations": 20, "lineitem": 1000}[name]
    whole, broken = estate(batch_size=size), estate(batch_size=size, batches_per_commit=1)
    whole.run(name)
    mend = breaking(broken_at)
    with pytest.raises(OSError, match="link down"):
        broken.run(name)
    assert broken.statuses()[-1][:2] == ("FAILED", broken_at - 2)
    assert broken.outcomes()[-1][:3] == ("FAILED", broken_at - 1, (broken_at - 1) * size)
    assert broken.stages()["load", "FAILED"] == 1 and broken.stages()["pipeline", "FAILED"] == 1
    mend()
    broken.run(name)
    assert same_rows(broken.target(name).read(), whole.target(name).read())
    outcome, batches, rows, resumed_from = broken.outcomes()[-1]
    assert (outcome, resumed_from) == ("RESUMED_SUCCESS" if broken_at > 1 else "SUCCESS", broken_at - 1)
    assert rows == whole.outcomes()[-1][2] - (broken_at - 1) * size
    assert broken.statuses()[-1][1] == whole.statuses()[-1][1]


def test_a_crash_between_merge_and_checkpoint_adds_nothing_twice(estate, monkeypatch):
    e, real = estate(batch_size=500, batches_per_commit=1), Ledger.commit_batches

    def lost(self, run_id, schema, table, batches, status):
        if batches.first()["batch_index"] == 1:
            raise OSError("ledger down")
        real(self, run_id, schema, table, batches, status)

    monkeypatch.setattr(Ledger, "commit_batches", lost)
    with pytest.raises(OSError):
        e.run("orders")
    assert e.target("orders").row_count() == 1000 and e.statuses()[-1][:2] == ("FAILED", 0)
    monkeypatch.setattr(Ledger, "commit_batches", real)
    assert e.run("orders")["rows_processed"] == 1000
    assert e.target("orders").read().select("o_orderkey").distinct().count() == e.target("orders").row_count() == 1500


def test_a_batch_that_did_not_land_is_never_merged(estate, monkeypatch):
    from ferrylane.operators import landing

    e, real = estate(batch_size=500), landing.land
    monkeypatch.setattr(landing, "land", lambda df, *a, **k: real(df.where("o_orderkey <> 700"), *a, **k))
    with pytest.raises(landing.LandingMismatch, match="batch 1 short"):
        e.run("orders")
    assert e.target("orders").row_count() == 0 and e.statuses() == [("FAILED", -1, None)]


def test_landing_only_leaves_no_checkpoint_and_no_row_numbers(estate, spark, monkeypatch):
    from ferrylane.operators import landing

    e = estate(batch_size=1000)
    assert e.run("lineitem", run_id="a:b", stage=LAND_ONLY)["status"] == "SUCCESS_LANDED_ONLY"
    landed = spark.read.parquet(e.settings.landing_path(e.row("lineitem")))
    assert "source_row_id" not in landed.columns and landed.groupBy("batch_index").count().where("count <> 1000").isEmpty()
    assert landed.count() == 6000 and e.statuses() == [] and e.target("lineitem").row_count() == 0
    assert e.outcomes() == [("SUCCESS_LANDED_ONLY", 6, 6000, 0)]
    assert not storage.exists(spark, e.settings.work_path("frozen", e.row("lineitem")))
    monkeypatch.setattr(landing, "require_landed", lambda _: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        e.run("orders", stage=LAND_ONLY)
    assert e.statuses() == [] and e.outcomes()[-1][0] == "FAILED"
    monkeypatch.undo()
    e.run("orders")
    assert e.run("orders", stage=LAND_ONLY)["status"] == "SKIPPED"


def test_row_numbers_go_when_the_table_is_done(estate, spark, read):
    e = estate(batch_size=1000)
    e.run("lineitem")
    target = e.target("lineitem")
    assert "source_row_id" not in target.read().columns and target.row_count() == 6000
    assert not storage.exists(spark, e.settings.work_path("frozen", e.row("lineitem")))
    # Without numbers nothing matches any more, so a forced run adds every row again.
    e.run("lineitem", force=True)
    assert target.row_count() == 12000 and "source_row_id" not in target.read().columns
    assert target.read().distinct().count() == read("lineitem").distinct().count()


def test_cutoff_applies_to_keyless_tables_and_resumes(estate, breaking, read):
    e = estate(batch_size=500, batches_per_commit=1, cutoff="1998-12-31", cutoff_column="l_shipdate")
    mend = breaking(3)
    with pytest.raises(OSError):
        e.run("lineitem")
    mend()
    e.run("lineitem")
    expected = read("lineitem").where("l_shipdate < '1999-01-01'")
    assert e.target("lineitem").row_count() == expected.count()
    assert same_rows(e.target("lineitem").read().select("l_orderkey", "l_partkey", "l_linenumber"),
                     expected.select("l_orderkey", "l_partkey", "l_linenumber"))


def test_cutoff_without_its_column_fails_before_reading(estate):
    e = estate(cutoff="2026-01-01")
    with pytest.raises(ValueError, match="updatedAt"):
        e.run("orders")
    assert e.outcomes()[-1][0] == "FAILED"


class Remote(FrameSource):
    ranged = False

    def is_remote(self, table):
        return True

    def is_ranged(self, table):
        return self.ranged


@pytest.mark.parametrize("ranged", [False, True])
def test_remote_sources_are_copied_first_unless_ranged(estate, read, monkeypatch, ranged):
    orders = read("orders").repartitionByRange(4, "o_orderkey").cache()
    orders.count()
    source = Remote({"orders": orders})
    source.ranged = ranged
    e, copies, kept = estate(batch_size=300), [], TableRun._kept
    monkeypatch.setattr(TableRun, "_kept", lambda self, kind, rows: copies.append(kind) or kept(self, kind, rows))
    assert e.run("orders", source=source)["rows_processed"] == 1500
    assert e.target("orders").read().select("o_orderkey").distinct().count() == 1500
    assert copies == (["batches"] if ranged else ["raw", "batches"])
    orders.unpersist()


def test_an_empty_table_completes(estate, read):
    e = estate()
    assert e.run("orders", source=FrameSource({"orders": read("orders").limit(0)}))["rows_processed"] == 0
    assert e.statuses() == [("COMPLETED", -1, None)] and e.target("orders").row_count() == 0
    assert e.run("orders")["rows_processed"] == 1500


def test_an_estate_carries_on_past_a_failing_table(estate, spark, plan):
    e = estate(batch_size=2000)

    class Flaky(ParquetSource):
        def scan(self, table):
            if table["name"] == "customer":
                raise OSError("no such host")
            return super().scan(table)

    results, reports = run_estate(spark, e.settings, plan, Flaky(spark, "/root/testdata/sf0.001"))
    assert {r["name"]: r["status"] for r in results.collect()} == {
        "orders": "SUCCESS", "lineitem": "SUCCESS", "conversations": "SUCCESS", "customer": "FAILED"}
    report = {r["table_name"]: r for r in reports[0].read().collect()}
    assert report["customer"]["last_error_message"] == "no such host" and report["customer"]["total_rows_in_target"] == 0
    assert report["lineitem"]["total_rows_in_target"] == 6000
    results, _ = run_estate(spark, e.settings, plan, ParquetSource(spark, "/root/testdata/sf0.001"), load_mode="full")
    assert {r["name"]: r["status"] for r in results.collect()} == {
        "orders": "SKIPPED", "lineitem": "SKIPPED", "conversations": "SKIPPED", "customer": "SUCCESS"}


def test_the_plan_of_an_estate_is_streamed(estate, spark, plan, monkeypatch):
    """No more of it is read ahead than a few tables for each that is copied."""
    from ferrylane import job

    read, done, ahead = [], [], []
    many = plan.where("name = 'customer'").crossJoin(spark.range(40)).withColumn("name", F.format_string("t%02d", "id")).repartition(8)
    real = type(many).toLocalIterator

    def counted(self, *args):
        for row in real(self, *args):
            read.append(row["name"])
            yield row

    def run(spark, settings, table, *_):
        ahead.append(len(read) - len(done))
        done.append(table["name"])
        return {"status": "SUCCESS", "batches_processed": 0, "rows_processed": 0}

    monkeypatch.setattr(type(many), "toLocalIterator", counted)
    monkeypatch.setattr(job, "run_table", run)
    monkeypatch.setattr(job, "write_reports", lambda *_: [])
    e = estate(parallel_tables=2)
    results, _ = run_estate(spark, e.settings, many.withColumn("dataset", F.col("name")), e.source)
    assert sorted(done) == [f"t{i:02d}" for i in range(40)] and results.where("status = 'SUCCESS'").count() == 40
    assert max(ahead) <= 6


def test_regions_run_together_equal_regions_run_apart(spark, plan, sf_dir, read):
    regional = plan.where("name in ('orders', 'customer')").withColumn("region", F.explode(F.array(F.lit("East US"), F.lit("UK South"))))
    slug = F.regexp_replace(F.lower("region"), " ", "_")
    regional = regional.withColumn("region_slug", slug).withColumn("dataset", F.concat_ws("_", slug, "schema"))
    together, apart = (Settings(scratch_path(spark, "estate"), batch_size=600) for _ in range(2))
    source = ParquetSource(spark, sf_dir)
    _, reports = run_estate(spark, together, regional, source)
    assert len(reports) == 2
    for row in regional.collect():
        run_table(spark, apart, row, source)
        a, b = (VersionedTable(spark, s.target_path(row)).read() for s in (together, apart))
        assert same_rows(a, b) and a.count() > 0
    assert {r["target_dataset"] for r in reports[0].read().collect()} == {"east_us_dbo"}


def test_a_table_without_any_key_is_refused(estate):
    e = estate()
    row = type(e.row("orders"))(**{**e.row("orders").asDict(), "primary_key": []})
    with pytest.raises(ValueError, match="no key"):
        TableRun(e.spark, e.settings, row, e.source, "r").run()


ODD = ["a.b", "se lect", "tick`s", "row_rank", "ключ"]


@pytest.mark.parametrize("keys", [["a.b", "tick`s"], []])
def test_any_column_name_will_do(spark, keys):
    catalog = Catalog(
        local_frame(spark, [{"table_schema": "my.schema", "table_name": "t[1]: x/y", "table_type": "BASE TABLE"}], S.TABLES),
        local_frame(spark, [{"table_schema": "my.schema", "table_name": "t[1]: x/y", "column_name": c, "data_type": "int",
                             "ordinal_position": i} for i, c in enumerate(ODD)], S.COLUMNS),
        local_frame(spark, [{"table_schema": "my.schema", "table_name": "t[1]: x/y", "constraint_name": "pk",
                             "constraint_type": "PRIMARY KEY"}] * bool(keys), S.CONSTRAINTS),
        local_frame(spark, [{"table_schema": "my.schema", "constraint_name": "pk", "column_name": c, "ordinal_position": i}
                            for i, c in enumerate(keys)], S.KEY_COLUMNS),
    )
    row = find_table(build_plan(catalog), "t[1]: x/y")
    rows = spark.range(100).select(*[(F.col("id") * 3 % (7 + i)).cast("int").alias(c) for i, c in enumerate(ODD)]).distinct()
    rows = rows.dropDuplicates(["a.b", "tick`s"]) if keys else rows
    settings = Settings(scratch_path(spark, "estate"), batch_size=10)
    for _ in range(2):
        run_table(spark, settings, row, FrameSource({"t[1]: x/y": rows}))
    target = VersionedTable(spark, settings.target_path(row)).read()
    assert target.columns == ODD and target.count() == rows.count()


def test_the_landing_partition_name_is_reserved(estate):
    e = estate()
    row = e.row("orders").asDict(recursive=True)
    row["columns"].append({**row["columns"][0], "name": "Batch_Index"})
    with pytest.raises(ValueError, match="batch_index"):
        TableRun(e.spark, e.settings, row, e.source, "r").run()


class Killed(BaseException):
    """The end of a driver: nothing catches it."""


class Turned(ParquetSource):
    """A source that gives its rows in another order each time it is asked, as databases may."""

    def scan(self, table):
        return super().scan(table).orderBy(F.desc("l_orderkey"), F.desc("l_linenumber"))


def killed(monkeypatch, where, name, on=1):
    """Let a run die on its n-th call of a method."""
    calls, real = {"n": 0}, getattr(where, name)

    def die(*args, **options):
        calls["n"] += 1
        if calls["n"] == on:
            raise Killed
        return real(*args, **options)

    monkeypatch.setattr(where, name, die)


@pytest.mark.parametrize("commits", [1, 2])
def test_a_killed_keyless_run_loses_and_doubles_nothing(estate, spark, sf_dir, read, monkeypatch, commits):
    e = estate(batch_size=1000, batches_per_commit=1)
    killed(monkeypatch, Ledger, "commit_batches", commits)
    with pytest.raises(Killed):
        e.run("lineitem")
    monkeypatch.undo()
    assert e.target("lineitem").row_count() == 1000 * commits
    assert e.statuses()[0] == ("IN_PROGRESS", -1, None) and len(e.statuses()) == commits
    e.run("lineitem", source=Turned(spark, sf_dir))
    got = e.target("lineitem").read()
    assert got.columns == read("lineitem").columns
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]
    assert same_rows(got.select(keys), read("lineitem").select(keys))


def test_numbers_that_could_not_be_dropped_do_no_harm(estate, spark, sf_dir, monkeypatch):
    e = estate(batch_size=2000)
    real = merge.drop_target_column

    def refuse(table, column):
        if table.row_count():
            raise OSError("no rewrite")
        return real(table, column)

    monkeypatch.setattr(merge, "drop_target_column", refuse)
    e.run("lineitem")
    assert "source_row_id" in e.target("lineitem").read().columns
    monkeypatch.undo()
    e.run("lineitem", source=Turned(spark, sf_dir), force=True)
    # As after any forced run of a keyless table every row is there again; none is missing.
    assert "source_row_id" not in e.target("lineitem").read().columns
    assert e.target("lineitem").read().groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").count().where("count % 2 = 1").isEmpty()
    assert e.target("lineitem").row_count() == 12000


def test_every_batch_has_a_checkpoint_however_they_are_merged(estate):
    one, few = estate(batch_size=100, batches_per_commit=1), estate(batch_size=100, max_commits=2)
    one.run("orders")
    few.run("orders")
    assert sorted(one.statuses()) == sorted(few.statuses()) and len(few.statuses()) == 16


def test_a_keyed_load_writes_rows_to_landing_and_target_after_ranking(estate, spark, monkeypatch):
    e, ranges = estate(batch_size=500), []
    from ferrylane import job

    real = job.rank_by_key
    monkeypatch.setattr(job, "rank_by_key", lambda *a, **k: ranges.append(k["ranges"]) or real(*a, **k))
    e.run("orders")
    e.run("orders", force=True)
    assert ranges == [1, 1]
    path = e.settings.landing_path(e.row("orders"))
    assert spark.read.parquet(path).count() == 1500  # the second run's batches replaced the first's


def landed(e, spark, name="orders"):
    return {r["batch_index"]: r["n"] for r in spark.read.parquet(e.settings.landing_path(e.row(name))).groupBy("batch_index").agg(F.count("*").alias("n")).collect()}


def manifest(e, spark, name="orders"):
    return {r["batch_index"]: (r["rows"], r["run_id"]) for r in LandingArea(spark, e.settings.landing_path(e.row(name))).manifest().collect()}


def test_an_incremental_run_lands_what_the_target_lacks(spark, plan, sf_dir, read):
    e = Estate(spark, plan.withColumn("load_mode", F.lit("incremental")), sf_dir, batch_size=400)
    assert e.run("orders", source=FrameSource({"orders": read("orders").where("o_orderkey % 2 = 0")}))["rows_processed"] == 750
    assert landed(e, spark) == {0: 400, 1: 350}
    assert e.run("orders", run_id="second")["rows_processed"] == 1500 and e.target("orders").row_count() == 1500
    assert landed(e, spark) == {0: 400, 1: 350} and manifest(e, spark) == {0: (400, "second"), 1: (350, "second")}
    delta = spark.read.parquet(e.settings.landing_path(e.row("orders")))
    assert delta.where("o_orderkey % 2 = 0").isEmpty()
    assert e.run("orders")["rows_processed"] == 1500 and landed_files(e, spark) == 0
    assert e.statuses()[-1][0] == "COMPLETED" and e.statuses()[-1][2] == '{"o_orderkey":1499}'


def test_an_incremental_run_over_few_keys_opens_few_target_files(spark, plan, sf_dir, read, monkeypatch):
    e, opened, real = Estate(spark, plan.withColumn("load_mode", F.lit("incremental")), sf_dir, batch_size=100, batches_per_commit=1), [], merge.new_rows
    e.run("orders")
    monkeypatch.setattr(merge, "new_rows", lambda rows, target, *a, **k: opened.append(len(target.inputFiles())) or real(rows, target, *a, **k))
    e.run("orders", source=FrameSource({"orders": read("orders").where("o_orderkey BETWEEN 1450 AND 1460")}))
    assert len(e.target("orders").read().inputFiles()) >= 15 and opened and max(opened) <= 2
    assert e.target("orders").row_count() == 1500


def landed_files(e, spark):
    return sum(name.startswith("batch_index=") for name in storage.folders(spark, e.settings.landing_path(e.row("orders"))))


@pytest.mark.parametrize("broken_at", [1, 2, 4])
def test_a_first_incremental_load_resumes_where_it_broke(spark, plan, sf_dir, read, breaking, broken_at):
    e = Estate(spark, plan.withColumn("load_mode", F.lit("incremental")), sf_dir, batch_size=400, batches_per_commit=1)
    mend = breaking(broken_at)
    with pytest.raises(OSError):
        e.run("orders")
    done = 400 * (broken_at - 1)
    assert e.target("orders").row_count() == done and e.statuses()[-1][:2] == ("FAILED", broken_at - 2)
    mend()
    assert e.run("orders")["rows_processed"] == 1500 - done and same_rows(e.target("orders").read().select("o_orderkey"), read("orders").select("o_orderkey"))
    assert landed(e, spark) == {0: 400, 1: 400, 2: 400, 3: 300} and e.statuses()[-1][:2] == ("COMPLETED", 3)


@pytest.mark.parametrize("stage", ["load", LAND_ONLY])
@pytest.mark.parametrize("name, size, total", [("orders", 300, 1500), ("lineitem", 1000, 6000)])
def test_a_resumed_run_keeps_the_batches_that_landed(estate, spark, breaking, stage, name, size, total):
    e = estate(batch_size=size, batches_per_commit=1)
    mend = breaking(3)
    with pytest.raises(OSError):
        e.run(name, run_id="first")
    mend()
    e.run(name, run_id="second", stage=stage)
    batches = -(-total // size)
    assert landed(e, spark, name) == dict.fromkeys(range(batches), size)
    assert manifest(e, spark, name) == {i: (size, "first" if i < 2 else "second") for i in range(batches)}


def test_batches_of_another_size_are_removed_on_resume(estate, spark, breaking):
    e = estate(batch_size=100, batches_per_commit=1)
    mend = breaking(3)
    with pytest.raises(OSError):
        e.run("orders")
    mend()
    e.settings = Settings(e.settings.root, batch_size=1000)
    e.run("orders")
    assert landed(e, spark) == {0: 100, 1: 100, 2: 1000, 3: 300} and e.target("orders").row_count() == 1500


def test_a_landing_only_run_starts_over_where_landed_batches_are_gone(estate, spark, breaking):
    e = estate(batch_size=300, batches_per_commit=1)
    mend = breaking(3)
    with pytest.raises(OSError):
        e.run("orders")
    mend()
    storage.delete(spark, e.settings.landing_path(e.row("orders")))
    assert e.run("orders", stage=LAND_ONLY)["batches_processed"] == 5 and landed(e, spark) == dict.fromkeys(range(5), 300)
    assert e.run("orders")["rows_processed"] == 900  # the load still resumes after its own checkpoint
    assert e.target("orders").row_count() == 1500


def test_a_landed_batch_that_vanished_fails_the_resumed_run(estate, spark, breaking):
    from ferrylane.operators.landing import LandingMismatch

    e = estate(batch_size=300, batches_per_commit=1)
    mend = breaking(3)
    with pytest.raises(OSError):
        e.run("orders")
    mend()
    storage.delete(spark, f"{e.settings.landing_path(e.row('orders'))}/batch_index=1")
    with pytest.raises(LandingMismatch, match="batch 1 missing"):
        e.run("orders")


def test_a_fresh_run_leaves_nothing_of_the_last_one(estate, spark, read):
    e = estate(batch_size=100)
    e.run("orders", stage=LAND_ONLY)
    few = FrameSource({"orders": read("orders").where("o_orderkey < 250")})
    e.run("orders", source=few, stage=LAND_ONLY, run_id="few")
    assert landed(e, spark) == {0: 100, 1: 100, 2: 50} and set(manifest(e, spark)) == {0, 1, 2}
    e.run("orders", source=FrameSource({"orders": read("orders").limit(0)}), stage=LAND_ONLY)
    assert landed_files(e, spark) == 0 and manifest(e, spark) == {}


def test_a_joined_source_is_measured_before_it_is_cut(estate, spark, read, monkeypatch):
    from ferrylane import job

    ranges, real = [], job.rank_by_key
    monkeypatch.setattr(job, "rank_by_key", lambda *a, **k: ranges.append(k["ranges"]) or real(*a, **k))
    customers = read("customer").select(F.col("c_custkey").alias("o_custkey"))
    e = estate(batch_size=500)
    assert e.run("orders", source=FrameSource({"orders": read("orders").join(customers, "o_custkey")}))["rows_processed"] == 1500
    assert ranges == [1] and not storage.exists(spark, e.settings.work_path("unranked", e.row("orders")))


def regional(plan, *names):
    slug = F.regexp_replace(F.lower("region"), " ", "_")
    own = plan.where("name = 'orders'").withColumn("region", F.explode(F.array(*map(F.lit, names))))
    return own.withColumn("region_slug", slug).withColumn("dataset", F.concat_ws("_", slug, "schema"))


def test_each_region_is_copied_from_its_own_source(spark, plan, read):
    regions = local_frame(spark, [{"region": r, "host": f"{r}.example"} for r in ("North", "South", "Lost")], S.REGIONS)
    halves = {"North": read("orders").where("o_orderkey < 700"), "South": read("orders").where("o_orderkey >= 600")}

    def connect(row):
        if row["region"] == "Lost":
            raise OSError("unreachable")
        return regional(plan, row["region"]), FrameSource({("dbo", "orders"): halves[row["region"]]})

    from ferrylane.job import run_regions
    from ferrylane.plans.regions import RegionError

    settings = Settings(scratch_path(spark, "estate"), batch_size=400)
    results, reports, errors = run_regions(spark, settings, regions, "all", connect)
    assert errors == {"Lost": "unreachable"} and len(reports) == 2
    assert {r["region"]: r["rows_processed"] for r in results.collect()} == {"North": 700, "South": 900}
    for slug, rows in (("north", 700), ("south", 900)):
        assert VersionedTable(spark, f"{settings.root}/data/{slug}_dbo/orders").row_count() == rows
    with pytest.raises(RegionError, match="every region failed"):
        run_regions(spark, settings, regions, "lost", connect)
    results, _ = run_estate(spark, settings, regional(plan, "North", "South"), {"North": FrameSource({"orders": halves["North"]})}, force=True)
    assert {r["region"]: r["status"] for r in results.collect()} == {"North": "SUCCESS", "South": "FAILED"}


def test_tables_of_one_name_in_two_schemas_are_two_tables(spark, plan, read):
    two = plan.where("name = 'orders'").withColumn("schema", F.explode(F.array(F.lit("a"), F.lit("b")))).withColumn("dataset", F.col("schema"))
    settings = Settings(scratch_path(spark, "estate"))
    run_estate(spark, settings, two, FrameSource({("a", "orders"): read("orders").limit(10), ("b", "orders"): read("orders").limit(20)}))
    assert [VersionedTable(spark, f"{settings.root}/data/{s}/orders").row_count() for s in "ab"] == [10, 20]


def test_a_report_is_written_past_an_unreadable_target(estate, spark, plan):
    from pathlib import Path

    from ferrylane.job import write_reports

    e = estate(batch_size=2000)
    e.run("orders")
    e.run("customer")
    (Path(e.target("customer").current_path()) / "part-broken.parquet").write_bytes(b"garbage")
    reports = write_reports(spark, e.settings, [e.row("orders"), e.row("customer")])
    assert {r["table_name"]: r["total_rows_in_target"] for r in reports[0].read().collect()} == {"orders": 1500, "customer": None}


def test_finished_versions_are_known_whatever_the_cluster_marks(estate, spark):
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        e = estate(batch_size=1000)
        e.run("orders")
        assert e.run("orders")["status"] == "SKIPPED" and e.target("orders").row_count() == 1500
        e.run("lineitem")
        assert e.target("lineitem").row_count() == 6000
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


@pytest.mark.parametrize("kind, value", [
    ("binary", "unhex(lpad(hex(id * 7 + 200), 4, '0'))"), ("decimal(30,10)", "cast(id as decimal(30,10)) / 7"),
    ("timestamp", "timestamp_micros(id * 1234567891)"), ("string", "concat('k', id)"), ("date", "date_add(date'2020-01-01', cast(id as int))")])
def test_stream_batches_find_keys_of_any_type(spark, kind, value):
    from ferrylane.streaming.sync import sync_batch

    rows = spark.range(40).selectExpr(f"cast({value} as {kind}) as k", "id as v")
    target = VersionedTable(spark, scratch_path(spark, "target"))
    target.replace(rows.where("v < 30"))
    assert sync_batch(target, rows.where("v between 10 and 19"), ["k"]) == 0
    assert sync_batch(target, rows, ["k"]) == 10 and sync_batch(target, rows, ["k"]) == 0


def test_a_run_reads_each_landed_folder_once_to_merge_it(estate, monkeypatch):
    listed, real = [], landing.read_landed

    def spy(*args):
        found = real(*args)
        listed.append({f.split("batch_index=")[1].split("/")[0] for f in found.inputFiles()})
        return found

    monkeypatch.setattr(landing, "read_landed", spy)
    e = estate(batch_size=200, max_commits=4)
    assert e.run("orders")["batches_processed"] == 8
    everything = {str(n) for n in range(8)}
    assert listed == [everything, {"0", "1"}, {"2", "3"}, {"4", "5"}, {"6", "7"}]
    assert e.target("orders").read().count() == 1500


def test_resumed_table_run_commits_a_thousand_orders_at_a_time(spark, tmp_path):
    one = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(1).drop("o_orderkey")
    orders = spark.range(6000).withColumnRenamed("id", "o_orderkey").crossJoin(F.broadcast(one))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    seen = {tuple(r) for r in resumed_table_run(spark, str(tmp_path)).collect()}
    assert seen == {("FAILED", 2, 2000, 0, 2000), ("RESUMED_SUCCESS", 4, 4000, 2, 6000)}


def test_a_run_looks_at_the_targets_keys_once_not_once_per_commit(estate, monkeypatch):
    looked, real = [], merge.new_rows
    monkeypatch.setattr(merge, "new_rows", lambda *args, **options: looked.append(1) or real(*args, **options))
    e = estate(batch_size=100, batches_per_commit=1)
    assert e.run("orders")["batches_processed"] == 15 and not looked
    assert e.target("orders").row_count() == 1500 and len(e.statuses()) == 16
    assert e.run("orders", force=True)["rows_processed"] == 1500 and len(looked) == 15
    assert e.target("orders").row_count() == 1500


def test_commits_that_the_target_may_know_keys_of_are_compared(estate, read, spark, monkeypatch):
    """Keys of the target in the range of one commit, and a key that closes one batch and opens the next."""
    compared, real = [], merge.new_rows
    monkeypatch.setattr(merge, "new_rows", lambda *args, **options: compared.append(1) or real(*args, **options))
    one = read("orders").limit(1)
    keyed = lambda *keys: spark.createDataFrame([(k,) for k in keys], "k long").crossJoin(F.broadcast(one)).withColumn("o_orderkey", F.col("k")).drop("k")
    e = estate(batch_size=2, batches_per_commit=1)
    e.run("orders", source=FrameSource({"orders": keyed(5, 5, 6)}))
    assert len(compared) == 0 and e.target("orders").row_count() == 3  # each key in one batch: no comparison
    e.run("orders", force=True, source=FrameSource({"orders": keyed(1, 2, 3, 6, 7, 8, 9, 9, 9, 10)}))
    assert len(compared) == 2  # the batches 3, 6 and 9, 10, which comes after 9, 9
    assert sorted(r[0] for r in e.target("orders").read().select("o_orderkey").collect()) == [1, 2, 3, 5, 5, 6, 7, 8, 9, 9, 10]
