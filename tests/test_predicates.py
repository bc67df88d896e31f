"""Keyset and cutoff predicates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ferrylane.functions import keys as K
from ferrylane.operators.batching import key_page


def ids(df):
    return [r[0] for r in df.select("id").orderBy("id").collect()]


DAY, NOON = dt.date(2031, 2, 28), dt.datetime(2031, 2, 28, 12)
NEXT = dt.datetime(2031, 3, 1)
MICRO = dt.timedelta(microseconds=1)
#: Around the day's start, its middle and its end, and one row without a time.
TIMES = [dt.datetime(2031, 2, 28) - MICRO, dt.datetime(2031, 2, 28), NOON, NOON + MICRO, NEXT - MICRO, NEXT, None]


@pytest.fixture
def stamped(spark):
    rows = [(i, t and str(t)) for i, t in enumerate(TIMES)]
    return spark.createDataFrame(rows, "id bigint, t string").select("id", F.col("t").cast("timestamp").alias("updatedAt"))


@pytest.mark.parametrize("cutoff, expected", [
    *[(day, ("<", NEXT)) for day in (DAY, DAY.isoformat(), f"\t{DAY.isoformat()} ")],
    *[(time, ("<=", NOON)) for time in (NOON, NOON.isoformat())],
    ("someday", ("<=", "someday")),
])
def test_cutoff_bound(cutoff, expected):
    assert K.cutoff_bound(cutoff) == expected


@pytest.mark.parametrize("cutoff, last", [(c, k) for c in (DAY, DAY.isoformat(), NOON.isoformat(), None) for k in (None, 1, 4)])
def test_scan_filter_on_rows(stamped, cutoff, last):
    def wanted(i, t):
        in_time = cutoff is None or t is not None and (t <= NOON if cutoff == NOON.isoformat() else t < NEXT)
        return in_time and (last is None or i > last)

    predicate = K.scan_filter(stamped.schema, ["id"], None if last is None else {"id": last}, cutoff)
    rows = stamped if predicate is None else stamped.where(predicate)
    assert ids(rows) == [i for i, t in enumerate(TIMES) if wanted(i, t)]


def test_nothing_to_filter_gives_no_predicate(stamped):
    assert K.scan_filter(stamped.schema, ["id"]) is None


def test_cutoff_without_its_column_is_an_error(stamped):
    with pytest.raises(K.MissingCutoffColumn, match="updatedAt"):
        K.scan_filter(stamped.drop("updatedAt").schema, ["id"], None, DAY.isoformat())


def test_after_key_is_lexicographic(spark):
    rows = [(a, b, c) for a in (1, 2) for b in ("x", "y") for c in (1, 2)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    for last in rows:
        got = df.where(K.after_key(df.schema, ["a", "b", "c"], dict(zip("abc", last)))).collect()
        assert sorted(tuple(r) for r in got) == [r for r in sorted(rows) if r > last]


def test_predicates_reach_the_scan(read, plan_of):
    orders = read("orders")
    last = {"o_custkey": 5, "o_orderkey": 9}
    wanted = K.scan_filter(orders.schema, ["o_custkey", "o_orderkey"], last, "1999-06-30", "o_orderdate")
    plan = plan_of(orders.where(wanted).select("o_orderkey"))
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "Or(GreaterThan(o_custkey,5),And(EqualTo(o_custkey,5),GreaterThan(o_orderkey,9)))" in pushed
    assert "LessThan(o_orderdate," in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_a_stored_key_reaches_the_scan_as_a_literal(read, plan_of):
    events = read("events")
    last = K.key_from_json('{"event_id":17}', K.key_schema(events.schema, ["event_id"]))
    assert "GreaterThan(event_id,17)" in plan_of(events.where(K.after_key(events.schema, ["event_id"], last)))


def test_page_is_a_top_n(read, plan_of):
    page = key_page(read("orders"), ["o_orderkey"], 10, {"o_orderkey": 100})
    assert "TakeOrderedAndProject" in plan_of(page)
    assert [r["o_orderkey"] for r in page.collect()] == list(range(101, 111))


def test_key_json_keeps_microseconds_and_decimals(spark):
    df = spark.sql("""select timestamp'2026-01-02 03:04:05.678901' as t, timestamp_ntz'2026-01-02 03:04:05.000001' as n,
                             cast(12345678901234567890.123456789 as decimal(38,9)) as d, date'2026-01-02' as y, 'a"b' as s""")
    stored = df.select(K.key_to_json(F.struct(*df.columns)).alias("pk"))
    decoded = K.key_from_json(F.col("pk"), df.schema)
    back = stored.select(*[c.alias(n) for n, c in decoded.items()])
    assert back.exceptAll(df).isEmpty() and back.count() == 1
