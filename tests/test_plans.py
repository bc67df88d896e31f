"""Discovery, planning, overrides, lookups, regions and names."""

import pytest
from pyspark.sql import functions as F

from ferrylane import schemas as S
from ferrylane.functions import naming
from ferrylane.plans import planner as P
from ferrylane.plans import regions as R
from ferrylane.session import local_frame
from ferrylane.sources import catalog as C
from ferrylane.sources.tables import JdbcSource, hash_predicates, hashed_columns, range_predicates, split_points_query


def frame(spark, ddl, rows):
    names = [c.split()[0] for c in ddl.split(", ")]
    return local_frame(spark, [dict(zip(names, r)) for r in rows], ddl)


@pytest.fixture
def catalog(spark):
    def both(*row):
        return [("East US", *row), ("West US", *row)]

    east = "East US"
    return C.Catalog(
        frame(spark, S.TABLES, [
            *both("dbo", "test11", "BASE TABLE"), (east, "sales", "test11", "BASE TABLE"),
            (east, "dbo", "v_orders", "VIEW"), (east, "SYS", "objects", "BASE TABLE"),
            (east, "dbo", "__migration_rownum__test11", "BASE TABLE"), (east, "dbo", "indian airlines", "BASE TABLE"),
            (east, "dbo", "transactions_all", "BASE TABLE"), (east, "dbo", "has_row_id", "BASE TABLE"),
            (east, "my-schema", "pair", "BASE TABLE")]),
        frame(spark, S.COLUMNS, [
            *both("dbo", "test11", "id", "int", 10, 0, 1), *both("dbo", "test11", "amount", "decimal", 18, 2, 2),
            (east, "sales", "test11", "id", "int", 10, 0, 1), (east, "dbo", "indian airlines", "column1", "int", 10, 0, 1),
            (east, "dbo", "transactions_all", "b", "nvarchar", None, None, 2), (east, "dbo", "transactions_all", "a", "xml", None, None, 1),
            (east, "dbo", "has_row_id", "Source_Row_Id", "bigint", 19, 0, 1),
            (east, "my-schema", "pair", "y", "int", 10, 0, 2), (east, "my-schema", "pair", "x", "int", 10, 0, 1)]),
        frame(spark, S.CONSTRAINTS, [
            *both("dbo", "test11", "PK_t", "PRIMARY KEY"), (east, "sales", "test11", "PK_t", "PRIMARY KEY"),
            (east, "dbo", "transactions_all", "UQ", "UNIQUE"), (east, "dbo", "indian airlines", "PK_i", "PRIMARY KEY"),
            (east, "my-schema", "pair", "PK_p", "PRIMARY KEY")]),
        frame(spark, S.KEY_COLUMNS, [
            *both("dbo", "PK_t", "id", 1), (east, "sales", "PK_t", "id", 1), (east, "dbo", "UQ", "a", 1),
            (east, "dbo", "PK_i", "column1", 1), (east, "my-schema", "PK_p", "x", 2), (east, "my-schema", "PK_p", "y", 1)]),
    )


@pytest.fixture
def plan(catalog):
    return P.build_plan(catalog)


def test_discovery(catalog):
    schemas = {tuple(r) for r in C.discover_schemas(catalog.tables).collect()}
    assert schemas == {("East US", "dbo"), ("East US", "sales"), ("East US", "my-schema"), ("West US", "dbo")}
    names = {tuple(r) for r in C.discover_tables(catalog.tables).collect()}
    assert ("East US", "dbo", "v_orders") not in names and len(names) == 7
    assert not [n for _, _, n in names if n.startswith("__migration_rownum__")]


@pytest.mark.parametrize("wanted, expected", [(["sales", "SYS"], {"sales", "SYS"}), ("*", {"dbo", "sales", "my-schema"}),
                                              ([], {"dbo", "sales", "my-schema"}), (["nope"], {"nope"})])
def test_configured_schemas(catalog, wanted, expected):
    east = C.discover_schemas(catalog.tables, wanted).where("region = 'East US'")
    assert {r["schema"] for r in east.collect()} == expected


def test_plan(plan):
    rows = {(r["region"], r["schema"], r["name"]): r for r in plan.collect()}
    assert len(rows) == 7
    pair = rows["East US", "my-schema", "pair"]
    assert pair["primary_key"] == ["y", "x"] and [c["name"] for c in pair["columns"]] == ["x", "y"]
    assert (pair["dataset"], pair["region_slug"], pair["load_mode"]) == ("east_us_my_schema", "east_us", "full")
    keyless = rows["East US", "dbo", "transactions_all"]
    assert keyless["synthetic_key"] and keyless["primary_key"] == ["source_row_id"]
    assert [(c["name"], c["spark_type"]) for c in keyless["columns"]] == [("a", "string"), ("b", "string"), ("source_row_id", "bigint")]
    assert rows["East US", "dbo", "has_row_id"]["primary_key"] == ["_migration_row_id"]
    test11 = rows["West US", "dbo", "test11"]
    assert not test11["synthetic_key"] and test11["columns"][1]["spark_type"] == "decimal(18,2)"


def test_plan_of_one_database_without_regions(spark, catalog):
    one = C.Catalog(*[f.where("region = 'East US'").withColumn("region", F.lit(None).cast("string"))
                      for f in (catalog.tables, catalog.columns, catalog.constraints, catalog.key_columns)])
    row = P.find_table(P.build_plan(one), "pair")
    assert row["primary_key"] == ["y", "x"] and row["dataset"] == "my_schema" and row["region_slug"] is None


def test_one_schema(catalog):
    assert {r["name"] for r in P.build_plan(catalog, schema="sales").collect()} == {"test11"}
    with pytest.raises(P.SchemaNotFound, match="dbo, my-schema, sales"):
        P.build_plan(catalog, schema="Sales")


OVERRIDES = [
    (1, None, "test11", None, "incremental", None),
    (2, None, "test11", "east-us", "full", True),
    (3, "dbo", "test11", None, "incremental", None),
    (4, "dbo", "test11", "WEST us", "full", None),
    (5, None, "pair", "West US", "incremental", None),
    (6, "dbo", "transactions_all", None, "incremental", None),
    (7, "dbo", "transactions_all", None, None, None),
    (8, "dbo", "indian airlines", "", "incremental", False),
    (9, "dbo", None, None, "incremental", True),
]


def test_overrides(spark, catalog):
    plan = P.build_plan(catalog, frame(spark, S.OVERRIDES, OVERRIDES))
    modes = {(r["region"], r["schema"], r["name"]): r["load_mode"] for r in plan.collect()}
    assert modes["East US", "dbo", "test11"] == "incremental"      # exact schema beats any schema in this region
    assert modes["West US", "dbo", "test11"] == "full"             # within it, the region's own entry wins
    assert ("East US", "sales", "test11") not in modes              # only the any-schema entry for East applies: excluded
    assert modes["East US", "my-schema", "pair"] == "full"         # another region's entry does not apply
    assert modes["East US", "dbo", "transactions_all"] == "full"   # the later entry wins, whole
    assert modes["East US", "dbo", "indian airlines"] == "incremental"
    assert {tuple(r) for r in P.load_mode_counts(plan).collect()} == {("full", 4), ("incremental", 2)}


def test_unknown_load_mode_is_refused(spark, catalog):
    with pytest.raises(Exception, match="unknown load_mode hourly"):
        P.build_plan(catalog, frame(spark, S.OVERRIDES, [(1, None, "pair", None, "hourly", None)])).collect()


def test_lookup(plan):
    assert P.find_table(plan, "pair")["schema"] == "my-schema"
    assert P.find_table(plan, "test11", "sales")["schema"] == "sales"
    assert P.find_table(plan, "test11", "dbo", region="west-us")["region"] == "West US"
    with pytest.raises(P.AmbiguousTable, match="dbo, sales"):
        P.find_table(plan, "test11")
    with pytest.raises(P.AmbiguousTable, match="East US, West US"):
        P.find_table(plan, "test11", "dbo")
    with pytest.raises(P.TableNotFound, match="exists in: my-schema"):
        P.find_table(plan, "pair", "dbo")
    with pytest.raises(P.TableNotFound, match="any schema"):
        P.find_table(plan, "v_orders")


def test_schema_table_shorthand():
    assert P.split_schema_table("dbo.orders") == ("orders", "dbo")
    assert P.split_schema_table("dbo.orders", "dbo") == ("orders", "dbo")
    assert P.split_schema_table("orders", "dbo") == ("orders", "dbo")
    for raw, schema in [("a.b.c", None), (".b", None), ("a.", None), ("a.b", "c")]:
        with pytest.raises(ValueError):
            P.split_schema_table(raw, schema)


REGIONS = [("Upper Delta", "ud.example"), ("Lake Side", "lake.example"), ("Lake Side 7", "lake7.example"),
           ("High Moor", "<to be filled in>"), ("Far Isles", "isles.example")]


def spellings(name):
    """The rule: case, and anything but letters and digits, makes no difference."""
    words = name.split()
    return [sep.join(words) for sep in (" ", "", "-", "__", " . ")] + [name.upper(), name.lower(), f"\t{name}  "]


@pytest.fixture
def regions(spark):
    return frame(spark, S.REGIONS, REGIONS)


@pytest.mark.parametrize("text", spellings("Upper Delta"))
def test_region_names_match_loosely(regions, text):
    assert [r["region"] for r in R.regions_to_run(regions, text).collect()] == ["Upper Delta"]


def test_region_names_never_match_by_prefix(regions):
    assert R.regions_to_run(regions, "lake side").first()["host"] == "lake.example"
    assert R.regions_to_run(regions, "LAKE_SIDE_7").first()["host"] == "lake7.example"
    with pytest.raises(R.RegionError, match="unknown region"):
        R.regions_to_run(regions, "lake")
    for nothing in (None, "  "):
        with pytest.raises(R.RegionError, match="required"):
            R.regions_to_run(regions, nothing)


def test_without_regions_there_is_one_database(spark):
    none = frame(spark, S.REGIONS, [])
    assert [r["region"] for r in R.regions_to_run(none, None).collect()] == [None]
    with pytest.raises(R.RegionError, match="no regions"):
        R.regions_to_run(none, "East US")


@pytest.mark.parametrize("word", ["ALL", "*"])
def test_all_regions_are_those_with_a_host(spark, regions, word):
    assert {r["region"] for r in R.regions_to_run(regions, word).collect()} == {n for n, _ in REGIONS} - {"High Moor"}
    with pytest.raises(R.RegionError, match="no region"):
        R.regions_to_run(regions.withColumn("host", F.lit(" ")), word)


def test_regions_that_are_the_same_are_refused(spark, regions):
    twice = regions.unionByName(frame(spark, S.REGIONS, [("far-isles", "h", "us")]))
    with pytest.raises(R.RegionError, match="Far Isles, far-isles"):
        R.regions_to_run(twice, "far isles")


def test_one_region_that_fails_does_not_stop_the_others(spark):
    def broken():
        raise OSError("unreachable")

    def one():
        return spark.createDataFrame([("t", "full"), ("u", "incremental")], "name string, load_mode string")

    union, errors = R.union_of_regions({"East US": one, "West US": broken, "UK": one}, "full")
    assert sorted((r["region"], r["name"]) for r in union.collect()) == [("East US", "t"), ("UK", "t")]
    assert errors == {"West US": "unreachable"}
    with pytest.raises(R.RegionError, match="every region failed: A: unreachable"):
        R.union_of_regions({"A": broken})


def one_value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_names(spark):
    slug = naming.region_slug(F.lit(" Germany West-Central "))
    assert one_value(spark, slug) == "germany_west_central"
    assert one_value(spark, naming.control_dataset("migrated_data", slug)) == "migrated_data_germany_west_central"
    assert one_value(spark, naming.landing_bucket("landing", slug)) == "landing-germany-west-central"
    assert one_value(spark, naming.dataset_name(F.lit("my-schema"), F.lit("east_us"))) == "east_us_my_schema"
    assert one_value(spark, naming.dataset_name(F.lit("dbo"))) == "dbo"
    path = naming.batch_file(F.lit(None).cast("string"), F.lit("dbo"), F.lit("t"), F.lit(7))
    assert one_value(spark, path) == "dbo/t/t_part0007"
    with pytest.raises(Exception, match="schema name is required"):
        one_value(spark, naming.dataset_name(F.lit("")))


def test_datasets_must_not_collide(spark, plan):
    assert naming.require_distinct_datasets(plan) is plan
    clash = plan.select("dataset", "schema").unionByName(spark.createDataFrame([("east_us_my_schema", "my_schema")], "dataset string, schema string"))
    with pytest.raises(naming.DatasetCollision, match="my-schema, my_schema"):
        naming.require_distinct_datasets(clash)


@pytest.mark.parametrize("keys", [["conv_id", "turn"], ["conv_id"]])
def test_source_ranges_take_every_row_once_in_key_order(spark, read, keys):
    """The SQL a database would run, run by DuckDB over one of the given tables."""
    import duckdb

    table = "'/root/testdata/sf0.01/conversations.parquet'"
    points = sorted(duckdb.connect().execute(split_points_query(table, keys, 5)).fetchall())
    assert len(points) == 5
    ranges = [duckdb.connect().execute(f"select conv_id, turn from {table} where {p}").fetchall() for p in range_predicates(keys, points)]
    everything = duckdb.connect().execute(f"select conv_id, turn from {table} order by 1, 2").fetchall()
    assert [row for r in ranges for row in sorted(r)] == everything
    if len(keys) == 2:
        assert max(map(len, ranges)) - min(map(len, ranges)) <= 1


def test_keys_ordered_differently_by_the_database_are_not_ranged(spark):
    source = JdbcSource(spark, "jdbc:none", {}, parts=4)
    number = {"synthetic_key": False, "primary_key": ["k"], "columns": [{"name": "k", "logical_type": "INT64"}]}
    text = {**number, "columns": [{"name": "k", "logical_type": "STRING"}]}
    assert source.is_ranged(number) and not source.is_ranged(text)
    assert not source.is_ranged({**number, "synthetic_key": True})
    assert range_predicates(["k"], [(1,)]) == ["1 = 1"]


def test_catalog_and_scan_over_jdbc(spark, catalog, monkeypatch):
    """What is asked of the reader, with frames in place of a database."""
    from pyspark.sql.readwriter import DataFrameReader

    views = {"TABLES": catalog.tables, "COLUMNS": catalog.columns, "TABLE_CONSTRAINTS": catalog.constraints,
             "KEY_COLUMN_USAGE": catalog.key_columns}
    asked = []

    def jdbc(self, url, table, predicates=None, properties=None):
        asked.append((table, predicates, properties))
        if table.startswith("INFORMATION_SCHEMA."):
            view = views[table.split(".")[1]].where("region = 'East US'").drop("region")
            wide = view.select(*[F.col(c).alias(c.upper()) for c in view.columns], F.lit("db").alias("TABLE_CATALOG"))
            return wide.withColumn("ORDINAL_POSITION", F.col("ORDINAL_POSITION").cast("smallint")) if "ORDINAL_POSITION" in wide.columns else wide
        return spark.range(3)

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    monkeypatch.setattr(DataFrameReader, "load", lambda self: spark.createDataFrame([(5, 6), (1, 2), (3, 4)], "y int, x int"))
    plan = P.build_plan(C.jdbc_catalog(spark, "East US", "jdbc:x", {"user": "u"}))
    assert plan.count() == 6 and len(asked) == 4
    JdbcSource(spark, "jdbc:x", {"user": "u"}, parts=3).scan(P.find_table(plan, "pair"))
    table, predicates, properties = asked[-1]
    assert table == '"my-schema"."pair"' and properties == {"user": "u"}
    assert predicates == [
        '(("y" < 3) OR ("y" = 3 AND "x" < 4))',
        'NOT (("y" < 3) OR ("y" = 3 AND "x" < 4)) AND (("y" < 5) OR ("y" = 5 AND "x" < 6))',
        'NOT (("y" < 5) OR ("y" = 5 AND "x" < 6))',
    ]
    text_key = P.find_table(plan, "pair").asDict(recursive=True)
    text_key["columns"] = [{**c, "logical_type": "STRING"} for c in text_key["columns"]]
    JdbcSource(spark, "jdbc:x", {"user": "u"}, parts=3).scan(text_key)
    assert asked[-1] == ('"my-schema"."pair"', hash_predicates(["y", "x"], 3), {"user": "u", "pushDownPredicate": "false"})
    JdbcSource(spark, "jdbc:x", {}, parts=3).scan(P.find_table(plan, "transactions_all"))
    assert asked[-1][1] == hash_predicates(["b"], 3)  # the other column is xml
    assert JdbcSource(spark, "jdbc:x", {}).parts == spark.sparkContext.defaultParallelism > 1


# What a database's checksum gives is not stated; any function of the columns that returns a number will do.
_CHECKSUM = """
create macro binary_checksum(a) as coalesce(hash(a)::hugeint - 9223372036854775808, null)::bigint,
    (a, b) as (hash(a, b)::hugeint - 9223372036854775808)::bigint, (a, b, c) as case when c is null then null else -abs(hash(a, b, c)::hugeint // 4) end
"""


@pytest.mark.parametrize("names", [["t"], ["g"], ["b"], ["t", "n"], ["t", "n", "d"]])
def test_hashed_parts_take_every_row_once(names):
    """Text in several cases, GUIDs, bytes, NULLs and times, asked of DuckDB as it would be of a database."""
    import duckdb

    db = duckdb.connect()
    db.execute(_CHECKSUM)
    db.execute("""create table s as select i, case i % 3 when 0 then upper('key' || i) when 1 then 'key' || i else 'Key' || i end as t,
        uuid() as g, encode('b' || i) as b, case when i % 4 > 0 then i % 7 end as n,
        case when i % 5 > 0 then timestamp '2024-01-01' + to_milliseconds(i * 1003) end as d from range(3000) r(i)""")
    parts = [db.execute(f"select i from s where {p}").fetchall() for p in hash_predicates(names, 6)]
    assert sorted(r for part in parts for r in part) == [(i,) for i in range(3000)]
    assert max(map(len, parts)) < 2000


def test_what_is_hashed():
    columns = [{"name": n, "source_type": k} for n, k in [("id", "NVARCHAR(20)"), ("note", "ntext"), ("x", "int"), ("r", "bigint")]]
    assert hashed_columns({"synthetic_key": False, "primary_key": ["id"], "columns": columns}) == ["id"]
    assert hashed_columns({"synthetic_key": True, "primary_key": ["r"], "columns": columns}) == ["id", "x"]


def test_key_literals_have_the_digits_of_their_source_type():
    import datetime as dt

    at = [(dt.datetime(2023, 5, 6, 7, 8, 9, 123000),), (dt.datetime(2024, 5, 6, 7, 8, 0),)]
    assert range_predicates(["k"], at, {"k": "datetime"})[0] == """(("k" < '2024-05-06T07:08:00.000'))"""
    assert range_predicates(["k"], at, {"k": "smalldatetime"})[0] == """(("k" < '2024-05-06T07:08:00'))"""
    assert range_predicates(["k"], at, {"k": "datetime2"})[0] == """(("k" < '2024-05-06 07:08:00'))"""
