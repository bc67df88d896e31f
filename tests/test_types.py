"""Type rule and conforming rows to it."""

from decimal import ROUND_HALF_EVEN, Context, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane.functions.types import conform, struct_of, with_target_types

# Every source type by what it becomes, and the decimal rule at both its limits (scale 9, 29 integer digits).
BY_LOGICAL = {
    "STRING": ["char", "nchar", "ntext", "nvarchar", "text", "uniqueidentifier", "varchar"],
    "INT64": ["bigint", "int", "smallint", "tinyint"],
    "BYTES": ["binary", "image", "rowversion", "timestamp", "varbinary"],
    "TIMESTAMP": ["datetime", "datetime2", "datetimeoffset", "smalldatetime"],
    "BOOL": ["bit"], "DATE": ["date"], "TIME": ["time"], "FLOAT64": ["float", "real"],
}
SPARK = {"STRING": "string", "INT64": "bigint", "BYTES": "binary", "TIMESTAMP": "timestamp", "BOOL": "boolean",
         "DATE": "date", "TIME": "time(6)", "FLOAT64": "double"}
DECIMALS = ["decimal", "numeric", "money", "smallmoney"]
CASES = [
    *[(spelled, None, None, logical, SPARK[logical]) for logical, names in BY_LOGICAL.items() for name in names
      for spelled in (name, f" {name.upper()}(7) ")],
    ("sql_variant", None, None, "STRING", "string"),
    *[(name, whole + scale, scale, "NUMERIC" if scale <= 9 and whole <= 29 else "BIGNUMERIC", f"decimal({whole + scale},{scale})")
      for name in DECIMALS for whole in (1, 28, 29, 30) for scale in (0, 8, 9, 10) if whole + scale <= 38],
    *[(name, None, None, "NUMERIC", "decimal(38,9)") for name in DECIMALS],
]


def test_type_rule(spark):
    rows = [(i, *case[:3]) for i, case in enumerate(CASES)]
    columns = spark.createDataFrame(rows, "i int, data_type string, numeric_precision int, numeric_scale int")
    got = with_target_types(columns).orderBy("i").select("logical_type", "spark_type").collect()
    assert [tuple(r) for r in got] == [case[3:] for case in CASES]


def test_struct_of_a_plan_row(spark):
    columns = [{"name": "a b", "spark_type": "bigint"}, {"name": "t", "spark_type": "time(6)"}]
    assert struct_of(columns).simpleString() == "struct<a b:bigint,t:time(6)>"


def decimals(spark, values, source, target):
    df = spark.createDataFrame([(v,) for v in values], "v " + ("string" if source.startswith("decimal") else source))
    df = df.select(F.col("v").cast(source))
    return [r[0] for r in conform(df, T.StructType.fromDDL(f"v {target}")).collect()]


def half_even(values, scale):
    return [None if v is None else Decimal(str(v)).quantize(Decimal(1).scaleb(-scale)) for v in values]


@pytest.mark.parametrize("scale", [0, 1, 2, 4, 9])
def test_doubles_round_half_to_even_by_their_text(spark, scale):
    values = [2.345, 2.355, 0.125, 0.375, -2.5, 0.5, 1.5, 1e-10, 5e-10, 0.12500000000000003, 123456789.015,
              12345678901234.125, 1e15 + 0.5, 0.05, 2.675, -0.045, 99999999.99, 3.0, None]
    assert decimals(spark, values, "double", f"decimal(38,{scale})") == half_even(values, scale)


def test_nan_is_null(spark):
    assert decimals(spark, [float("nan")], "double", "decimal(10,2)") == [None]


def test_decimals_round_exactly(spark):
    values = ["12345678901234567890.12345", "0.00005", "0.00015", "-0.00025"]
    assert decimals(spark, values, "decimal(38,5)", "decimal(38,4)") == half_even(values, 4)


def test_wide_decimals_survive(spark):
    value = "12345678901234567890123456789.123456789"
    assert decimals(spark, [value], "decimal(38,9)", "decimal(38,9)") == [Decimal(value)]


def test_integers_with_nulls_stay_integers(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    out = conform(df, T.StructType.fromDDL("v bigint"))
    assert out.dtypes == [("v", "bigint")] and [r[0] for r in out.collect()] == [1, None]


@pytest.mark.parametrize("value, target", [("x", "bigint"), ("x", "decimal(5,2)"), ("123456", "decimal(5,2)"), ("no", "date")])
def test_a_value_that_does_not_fit_fails(spark, value, target):
    df = spark.createDataFrame([(value,)], "v string")
    with pytest.raises(Exception):
        conform(df, T.StructType.fromDDL(f"v {target}")).collect()


def test_conform_orders_columns_and_drops_others(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "x int, y string, z double")
    assert conform(df, T.StructType.fromDDL("z decimal(5,1), x bigint")).columns == ["z", "x"]


def test_time_round_trips_through_parquet(spark, tmp_path):
    df = spark.sql("select '12:34:56.789012' as v")
    conform(df, T.StructType.fromDDL("v time(6)")).write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.select(F.col("v").cast("string")).first()[0] == "12:34:56.789012"


def quantized(text, scale):
    with localcontext(Context(prec=80)):
        return Decimal(text).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_EVEN)


@pytest.mark.parametrize("text, scale, expected", [
    ("12345678901234567.125", 2, "12345678901234567.12"), ("1234567890.0000000005", 9, "1234567890.000000000"),
    ("1234567890.0000000015", 9, "1234567890.000000002"), ("-.5", 0, "0"), ("+1.5E0", 0, "2"), ("25e-1", 0, "2"), ("  7. ", 1, "7.0")])
def test_text_rounds_by_its_digits_at_any_size(spark, text, scale, expected):
    assert decimals(spark, [text], "string", f"decimal(38,{scale})") == [Decimal(expected)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    numbers=st.lists(st.tuples(st.sampled_from(["", "-", "+"]), st.text("0123456789", max_size=28), st.text("0459", max_size=30),
                               st.one_of(st.none(), st.integers(-45, 5))), min_size=1, max_size=40),
    scale=st.integers(0, 5),
)
def test_text_agrees_with_exact_rounding(spark, numbers, scale):
    texts = [f"{sign}{whole}.{fraction}" + ("" if e is None else f"e{e}") for sign, whole, fraction, e in numbers if whole + fraction]
    assert decimals(spark, texts, "string", f"decimal(38,{scale})") == [quantized(t, scale) for t in texts]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_a_time_may_come_as_a_timestamp(spark, kind):
    df = spark.sql(f"select cast('2001-02-03 23:59:58.000007' as {kind}) as v union all select null")
    got = conform(df, T.StructType.fromDDL("v time(6)")).select(F.col("v").cast("string")).collect()
    assert {r[0] for r in got} == {"23:59:58.000007", None}
