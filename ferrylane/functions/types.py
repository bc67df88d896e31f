"""From source type names to Spark types, and casting rows to them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane.functions.keys import column

# Source type name -> logical type of the target column.
LOGICAL_TYPES = {
    "bigint": "INT64",
    "binary": "BYTES",
    "bit": "BOOL",
    "char": "STRING",
    "date": "DATE",
    "datetime": "TIMESTAMP",
    "datetime2": "TIMESTAMP",
    "datetimeoffset": "TIMESTAMP",
    "decimal": "NUMERIC",
    "float": "FLOAT64",
    "image": "BYTES",
    "int": "INT64",
    "money": "NUMERIC",
    "nchar": "STRING",
    "ntext": "STRING",
    "numeric": "NUMERIC",
    "nvarchar": "STRING",
    "real": "FLOAT64",
    "rowversion": "BYTES",
    "smalldatetime": "TIMESTAMP",
    "smallint": "INT64",
    "smallmoney": "NUMERIC",
    "text": "STRING",
    "time": "TIME",
    "timestamp": "BYTES",
    "tinyint": "INT64",
    "uniqueidentifier": "STRING",
    "varbinary": "BYTES",
    "varchar": "STRING",
}

# The widest decimal that still counts as NUMERIC.
NUMERIC_SCALE = 9
NUMERIC_INTEGER_DIGITS = 29

# Logical type -> Spark type; decimals keep their own precision and scale.
SPARK_TYPES = {
    "BOOL": "boolean",
    "BYTES": "binary",
    "DATE": "date",
    "FLOAT64": "double",
    "INT64": "bigint",
    "STRING": "string",
    "TIME": "time(6)",
    "TIMESTAMP": "timestamp",
}

MAX_DECIMAL_DIGITS = 38


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    literals = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*literals), key)


def base_type(source_type: Column) -> Column:
    """``varchar(50)`` -> ``varchar``."""
    return F.lower(F.trim(F.substring_index(source_type, "(", 1)))


def logical_type(source_type: Column, precision: Column, scale: Column) -> Column:
    """The target's logical type. Wide decimals are BIGNUMERIC, unknown types STRING."""
    mapped = F.coalesce(_lookup(LOGICAL_TYPES, base_type(source_type)), F.lit("STRING"))
    integer_digits = precision - F.coalesce(scale, F.lit(0))
    wide = F.coalesce(scale > NUMERIC_SCALE, F.lit(False)) | F.coalesce(
        integer_digits > NUMERIC_INTEGER_DIGITS, F.lit(False)
    )
    return F.when((mapped == "NUMERIC") & wide, "BIGNUMERIC").otherwise(mapped)


def spark_type(logical: Column, precision: Column, scale: Column) -> Column:
    """The Spark type, as DDL text, that holds a logical type."""
    known = precision.isNotNull() & scale.isNotNull()
    own_decimal = F.format_string("decimal(%d,%d)", precision, scale)
    default_decimal = F.lit(f"decimal({MAX_DECIMAL_DIGITS},{NUMERIC_SCALE})")
    decimal = F.when(known, own_decimal).otherwise(default_decimal)
    return F.when(logical.isin("NUMERIC", "BIGNUMERIC"), decimal).otherwise(_lookup(SPARK_TYPES, logical))


def with_target_types(
    columns: DataFrame, source_type: str = "data_type", precision: str = "numeric_precision", scale: str = "numeric_scale"
) -> DataFrame:
    """Add ``logical_type`` and ``spark_type`` to a frame of column descriptions."""
    p, s = F.col(precision), F.col(scale)
    typed = columns.withColumn("logical_type", logical_type(F.col(source_type), p, s))
    return typed.withColumn("spark_type", spark_type(F.col("logical_type"), p, s))


def struct_of(columns: Sequence[Any]) -> T.StructType:
    """A plan row's columns as a StructType."""
    return T.StructType([T.StructField(c["name"], T.DataType.fromDDL(c["spark_type"])) for c in columns])


# A number as text: sign, digits, digits behind the point, exponent.
_NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,4}))?\s*$"
# Digits that an exponent may add in front of the first one; with more the number is 0 to any scale.
_MAX_LEADING_ZEROS = 64


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _text_half_even(text: Column, target: T.DecimalType) -> Column:
    """Round a number by its digits: those kept, one step up or none, and no cast before that is decided.

    The step follows from the first digit dropped, the others, and the last one kept. Text
    that is no number, and a result that has too many digits, fail as casts do.
    """
    names = ("sign", "whole", "fraction", "exponent")
    matched = F.struct(*[F.regexp_extract(text, _NUMBER, i + 1).alias(name) for i, name in enumerate(names)])
    is_number = text.rlike(_NUMBER) & text.rlike(r"^[^eE]*\d")

    def placed(m: Column) -> Column:
        """The digits, and how many lie before the point once the exponent has moved it."""
        shift = F.when(m.exponent == "", 0).otherwise(m.exponent.try_cast("int"))
        place = (F.length(m.whole) + shift).cast("int")
        zeros = F.repeat(F.lit("0"), F.least(F.greatest(-place, F.lit(0)), F.lit(_MAX_LEADING_ZEROS)))
        digits = F.concat(zeros, m.whole, m.fraction)
        return F.struct(m.sign.alias("sign"), digits.alias("digits"), (F.greatest(place, F.lit(0)) + target.scale).alias("length"))

    def cut(p: Column) -> Column:
        return F.struct(p.sign.alias("sign"), F.rpad(p.digits, p.length, "0").alias("kept"), F.substr(p.digits, p.length + 1).alias("rest"))

    def stepped(c: Column) -> Column:
        half = F.rpad(F.lit("5"), F.greatest(F.length(c.rest), F.lit(1)), "0")
        odd = F.coalesce(F.right(c.kept, F.lit(1)).try_cast("int"), F.lit(0)) % 2 == 1
        up = F.coalesce((c.rest > half) | ((c.rest == half) & odd), F.lit(False)).cast("int")
        unscaled = F.concat(F.lit("0"), c.kept).cast(T.DecimalType(MAX_DECIMAL_DIGITS, 0)) + up.cast(T.DecimalType(1, 0))
        return F.struct(c.sign.alias("sign"), unscaled.cast("string").alias("digits"))

    def pointed(u: Column) -> Column:
        padded = F.lpad(u.digits, F.greatest(F.length(u.digits), F.lit(target.scale + 1)), "0")
        return F.concat(u.sign, F.substring(padded, 1, F.length(padded) - target.scale), F.lit("."), F.right(padded, F.lit(target.scale)))

    rounded = _with(_with(_with(_with(matched, placed), cut), stepped), pointed)
    return F.when(is_number, rounded).otherwise(text).cast(target)


def to_decimal_half_even(value: Column, source: T.DataType, target: T.DecimalType) -> Column:
    """Round half to even at the target's scale; NULL and NaN give NULL.

    Decimals round exactly as they are, text by its digits. Doubles are read as they print
    (Spark turns a double into a decimal by its shortest text), with guard digits so that the
    first cast never decides a tie: a double has at most 17 digits, so one too large for the guard
    digits has none left beyond the target's scale, and its cast is exact.
    """
    if isinstance(source, T.DecimalType):
        return F.bround(value, target.scale).cast(target)
    if isinstance(source, T.StringType):
        return _text_half_even(value, target)
    if isinstance(source, T.FloatType):
        value = value.cast("string").cast("double")
    if isinstance(source, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    guarded = min(target.scale + 20, MAX_DECIMAL_DIGITS - 1)
    exact = value.try_cast(T.DecimalType(MAX_DECIMAL_DIGITS, guarded))
    large = value.cast(T.DecimalType(MAX_DECIMAL_DIGITS, target.scale))
    return F.coalesce(F.bround(exact, target.scale).cast(target), large.cast(target))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types. A value that does not fit fails the job."""
    source = df.schema

    def cast(field: T.StructField) -> Column:
        value, have = column(field.name), source[field.name].dataType
        if isinstance(field.dataType, T.DecimalType):
            value = to_decimal_half_even(value, have, field.dataType)
        elif isinstance(field.dataType, T.TimeType) and isinstance(have, (T.TimestampType, T.TimestampNTZType)):
            # A database driver may hand a time of day over as a timestamp.
            value = F.date_format(value, "HH:mm:ss.SSSSSS").cast(field.dataType)
        elif have != field.dataType:
            value = value.cast(field.dataType)
        return value.alias(field.name)

    return df.select([cast(f) for f in schema.fields])
