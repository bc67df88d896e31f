"""Scan predicates: strictly after a key, up to a cutoff, and both together."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# By default JSON timestamps lose everything below a millisecond.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


class MissingCutoffColumn(ValueError):
    """A cutoff was asked for on a table without the cutoff column."""


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(names: Iterable[str]) -> list[Column]:
    return [column(name) for name in names]


def key_to_json(key: Column | str) -> Column:
    """A struct of key columns as JSON text."""
    return F.to_json(key, JSON_OPTIONS)


def key_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(k, schema[k].dataType) for k in keys])


def key_from_json(text: str | Column, schema: T.StructType) -> dict[str, Column]:
    """Typed key values out of JSON text. A literal text folds to plain literals."""
    text = F.lit(text) if isinstance(text, str) else text
    decoded = F.from_json(text, schema, JSON_OPTIONS)
    return {f.name: decoded.getField(f.name) for f in schema.fields}


def typed_literal(value: Any, data_type: T.DataType) -> Column:
    """A literal of the column's own type, so that the comparison needs no cast
    on the column and can be pushed into the scan."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc)
            if isinstance(data_type, T.TimestampNTZType):
                value = value.replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast(data_type)


def after_key(schema: T.StructType, keys: Sequence[str], last: Mapping[str, Any] | None) -> Column | None:
    """Rows strictly after ``last`` in lexicographic key order.

    Written as an OR of prefix-equal clauses: each comparison reaches the
    source as a filter, which a comparison of two structs would not.
    """
    if not last:
        return None
    bound = {k: typed_literal(last[k], schema[k].dataType) for k in keys}
    clauses = []
    for i, key in enumerate(keys):
        same_prefix = [column(k) == bound[k] for k in keys[:i]]
        clauses.append(reduce(Column.__and__, [*same_prefix, column(key) > bound[key]]))
    return reduce(Column.__or__, clauses)


def cutoff_bound(cutoff: Any) -> tuple[str, Any]:
    """How a cutoff compares: ``("<", next midnight)`` for a whole day, else ``("<=", value)``."""
    if isinstance(cutoff, str):
        text = cutoff.strip()
        day_only = len(text) == len("YYYY-MM-DD")
        try:
            cutoff = dt.date.fromisoformat(text) if day_only else dt.datetime.fromisoformat(text)
        except ValueError:
            return "<=", text
    if isinstance(cutoff, dt.date) and not isinstance(cutoff, dt.datetime):
        midnight = dt.datetime(cutoff.year, cutoff.month, cutoff.day)
        return "<", midnight + dt.timedelta(days=1)
    return "<=", cutoff


def until_cutoff(schema: T.StructType, name: str, cutoff: Any) -> Column | None:
    """Rows last changed at or before the cutoff; a NULL change time is left out."""
    if cutoff is None or cutoff == "":
        return None
    if name not in schema.names:
        raise MissingCutoffColumn(f"cutoff {cutoff!r} needs a column {name!r}; found {schema.names}")
    operator, value = cutoff_bound(cutoff)
    bound = typed_literal(value, schema[name].dataType)
    return column(name) < bound if operator == "<" else column(name) <= bound


def scan_filter(
    schema: T.StructType,
    keys: Sequence[str],
    last: Mapping[str, Any] | None = None,
    cutoff: Any = None,
    cutoff_column: str = "updatedAt",
) -> Column | None:
    """Both predicates, or None when the whole table is wanted."""
    parts = [after_key(schema, keys, last), until_cutoff(schema, cutoff_column, cutoff)]
    parts = [p for p in parts if p is not None]
    return reduce(Column.__and__, parts) if parts else None
