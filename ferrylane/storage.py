"""Path helpers and a table whose rewrites never touch the files being read."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrylane.session import local_frame


def path_segment(name: str) -> str:
    """A table or schema name as one safe path segment, without collisions."""
    return re.sub(r"[^A-Za-z0-9_. -]", lambda m: f"~{ord(m.group()):02X}", name)


def join_path(*segments: str | None) -> str:
    return "/".join(s.rstrip("/") for s in segments if s)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


# Spark leaves its success marker whatever the cluster's default is.
MARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` finished (its success marker is there)."""
    return exists(spark, join_path(path, "_SUCCESS"))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _filesystem(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders right below ``path``."""
    return [name for name, is_folder in _listed(spark, path) if is_folder]


def qualified(spark: SparkSession, path: str) -> str:
    """The path as file scans name it, with one slash after the scheme."""
    fs, p = _filesystem(spark, path)
    return re.sub(r"^([A-Za-z0-9+.-]+):/+", r"\1:/", fs.makeQualified(p).toUri().toString())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _filesystem(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there as a whole or not at all."""
    fs, p = _filesystem(spark, path)
    half = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    stream = fs.create(half, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(half, p):
        raise OSError(f"{path} was not written")


#: How the types of the control tables are written without Spark.
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}


def append_rows(spark: SparkSession, path: str, rows: Sequence[Mapping[str, Any]], ddl: str) -> None:
    """A handful of rows as one more Parquet file of a folder, there as a whole or not at all, without a job."""
    fields = [column.split() for column in ddl.split(", ")]
    table = pa.Table.from_pylist(list(rows), pa.schema([pa.field(name, _ARROW[kind]) for name, kind, *_ in fields]))
    sink = pa.BufferOutputStream()
    parquet.write_table(table, sink, compression="snappy")
    name = f"part-{uuid.uuid4().hex}.parquet"
    fs, p = _filesystem(spark, join_path(path, name))
    half = spark._jvm.org.apache.hadoop.fs.Path(join_path(path, f"_{name}"))  # scans pass over it
    stream = fs.create(half, True)
    try:
        stream.write(bytearray(sink.getvalue().to_pybytes()))
    finally:
        stream.close()
    if not fs.rename(half, p):
        raise OSError(f"{p} was not written")


def files(spark: SparkSession, path: str) -> list[str]:
    """The names of the files right below ``path``."""
    return [name for name, is_folder in _listed(spark, path) if not is_folder]


def _listed(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """The names right below ``path``, and whether they are folders, in a few calls to the JVM however many there are."""
    fs, p = _filesystem(spark, path)
    if not fs.exists(p):
        return []
    found = fs.listStatus(p)
    objects = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Object, len(found))
    spark._jvm.java.lang.System.arraycopy(found, 0, objects, 0, len(found))
    lines = spark._jvm.org.apache.commons.lang3.StringUtils.join(objects, "\n").split("\n") if len(found) else []
    told = [re.match(r"\w+\{path=(.*); isDirectory=(true|false);", line) for line in lines]
    if len(told) == len(found) and all(told):
        return [(t[1].rsplit("/", 1)[-1], t[2] == "true") for t in told]
    # A file system that words them otherwise, or names with line breaks.
    return [(status.getPath().getName(), status.isDirectory()) for status in found]


def files_below(spark: SparkSession, path: str) -> list[str]:
    """All data files below ``path``; names that scans pass over are left out, folders too."""
    fs, p = _filesystem(spark, path)
    found, folders_left = [], [p] if fs.exists(p) else []
    while folders_left:
        for status in fs.listStatus(folders_left.pop()):
            if status.getPath().getName()[0] in "_.":
                continue
            if status.isDirectory():
                folders_left.append(status.getPath())
            else:
                found.append(status.getPath().toString())
    return sorted(found)


def delete_files(spark: SparkSession, paths: Iterable[str], below: str) -> None:
    """Delete files, and the folders up to ``below`` that are left without any."""
    fs, end = _filesystem(spark, below)
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs.delete(p, False)
        folder = p.getParent()
        while folder.depth() > end.depth() and fs.exists(folder) and not any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder)):
            fs.delete(folder, True)
            folder = folder.getParent()


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _filesystem(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def _column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass
class ShownColumns:
    """What a version shows of its files: file columns that are hidden, and those shown under another name."""

    hidden: list[str] = field(default_factory=list)
    stored: dict[str, str] = field(default_factory=dict)

    def file_column(self, name: str) -> str | None:
        """The file column behind a shown one; None where only hidden ones have that name."""
        column = self.stored.get(name.lower(), name)
        return None if column.lower() in self.hidden else column

    def shown_as(self, column: str) -> str | None:
        for name, stored in self.stored.items():
            if stored.lower() == column.lower():
                return name
        return None if column.lower() in self.hidden else column


class VersionedTable:
    """A Parquet table stored as ``<path>/v=<n>``; readers see the newest finished version.

    Which columns a version shows is written beside its files, so that dropping a column, and adding one of the same name
    later, writes no data file. Readers go through ``read``: the files keep what they were written with.

    Appends go into the current version. A rewrite fills the next version and
    becomes visible only once Spark has committed it, so a query may read the
    table it replaces and a run that dies half way leaves the old version in place.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _versions(self) -> list[int]:
        return sorted(int(n[2:]) for n in folders(self.spark, self.path) if re.fullmatch(r"v=\d+", n))

    def _version_path(self, version: int) -> str:
        return join_path(self.path, f"v={version}")

    def current_path(self) -> str | None:
        for version in reversed(self._versions()):
            path = self._version_path(version)
            if committed(self.spark, path):
                return path
        return None

    def exists(self) -> bool:
        return self.current_path() is not None

    def read(self, schema: T.StructType | str | None = None) -> DataFrame:
        """The current rows; with a schema, columns the files lack read as NULL."""
        path = self.current_path()
        if path is None:
            raise FileNotFoundError(f"no finished version under {self.path}")
        if schema is None:
            shown, rows = self._shown(path), self.spark.read.parquet(path)
            names = {c: shown.shown_as(c) for c in rows.columns}
            return rows if all(c == n for c, n in names.items()) else rows.select(
                *[_column(c).alias(n) for c, n in names.items() if n is not None])
        return self._as_shown(path, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema, [path])

    def _as_shown(self, path: str, wanted: T.StructType, paths: list[str]) -> DataFrame:
        shown = self._shown(path)
        behind = {f.name: shown.file_column(f.name) for f in wanted.fields}
        stored = T.StructType([T.StructField(behind[f.name], f.dataType) for f in wanted.fields if behind[f.name] is not None])
        rows = self.spark.read.schema(stored).parquet(*paths)
        if rows.columns == wanted.names:
            return rows
        return rows.select(*[(F.lit(None).cast(f.dataType) if behind[f.name] is None else _column(behind[f.name])).alias(f.name) for f in wanted.fields])

    def index_files(self, key: str, at_least: int = 1) -> int:
        """Note the smallest and largest ``key`` of each file that has not been looked at, once there are ``at_least`` such.

        One job over the key column of those files alone. Returns how many there were.
        """
        path = self.current_path()
        column, index = self._shown(path).file_column(key), self._index_path(path, key)
        if column is None:
            return 0
        noted = self._indexed(index)
        fresh = [f for f in self._data_files(path) if f not in noted]
        if len(fresh) < max(1, at_least):
            return 0
        # Files from before the column came back lack it.
        rows = self.spark.read.option("mergeSchema", True).parquet(*[join_path(path, f) for f in fresh])
        if column.lower() not in map(str.lower, rows.columns):
            return 0
        ranges = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(_column(column)).alias("low"), F.max(_column(column)).alias("high"))
        # Empty files give no row, and would be looked at again each time.
        named = local_frame(self.spark, [{"name": f} for f in fresh], "name string").coalesce(1)
        named.join(ranges, F.col("name") == F.col("file"), "left").select("name", "low", "high").write.mode("append").parquet(index)
        return len(fresh)

    def read_within(self, schema: T.StructType, key: str, low: Column, high: Column) -> DataFrame:
        """The rows of the files that can hold a ``key`` from ``low`` to ``high``: those noted to, and those not noted yet.

        Other rows of those files are among them; NULL keys may be missing.
        """
        path = self.current_path()
        index = self._index_path(path, key)
        if not exists(self.spark, index):
            return self.read(schema)
        outside = self.spark.read.parquet(index).where(F.col("low").isNull() | (F.col("high") < low) | (F.col("low") > high))
        passed = {r["name"] for r in outside.select("name").collect()}
        wanted = [join_path(path, f) for f in self._data_files(path) if f not in passed]
        return self._as_shown(path, schema, wanted) if wanted else self.spark.createDataFrame([], schema)

    def _index_path(self, path: str, key: str) -> str:
        # A column that was dropped and came back is another one, and has an index of its own.
        return join_path(path, "_key_files", path_segment(self._shown(path).file_column(key) or "~"))

    def _data_files(self, path: str) -> list[str]:
        return [f for f in files(self.spark, path) if f[0] not in "_."]

    def _indexed(self, index: str) -> set[str]:
        if not exists(self.spark, index):
            return set()
        return {r["name"] for r in self.spark.read.schema("name string").parquet(index).collect()}

    def _shown(self, path: str) -> ShownColumns:
        """What was last written about the columns of a version; each change is a file of its own."""
        folder = join_path(path, "_columns")
        changes = sorted(name for name in files(self.spark, folder) if name.endswith(".json"))
        return ShownColumns(**json.loads(read_text(self.spark, join_path(folder, changes[-1])))) if changes else ShownColumns()

    def _show(self, path: str, shown: ShownColumns) -> None:
        folder = join_path(path, "_columns")
        number = 1 + sum(name.endswith(".json") for name in files(self.spark, folder))
        write_text(self.spark, join_path(folder, f"{number:06d}.json"), json.dumps({"hidden": shown.hidden, "stored": shown.stored}))

    def has_column(self, column: str) -> bool:
        """Whether any file has it and it is shown. Files differ, so all footers are looked at."""
        path = self.current_path()
        stored = self._shown(path).file_column(column)
        if stored is None:
            return False
        return stored.lower() in map(str.lower, self.spark.read.option("mergeSchema", True).parquet(path).columns)

    def hide_column(self, column: str) -> None:
        """The column is gone for readers. No data file is written; rows appended with it later show it as a new one."""
        path = self.current_path()
        shown = self._shown(path)
        shown.hidden.append((shown.stored.pop(column.lower(), column)).lower())
        self._show(path, shown)

    def row_count(self) -> int | None:
        """Rows in the table, or None when it cannot be read."""
        try:
            return self.read().count()
        except Exception:
            return None

    def create(self, schema: T.StructType | str) -> "VersionedTable":
        """Make an empty table unless one is there already."""
        if not self.exists():
            self.replace(self.spark.createDataFrame([], schema))
        return self

    def append(self, df: DataFrame) -> None:
        path = self.current_path() or self._version_path(1)
        shown = self._shown(path)
        again = [c for c in df.columns if shown.file_column(c) is None]
        for c in again:
            shown.stored[c.lower()] = f"{c}__{len(shown.hidden) + 1}"
        if again:
            self._show(path, shown)
        stored = [shown.file_column(c) for c in df.columns]
        if stored != df.columns:
            df = df.select(*[_column(c).alias(s) for c, s in zip(df.columns, stored)])
        df.write.mode("append").options(**MARKED).parquet(path)

    def replace(self, df: DataFrame) -> str:
        """Write ``df`` as the next version and return its path.

        The version it replaces stays for queries that are reading it; older ones go.
        """
        replaced, versions = self.current_path(), self._versions()
        path = self._version_path(versions[-1] + 1 if versions else 1)
        df.write.mode("overwrite").options(**MARKED).parquet(path)
        for version in versions:
            if self._version_path(version) != replaced:
                delete(self.spark, self._version_path(version))
        return path
