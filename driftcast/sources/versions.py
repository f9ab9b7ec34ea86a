"""Versioned tables on shared storage: immutable data folders, and a version
file made last (A12, H7, J1).

    <table>/data/write=<id>/<partition folders>/*.parquet   written once, never changed
    <table>/versions/<number>.json                          which folders hold each partition

A write puts new files beside the old ones; the table changes when the next
version file gets its name, in one rename. A job that dies before leaves the old
version as it was; a reader keeps the version it began with; two writers of one
version are told apart by the rename, which fails for the second. ``vacuum``
removes what no kept version names.

Data are dealt by a rebalance on the partition columns: many tasks write a
partition that holds a third of the rows, small ones share a task, and the
number of files follows the bytes (``spark.sql.adaptive.
advisoryPartitionSizeInBytes``, ``WRITE_BYTES`` at most), never a fixed count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Shuffled bytes that one task sorts and writes. The rows of a year of one
# commune are much alike and take a few bytes each in a shuffle, twenty times
# as much in a sort: at Spark's 64 MB a task would sort some ten million rows
# and spill them.
WRITE_BYTES = 8 * 2**20


@dataclass(frozen=True)
class Version:
    """``parts``: partition folder -> ids of the writes that hold its rows."""
    number: int
    schema: T.StructType
    by: tuple[str, ...]
    parts: dict[str, tuple[str, ...]]


@dataclass(frozen=True)
class Written:
    """One finished write: its id and the partition folders it made."""
    id: str
    schema: T.StructType
    parts: tuple[str, ...]


class _Files:
    """The table's file system (that of its path)."""

    def __init__(self, spark: SparkSession, table: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = table.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, pattern: str) -> list[str]:
        """Paths below the table that match, relative to it."""
        found = self.fs.globStatus(self.path(pattern)) or []
        depth = pattern.count("/") + 1
        return sorted("/".join(s.getPath().toString().split("/")[-depth:]) for s in found)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """A file that appears whole, under a name that must be new."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        out = self.fs.create(draft)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = SparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE  # an existing name is an error
        context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self.path(name)), options)


def version_numbers(spark: SparkSession, table: str) -> list[int]:
    """The versions that are there, oldest first. A folder with other files
    and no version is an error, not an empty table."""
    files = _Files(spark, table)
    found = sorted(int(n.split("/")[1].split(".")[0]) for n in files.names("versions/*.json"))
    if not found and [n for n in files.names("*") if n not in ("data", "versions")]:
        raise ValueError(f"{table} is not a versioned table")
    return found


def current(spark: SparkSession, table: str, number: int | None = None) -> Version | None:
    """The newest version (or one by number); None for a table not yet there."""
    numbers = version_numbers(spark, table)
    if not numbers:
        return None
    number = numbers[-1] if number is None else number
    said = json.loads(_Files(spark, table).read(_name(number)))
    return Version(number, T.StructType.fromJson(said["schema"]), tuple(said["by"]),
                   {p: tuple(w) for p, w in said["parts"].items()})


def _name(number: int) -> str:
    return f"versions/{number:012d}.json"


@contextmanager
def _small_writes(spark: SparkSession) -> Iterator[None]:
    """The advisory size is ``WRITE_BYTES``, where it is not less already."""
    before = spark.conf.get(ADVISORY, None)
    unit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if before is not None and unit(before) <= WRITE_BYTES:
        yield
        return
    spark.conf.set(ADVISORY, str(WRITE_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ADVISORY)
        else:
            spark.conf.set(ADVISORY, before)


def write(spark: SparkSession, df: DataFrame, table: str, by: list[str], order: list[str]) -> Written:
    """``df`` in new files of the table, sorted by ``order`` in each. No
    version names them yet."""
    name = f"write={uuid.uuid4().hex}"
    with _small_writes(spark):
        (df.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by, *order)
         .write.partitionBy(*by).parquet(f"{table.rstrip('/')}/data/{name}"))
    made = _Files(spark, table).names("/".join(["data", name, *[f"{c}=*" for c in by]]))
    return Written(name, df.schema, tuple(p.split("/", 2)[2] for p in made))


def successor(base: Version | None, by: list[str], schema: T.StructType, parts: dict[str, tuple[str, ...]]) -> Version:
    """The version after ``base``: its partitions, with ``parts`` in place of
    those of the same name. It can be read before it is committed."""
    return Version((base.number if base else 0) + 1, _merged(base.schema, schema) if base else schema, tuple(by),
                   {**(base.parts if base else {}), **parts})


def commit(spark: SparkSession, table: str, version: Version) -> None:
    """The swap: the version gets its name, or this raises because another
    writer was faster."""
    _Files(spark, table).publish(_name(version.number), json.dumps(
        {"schema": json.loads(version.schema.json()), "by": version.by, "parts": version.parts}))


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """All columns of both; those of one side are null in the other's rows."""
    return T.StructType([*old.fields, *[f for f in new.fields if f.name not in old.names]])


def read(spark: SparkSession, table: str, version: Version | None = None, parts: list[str] | None = None) -> DataFrame:
    """The rows of a version (the newest one), or of some of its partitions.
    Partition columns are columns; predicates on them prune folders."""
    version = version or current(spark, table)
    if version is None:
        raise FileNotFoundError(f"no version of {table}")
    wanted = version.parts if parts is None else {p: version.parts[p] for p in parts}
    return _read(spark, table, version.schema, {(w, p) for p, writes in wanted.items() for w in writes})


def read_written(spark: SparkSession, table: str, written: Written) -> DataFrame:
    """The rows of one write."""
    return _read(spark, table, written.schema, {(written.id, p) for p in written.parts})


def _read(spark: SparkSession, table: str, schema: T.StructType, folders: set[tuple[str, str]]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{table.rstrip('/')}/data"
    fields = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField("write", T.StringType())])
    return (spark.read.schema(fields).option("basePath", base).parquet(*sorted(f"{base}/{w}/{p}" for w, p in folders))
            .drop("write").select(*schema.names))


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Removes the version files before the last ``keep`` and the writes that
    only they name; returns the writes. Not to be run beside a writer, whose
    files no version names yet."""
    files = _Files(spark, table)
    numbers = version_numbers(spark, table)
    kept = {w for n in numbers[-keep:] for writes in current(spark, table, n).parts.values() for w in writes}
    for n in numbers[:-keep]:
        files.fs.delete(files.path(_name(n)), False)
    gone = [name.split("/")[1] for name in files.names("data/write=*") if name.split("/")[1] not in kept]
    for w in gone:
        files.fs.delete(files.path(f"data/{w}"), True)
    return gone
