"""Published tables of a folder: one manifest names the parts of all of them.

A procedure writes each table to a folder of its own, where no reader looks. At its
end one manifest file makes all of them the current ones at once; a run that fails
before leaves the tables of the run before. A manifest is created under the next
number, which fails if another run took it, so two runs cannot undo each other.

The manifest is also the ledger of the runs: a run under an id that was committed
changes nothing, so a repeated append leaves its rows there once.

A table may be kept by groups of a text key: each group has a folder in each
version that changed it, and a refresh reads and writes those groups alone that it
touches. The manifest then names one folder for each group, so there must be few
enough values of the key to list them (customer price groups, not part numbers).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillprice.functions.collation import BINARY, IGNORE_CASE, IGNORE_CASE_AND_TRAILING_BLANKS

_FOLDER, _DIGITS = "_manifest", 12
# Folder levels of a table kept by groups: version=<id>/group=<value>.
_VERSION, _GROUP = "__version", "__group"
# Collations under which equal values always share the folder that ``_group_of`` names.
_GROUPED = (BINARY, "UTF8_BINARY", "UTF8_BINARY_RTRIM", IGNORE_CASE, IGNORE_CASE_AND_TRAILING_BLANKS)


class ConcurrentRun(RuntimeError):
    """Another run was committed since this one began."""


class _Files:
    """The few file operations that manifests need, in whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{_FOLDER}")
        self.fs = self.root.getFileSystem(self.conf)

    def numbers(self) -> list[int]:
        if not self.fs.exists(self.root):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.root)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._path(f"{number:0{_DIGITS}}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, number: int, content: dict) -> None:
        """Whole or not at all: written aside, then moved to a name that must be free."""
        self.fs.mkdirs(self.root)
        aside, target = self._path(f".{uuid.uuid4().hex}"), self._path(f"{number:0{_DIGITS}}.json")
        out = self.fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        none = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        none[0] = rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf).rename(aside, target, none)
        except Py4JJavaError as failed:
            if "FileAlreadyExists" not in str(failed.java_exception):
                raise
            self.fs.delete(aside, False)
            raise ConcurrentRun(f"manifest {number} of {self.root} was written by another run") from failed


def current(spark: SparkSession, root: str) -> dict:
    """The last manifest: ``number``, ``tables`` (name -> parts), ``runs`` (id -> tables it changed)
    and ``groups`` (name of a table kept by groups -> its schema and key)."""
    files = _Files(spark, root)
    numbers = files.numbers()
    empty = {"number": 0, "tables": {}, "runs": {}, "groups": {}}
    return empty | files.read(numbers[-1]) | {"number": numbers[-1]} if numbers else empty


def _load(spark: SparkSession, root: str, parts: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{root.rstrip('/')}/{p}" for p in parts])


def _load_groups(spark: SparkSession, root: str, name: str, parts: list[str], layout: dict) -> DataFrame:
    """The rows of some groups of a table; its schema is that of the manifest, so there may be none."""
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    if not parts:
        return spark.createDataFrame([], schema)
    root = root.rstrip("/")
    read = spark.read.schema(schema).option("basePath", f"{root}/{name}")
    return read.parquet(*[f"{root}/{p}" for p in parts]).select(*[F.col(f"`{c}`") for c in schema.names])


def _group_of(key: Column) -> Column:
    """The folder of a value: values that differ in case or trailing blanks alone share one; NULL has its own."""
    text = F.translate(F.lower(F.rtrim(F.collate(key, "UTF8_BINARY"))), "\u03c2", "\u03c3")   # final sigma as sigma
    return F.coalesce(F.concat(F.lit("g"), text), F.lit("null"))


def _part_group(part: str) -> str:
    return unquote(part.rsplit("/", 1)[1].split("=", 1)[1])


def published(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The current version of a table, or None."""
    manifest = current(spark, root)
    parts = manifest["tables"].get(name)
    if name in manifest["groups"]:
        return _load_groups(spark, root, name, parts, manifest["groups"][name])
    return _load(spark, root, parts) if parts else None


class Run:
    """One run of a procedure under ``root``; ``publish`` and ``append`` stage, ``commit`` makes all current.

    ``done``: a run of this id was committed before. It then stages and commits
    nothing, and ``publish`` and ``append`` return the tables as they are.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id or uuid.uuid4().hex
        self.base = current(spark, root)
        self.done = self.run_id in self.base["runs"]
        self.staged: dict[str, list[str]] = {}
        self.groups: dict[str, dict] = {}

    def _write(self, df: DataFrame, name: str) -> str:
        part = f"{name}/{self.run_id}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.root}/{part}")
        return part

    def _parts(self, name: str) -> list[str]:
        return self.staged.get(name, self.base["tables"].get(name, []))

    def _layout(self, name: str) -> dict | None:
        """Schema and key of a table kept by groups, None for a table of whole parts."""
        return self.groups.get(name) if name in self.staged else self.base["groups"].get(name)

    def _table(self, name: str) -> DataFrame:
        layout = self._layout(name)
        if layout:
            return _load_groups(self.spark, self.root, name, self._parts(name), layout)
        return _load(self.spark, self.root, self._parts(name))

    def publish(self, df: DataFrame, name: str) -> DataFrame:
        """Stages a new version of the whole table, and returns it read back."""
        if not self.done:
            self.staged[name] = [self._write(df, name)]
            self.groups.pop(name, None)
        return self._table(name)

    def append(self, df: DataFrame, name: str) -> DataFrame:
        """Stages rows to be added to the table, and returns it read back with them."""
        if not self.done:
            if self._layout(name):
                raise ValueError(f"{name} is kept by groups: refresh_groups adds rows to it")
            self.staged[name] = [*self._parts(name), self._write(df, name)]
        return self._table(name)

    def refresh_groups(self, name: str, key: str, initial: DataFrame, touched: DataFrame,
                       refresh: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Stages ``refresh`` of those groups of a table that ``touched`` holds; returns the whole table.

        ``refresh`` gets the rows of those groups and returns their new rows; it must be
        one that changes no row of another group. The other groups are neither read nor
        written. ``touched`` has one column, of key values; the groups it names, as many
        as the refresh writes folders, are what the driver gets. Where the table is not
        kept by groups yet, ``initial`` is the table before, and all of it is written.
        """
        if self.done:
            return self._table(name)
        layout = self._layout(name)
        if layout is None:
            old, rest = initial, []
        else:
            if layout["key"] != key:
                raise ValueError(f"{name} is kept by {layout['key']}, not by {key}")
            names = {r[0] for r in touched.select(_group_of(F.col(touched.columns[0]))).distinct().collect()}
            parts = self._parts(name)
            rest = [p for p in parts if _part_group(p) not in names]
            old = _load_groups(self.spark, self.root, name, [p for p in parts if _part_group(p) in names], layout)
        new = refresh(old)
        kind = new.schema[key].dataType
        if not isinstance(kind, T.StringType) or kind.collation not in _GROUPED:
            raise ValueError(f"{key} is {kind.simpleString()}: groups are of text, compared by bytes or without case")
        version = f"{name}/{_VERSION}=v{uuid.uuid4().hex}"
        # Rows of a group go to few files; a group with much of the table is split over tasks.
        (new.withColumn(_GROUP, _group_of(F.col(key))).hint("rebalance", _GROUP)
            .write.partitionBy(_GROUP).mode("errorifexists").parquet(f"{self.root}/{version}"))
        self.staged[name] = rest + [f"{version}/{folder}" for folder in self._folders(version)]
        self.groups[name] = {"key": key, "schema": new.schema.json()}
        return self._table(name)

    def _folders(self, version: str) -> list[str]:
        files = _Files(self.spark, self.root)
        where = files.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{version}")
        names = [s.getPath().getName() for s in files.fs.listStatus(where) if s.isDirectory()]
        return sorted(n for n in names if n.startswith(f"{_GROUP}="))

    def commit(self) -> dict:
        """Makes everything staged current in one step."""
        if self.done:
            return self.base
        number = self.base["number"] + 1
        # A table that this run replaced whole is kept by groups no longer.
        layouts = {n: g for n, g in self.base["groups"].items() if n not in self.staged} | self.groups
        manifest = {"tables": self.base["tables"] | self.staged, "groups": layouts,
                    "runs": self.base["runs"] | {self.run_id: sorted(self.staged)}}
        _Files(self.spark, self.root).create(number, manifest)
        self.done, self.base = True, manifest | {"number": number}
        return self.base
