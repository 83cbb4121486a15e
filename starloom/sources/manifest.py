"""Tables that change together, by versioned units and one commit.

A store is a folder of tables, and a table consists of units: the folders of its
partition values, the buckets of its key, or the whole of it. A change writes
new units beside the old ones; its commit is a single small file that names, for
every unit of every table, the version that holds it. So all outputs of a batch
appear together or not at all, units that a change does not touch keep their
files, and a reader of an earlier commit is not disturbed.

    commits/version=7/part-...              the map of the seventh commit
    data/TABLE/starloom_version=7-.../UNIT  units that its change wrote
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Lock
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.writers import balance, read_target

KEEP_VERSIONS = 8
MANY_PARTS = 64
VERSION = "starloom_version"
WHOLE = ""
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTING_SET = Lock()  # tables of one change may be written at one time
_ROWS = "kind string, name string, unit string, held string"


class ConflictError(RuntimeError):
    """Another writer has committed since this change began."""


@dataclass(frozen=True)
class Commit:
    """What a version holds: by table the folder of each unit, the schema and properties; by writer its last batch."""

    version: int
    units: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)
    properties: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    batches: Mapping[str, int] = field(default_factory=dict)

    def rows(self) -> list[tuple[str, str, str, str]]:
        out = [("unit", t, u, v) for t, held in self.units.items() for u, v in held.items()]
        out += [("schema", t, "", s.json()) for t, s in self.schemas.items()]
        out += [("property", t, k, v) for t, held in self.properties.items() for k, v in held.items()]
        return out + [("batch", w, "", str(b)) for w, b in self.batches.items()]


def holders(held: str) -> list[str]:
    """The version folders that hold parts of a unit: one, and one more for each batch appended to it."""
    return held.split(",")


def unit_values(unit: str) -> dict[str, str | None]:
    """Partition values of a unit as text."""
    pairs = (part.split("=", 1) for part in unit.split("/") if part)
    return {unquote(k): None if v == NO_VALUE else unquote(v) for k, v in pairs}


def partition_values(df: DataFrame, by: Sequence[str]) -> set[tuple[str | None, ...]]:
    """The distinct partition values of ``df`` as text, as folders hold them; a value per unit reaches the driver."""
    texts = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in by]
    return {tuple(r) for r in df.select(*[t.alias(f"_{i}") for i, t in enumerate(texts)]).distinct().collect()}


class Store:
    """A folder of versioned tables. Changes follow one another; of two at a time the later commit is refused."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def versions(self) -> list[int]:
        """Committed versions, by one listing; a commit counts once its file is there."""
        found = self._files.globStatus(self._at(f"{self.path}/commits/version=*/part-*")) or []
        return sorted({int(re.search(r"/version=(\d+)/part-", f.getPath().toString())[1]) for f in found})

    def commit(self, version: int | None = None) -> Commit | None:
        """A commit, the newest by default; None before the first."""
        known = self.versions()
        number = (known[-1] if known else None) if version is None else version
        if number is None:
            return None
        if number not in known:
            raise FileNotFoundError(f"no version {number} in {self.path}")
        units: dict[str, dict[str, str]] = {}
        schemas: dict[str, T.StructType] = {}
        properties: dict[str, dict[str, str]] = {}
        batches: dict[str, int] = {}
        for kind, name, unit, held in self.spark.read.schema(_ROWS).parquet(f"{self.path}/commits/version={number}").collect():
            if kind == "unit":
                units.setdefault(name, {})[unit] = held
            elif kind == "schema":
                schemas[name] = T.StructType.fromJson(json.loads(held))
            elif kind == "property":
                properties.setdefault(name, {})[unit] = held
            else:
                batches[name] = int(held)
        return Commit(number, units, schemas, properties, batches)

    def read(self, table: str, version: int | None = None, units: Iterable[str] | None = None, commit: Commit | None = None) -> DataFrame:
        """A table as of a version, all of it or the given units, in one scan over their folders."""
        commit = commit or self.commit(version)
        if commit is None or table not in commit.schemas:
            raise FileNotFoundError(f"no table {table} in {self.path}")
        schema, held = commit.schemas[table], commit.units.get(table, {})
        root = f"{self.path}/data/{table}"
        wanted = held if units is None else [u for u in units if u in held]
        paths = [f"{root}/{VERSION}={v}/{u}".rstrip("/") for u in wanted for v in holders(held[u])]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        with self._few_listing_tasks():
            read = self.spark.read.schema(stored).option("basePath", root).parquet(*paths)
        return read.select(*[f"`{c}`" for c in schema.names])

    @contextmanager
    def _few_listing_tasks(self) -> Iterator[None]:
        """While folders are listed, a task per core and not one per folder: each is a single call to the file system."""
        with _LISTING_SET:
            before = self.spark.conf.get(_LISTING, None)
            self.spark.conf.set(_LISTING, str(self.spark.sparkContext.defaultParallelism))
            try:
                yield
            finally:
                self.spark.conf.unset(_LISTING) if before is None else self.spark.conf.set(_LISTING, before)

    def begin(self, writer: str = "", batch: int | None = None) -> Change | None:
        """A change on top of the newest commit; None when that holds the writer's batch, or a later one, already."""
        base = self.commit()
        if base and batch is not None and base.batches.get(writer, -1) >= batch:
            return None
        return Change(self, base or Commit(0), writer, batch)

    def _publish(self, commit: Commit) -> None:
        folder = f"{self.path}/commits/version={commit.version}"
        if self.versions()[-1:] >= [commit.version]:
            raise ConflictError(f"version {commit.version} of {self.path} is there already")
        self._files.delete(self._at(folder), True)  # what a crashed commit has left, without a file that counts
        try:
            self.spark.createDataFrame(commit.rows(), _ROWS).coalesce(1).write.mode("error").parquet(folder)
        except AnalysisException as error:
            if error.getCondition() == "PATH_ALREADY_EXISTS":
                raise ConflictError(f"version {commit.version} of {self.path} is being written") from error
            raise

    def expire(self, keep: int = KEEP_VERSIONS) -> None:
        """Forget all but the newest ``keep`` commits, and delete the units that only those held."""
        known = self.versions()
        if len(known) <= keep:
            return
        oldest = self.commit(known[-keep])
        staying = {(t, v, u) for t, held in oldest.units.items() for u, listed in held.items() for v in holders(listed)}
        folders = {(t, v) for t, v, _ in staying}
        for number in known[:-keep]:
            gone = self.commit(number)
            self._files.delete(self._at(f"{self.path}/commits/version={number}"), True)
            for table, held in gone.units.items():
                for unit, version in ((u, v) for u, listed in held.items() for v in holders(listed)):
                    if (table, version, unit) not in staying:
                        whole = (table, version) not in folders
                        self._files.delete(self._at(f"{self.path}/data/{table}/{VERSION}={version}" + ("" if whole else f"/{unit}")), True)


class Change:
    """Units written for the next version. Nothing shows before :meth:`commit`; a change that is dropped leaves only files no commit names."""

    def __init__(self, store: Store, base: Commit, writer: str, batch: int | None):
        self.store, self.base = store, base
        self.version = base.version + 1
        self.units = {t: dict(u) for t, u in base.units.items()}
        self.schemas = dict(base.schemas)
        self.properties = {t: dict(p) for t, p in base.properties.items()}
        self.batches = dict(base.batches) | ({writer: batch} if batch is not None else {})

    def has(self, table: str) -> bool:
        return table in self.schemas

    def _now(self) -> Commit:
        return Commit(self.version, self.units, self.schemas, self.properties, self.batches)

    def read(self, table: str, units: Iterable[str] | None = None) -> DataFrame:
        """A table as this change leaves it so far."""
        return self.store.read(table, units=units, commit=self._now())

    def units_of(self, table: str, by: Sequence[str], values: set[tuple[str | None, ...]]) -> list[str]:
        """The table's units with one of these partition values."""
        return [u for u in self.units.get(table, {}) if tuple(unit_values(u).get(c) for c in by) in values]

    def replace(self, table: str, df: DataFrame, by: Sequence[str] = (), drop: Iterable[str] = (), even: bool = True) -> list[str]:
        """Write the units that occur in ``df``, after taking out those of ``drop``; returns the units written.

        Without ``by`` the table is one unit and replaced as a whole. ``even``
        lets Spark split and merge files; else rows are written as they lie. A table keeps its first schema.
        """
        mine = self.units.setdefault(table, {})
        for unit in [WHOLE] if not by else list(drop):
            mine.pop(unit, None)
        units, held = self._write(table, df, by, even)
        mine.update(dict.fromkeys(units, held))
        return units

    def append(self, table: str, df: DataFrame, by: Sequence[str] = (), even: bool = True) -> list[str]:
        """Write rows beside those that the units hold already; returns the units written. :meth:`compact` joins the parts again."""
        units, held = self._write(table, df, by, even)
        mine = self.units.setdefault(table, {})
        mine.update({u: f"{mine[u]},{held}" if u in mine else held for u in units})
        return units

    def compact(self, table: str, by: Sequence[str] = (), parts: int = MANY_PARTS) -> list[str]:
        """Rewrite units that appends have left in ``parts`` parts or more, each into one."""
        many = [u for u, held in self.units.get(table, {}).items() if len(holders(held)) >= parts]
        return self.replace(table, self.read(table, many), by) if many else []

    def _write(self, table: str, df: DataFrame, by: Sequence[str], even: bool) -> tuple[list[str], str]:
        """Units with rows in ``df``, written to a folder of their own, and the folder's name."""
        schema = self.schemas.setdefault(table, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))
        held = f"{self.version}-{uuid.uuid4().hex[:12]}"
        folder = f"{self.store.path}/data/{table}/{VERSION}={held}"
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
        writer = (balance(rows, None, *by) if even else rows).write
        (writer.partitionBy(*by) if by else writer).parquet(folder)
        written = read_target(self.store.spark, folder, schema)
        files = [unquote(f) for f in written.inputFiles()] if written is not None else []
        return sorted({f.rsplit("/", 1)[0].partition(f"{VERSION}={held}")[2].strip("/") for f in files}), held

    def commit(self, keep: int = KEEP_VERSIONS) -> int:
        """Make all units written so far the next version, in one step; then forget versions beyond ``keep``."""
        self.store._publish(self._now())
        self.store.expire(keep)
        return self.version


def _in_store(spark: SparkSession, path: str) -> tuple[Store, Commit, str] | None:
    """The store, commit and table of ``FOLDER/TABLE`` where ``FOLDER`` is a store."""
    folder, _, table = path.rstrip("/").rpartition("/")
    store = Store(spark, folder) if folder else None
    commit = store.commit() if store else None
    return (store, commit, table) if commit and table in commit.schemas else None


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """``FOLDER/TABLE``, from the store at ``FOLDER`` where there is one, else as a Parquet folder."""
    found = _in_store(spark, path)
    return found[0].read(found[2], commit=found[1]) if found else spark.read.parquet(path)


def table_folder(spark: SparkSession, path: str) -> str:
    """Where the files of ``FOLDER/TABLE`` lie, to size a job by."""
    found = _in_store(spark, path)
    return f"{found[0].path}/data/{found[2]}" if found else path
