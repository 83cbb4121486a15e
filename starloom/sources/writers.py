"""Table sinks and physical layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.dedup import duplicated_keys, one_per_key
from starloom.sources.key_index import colliding_keys

# Partitions that may be named one by one in a filter.
PRUNED_PARTITIONS = 500
# Files from which on a table's keys are looked up by an index.
INDEXED_FILES = 64


class DuplicateKeyError(ValueError):
    """A batch repeats a key, or holds one that its target has already."""


def balance(df: DataFrame, n: int | None = None, *columns: str) -> DataFrame:
    """Even out partitions.

    With ``n``, an explicit round-robin (or hash) count. Without, adaptive
    execution targets its advisory size: small outputs merge into one file, and
    a hot value of ``columns`` is split over several.
    """
    return df.repartition(n, *columns) if n else df.hint("rebalance", *columns)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    codec: str = "snappy",
    mode: str = "overwrite",
    files: int | None = None,
    compact: bool | None = None,
) -> None:
    """Parquet output.

    Partitioned output is rebalanced, so that each partition gets few and
    evenly sized files; other output is written as it lies, unless ``compact``
    asks for the same (a small dimension then becomes a single file).
    """
    if files or (bool(partition_by) if compact is None else compact):
        df = balance(df, files, *([] if files else partition_by))
    writer = df.write.mode(mode).option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``; all others stay."""
    (
        balance(df, None, *partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV with a header in every file."""
    balance(df).write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def export_json(tables: Mapping[str, DataFrame], path: str) -> None:
    """One JSON-lines folder per table."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def empty_as_null(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text})


def append(df: DataFrame, path: str, blank_to_null: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Bulk append; blank text can be stored as null."""
    write_parquet(empty_as_null(df) if blank_to_null else df, path, partition_by, mode="append")


def stage(df: DataFrame, path: str, replace: bool = True) -> DataFrame:
    """Fill a staging table, emptied first unless ``replace`` is off, and return it as stored."""
    write_parquet(df, path, mode="overwrite" if replace else "append")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_dimension(df: DataFrame, path: str, truncate: bool = True) -> None:
    """Reload a dimension, or add to it when ``truncate`` is off."""
    write_parquet(df, path, mode="overwrite" if truncate else "append", compact=True)


def read_target(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The table at ``path``, or None before its first write.

    A given schema spares the look into file footers, and keeps the types of
    partition columns, which would otherwise be guessed from folder names.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def same_key(left: str, right: str, key: Sequence[str]) -> Column:
    """Null-safe equality of two aliased frames' keys: a null, alone or in a part of the key, equals a null."""
    return reduce(and_, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in key])


def by_key(left: DataFrame, right: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on a null-safe key."""
    return left.alias("_l").join(right.select(*key).alias("_r"), same_key("_l", "_r", key), how)


def touched_rows(df: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in the partitions that occur in ``batch``.

    Up to ``PRUNED_PARTITIONS`` they become a literal filter, so only their
    folders are listed and read; beyond that it is a join, with the same result.
    """
    touched = batch.select(*partition_by).distinct()
    named = touched.limit(PRUNED_PARTITIONS + 1).collect()
    if len(named) > PRUNED_PARTITIONS:
        return by_key(df, touched, partition_by, "left_semi")
    hits = [reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in row.asDict().items()]) for row in named]
    return df.where(reduce(or_, hits, F.lit(False)))


def _existing_keys(batch: DataFrame, target: DataFrame, key: Sequence[str], partition_by: Sequence[str], path: str | None = None) -> DataFrame:
    """Target keys that the batch could collide with.

    Where the partition columns are part of the key, only the batch's partitions
    are read, so an hourly load reads its own days and not the history.
    Otherwise a key may have moved. In a table of ``INDEXED_FILES`` files or more its key
    index names those to open; fewer are read faster than the index is. Both ways find the same keys.
    """
    if partition_by and set(partition_by) <= set(key):
        return touched_rows(target.select(*key), batch, partition_by)
    if path is None or len(target.inputFiles()) < INDEXED_FILES:
        return target.select(*key)
    return colliding_keys(batch, target, path, key)


def append_new(batch: DataFrame, path: str, key: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Append only rows whose key is new, so a repeated load changes nothing.

    Within the batch one row per key is kept, chosen by all its columns. Nulls
    in the key equal each other. A key counts as known in whatever partition it
    stands; an index of keys beside the files says which of them to open.
    """
    spark = batch.sparkSession
    fresh = one_per_key(batch, list(key))
    target = read_target(spark, path, batch.schema)
    if target is not None:
        fresh = by_key(fresh, _existing_keys(batch, target, key, partition_by, path), key, "left_anti")
    append(fresh, path, partition_by=partition_by)


def append_unique(batch: DataFrame, path: str, key: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Append, refusing the whole batch when a key is not new. Nulls in the key equal each other."""
    clash = duplicated_keys(batch, list(key)).limit(1).collect()
    target = read_target(batch.sparkSession, path, batch.schema)
    if not clash and target is not None:
        known = _existing_keys(batch, target, key, partition_by, path)
        clash = by_key(batch.select(*key), known, key, "left_semi").limit(1).collect()
    if clash:
        found = {c: v for c, v in clash[0].asDict().items() if c in key}
        raise DuplicateKeyError(f"key {found} is not new in {path}")
    append(batch, path, partition_by=partition_by)


def create_tables(spark: SparkSession, schemas: Mapping[str, T.StructType | str], folder: str | None = None) -> None:
    """Create empty Parquet tables that do not exist yet."""
    for name, schema in schemas.items():
        if not spark.catalog.tableExists(name):
            kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            path = f"{folder}/{name}" if folder else None
            spark.catalog.createTable(name, path=path, source="parquet", schema=kinds)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def keep(df: DataFrame) -> DataFrame:
    """Hold a reused frame, spilling to disk; for sets well below the fact's size."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
