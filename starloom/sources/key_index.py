"""An index of keys beside a table's files, so that a load opens only files that hold its keys.

For each data file ``_keys/KEY/ranges`` holds the lowest and highest value of every key
column, and ``_keys/KEY/digests`` a 64-bit digest per key. A batch is compared with
the ranges first: keys that rise with time meet the newest files only. Digests
of the files left are joined with the batch's; 8 bytes a key are read instead of
the key columns. What remains are files with an equal digest, and those are opened.

The index is derived: files it does not know are indexed before it is asked, so
a load that fails between its rows and its index loses nothing, and files that
are gone are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Boxes that a batch's keys are cut into, and files that may be named one by one in a filter.
BOXES = 32
NAMED_FILES = 500


def _folder(path: str, key: Sequence[str]) -> str:
    return f"{path.rstrip('/')}/_keys/{'+'.join(key)}"


def _canonical(df: DataFrame, column: str) -> Column:
    """A key column in a type that all loads share: whole numbers as longs, fractions as doubles."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(f"`{column}`").cast("long")
    return F.col(f"`{column}`").cast("double") if isinstance(kind, T.FractionalType) else F.col(f"`{column}`")


def _keys(df: DataFrame, key: Sequence[str]) -> list[Column]:
    return [_canonical(df, c).alias(f"k{i}") for i, c in enumerate(key)]


def _digest(n: int) -> Column:
    return F.xxhash64(*[F.col(f"k{i}") for i in range(n)]).alias("digest")


def _bounds(n: int) -> list[Column]:
    """Lowest and highest value of each key column, and whether it has nulls."""
    out = []
    for i in range(n):
        out += [F.min(f"k{i}").alias(f"lo{i}"), F.max(f"k{i}").alias(f"hi{i}"), F.max(F.col(f"k{i}").isNull()).alias(f"null{i}")]
    return out


def _relative(files: Sequence[str], root: str) -> dict[str, str]:
    """Full names by the part of the name below the table."""
    return {f.split(root + "/", 1)[1]: f for f in files}


def _root(spark: SparkSession, path: str) -> str:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toUri().getRawPath()


def _parts(target: DataFrame, path: str, key: Sequence[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """The index's two tables, read under their schemas; None before they are first written."""
    spark, folder = target.sparkSession, _folder(path, key)
    fields = [T.StructField("file", T.StringType()), T.StructField("n", T.LongType())]
    for i, f in enumerate(target.select(*_keys(target, key)).schema):
        fields += [T.StructField(f"lo{i}", f.dataType), T.StructField(f"hi{i}", f.dataType), T.StructField(f"null{i}", T.BooleanType())]
    out = []
    for name, schema in (("ranges", T.StructType(fields)), ("digests", "file string, digest long")):
        try:
            out.append(spark.read.schema(schema).parquet(f"{folder}/{name}"))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            out.append(None)
    return tuple(out)


def open_files(target: DataFrame, path: str, names: Sequence[str]) -> DataFrame:
    """Rows of some of the table's files, given by full names."""
    spark = target.sparkSession
    if not names:
        return spark.createDataFrame([], target.schema)
    return spark.read.schema(target.schema).option("basePath", path).parquet(*map(unquote, names)).select(*[f"`{c}`" for c in target.columns])


def refresh(target: DataFrame, path: str, key: Sequence[str]) -> dict[str, str]:
    """Index the files that the index does not know; returns the table's files by relative name.

    Names of files reach the driver, where Spark's own listing holds them too.
    """
    spark = target.sparkSession
    root, folder, n = _root(spark, path), _folder(path, key), len(key)
    files = _relative(target.inputFiles(), root)
    ranges, _ = _parts(target, path, key)
    known = {r[0] for r in ranges.select("file").collect()} if ranges is not None else set()
    new = sorted(f for f in files if f not in known)
    if new:
        rows = _keys_by_file(target, path, [files[f] for f in new], root, key)
        # digests first: a file counts as indexed once its range is there. A task reads whole files, so sorting needs no shuffle
        rows.select("file", _digest(n)).sortWithinPartitions("file", "digest").write.mode("append").parquet(f"{folder}/digests")
        found = rows.groupBy("file").agg(F.count("*").alias("n"), *_bounds(n))
        # a file without rows has no range; it is named all the same, so that it is not looked at again
        named = spark.createDataFrame([(f, 0) for f in new], "file string, n long")
        found.unionByName(named, allowMissingColumns=True).coalesce(1).write.mode("append").parquet(f"{folder}/ranges")
    return files


def _keys_by_file(target: DataFrame, path: str, names: Sequence[str], root: str, key: Sequence[str]) -> DataFrame:
    """Keys of some files with each file's relative name."""
    spark = target.sparkSession
    read = spark.read.schema(target.schema).option("basePath", path).parquet(*map(unquote, names))
    full = F.col("_metadata.file_path")
    below = F.substring(full, F.locate(f"{root}/", full) + F.lit(len(root) + 1), F.length(full))
    return read.select(below.alias("file"), *_keys(target, key))


def candidates(batch: DataFrame, target: DataFrame, path: str, key: Sequence[str]) -> list[str]:
    """Full names of the table's files that hold a key digest of the batch, by ranges and then digests."""
    n = len(key)
    files = refresh(target, path, key)
    ranges, digests = _parts(target, path, key)
    if not files or ranges is None or digests is None:
        return list(files.values())
    keys = batch.select(*_keys(batch, key))
    # at most BOXES rows, so that the comparison with each file's range is a broadcast of a known size
    boxes = keys.repartitionByRange(BOXES, *[F.col(f"k{i}") for i in range(n)]).groupBy(F.spark_partition_id().alias("box")).agg(*_bounds(n))
    meets = [
        ((F.col(f"f.lo{i}") <= F.col(f"b.hi{i}")) & (F.col(f"f.hi{i}") >= F.col(f"b.lo{i}"))) | (F.col(f"f.null{i}") & F.col(f"b.null{i}"))
        for i in range(n)
    ]
    near = ranges.alias("f").join(F.broadcast(boxes.alias("b")), reduce(and_, meets), "left_semi").select("file").distinct()
    named = [r[0] for r in near.limit(NAMED_FILES + 1).collect()]
    if not named:
        return []
    some = digests.where(F.col("file").isin(named)) if len(named) <= NAMED_FILES else digests.join(near, "file", "left_semi")
    hit = some.join(keys.select(_digest(n)).distinct(), "digest", "left_semi").select("file").distinct()
    return sorted(files[r[0]] for r in hit.collect() if r[0] in files)


def colliding_keys(batch: DataFrame, target: DataFrame, path: str, key: Sequence[str]) -> DataFrame:
    """Keys of the files that a batch's keys may stand in; all keys of the table that the batch holds are among them."""
    return open_files(target, path, candidates(batch, target, path, key)).select(*key)
