"""Guards that keep operators safe at cluster scale.

* :func:`size_checked` broadcasts a side only after measuring it.
* :func:`hot_keys` finds heavy hitters in one pass with bounded memory.
* :func:`salt_sides` spreads the heavy hitters of a join over many tasks,
  :func:`grid_sides` those that are heavy on both sides.
* :func:`stable` and :func:`stored` cut lineage in the cluster's shared folder.
* :func:`discard` and :func:`freed_shuffles` give disk back while a long job goes on.
"""

from __future__ import annotations

import atexit
import math
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
HOT_MIN_ROWS = 500_000
MAX_HOT_KEYS = 4_096
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` against both bounds.

    The limit is the last step, so Spark scans partition by partition and stops
    as soon as it has ``max_rows + 1`` rows: a table far beyond the bound costs
    a task or two. Only row widths reach the driver.
    """
    if max_rows <= 0:
        return False
    widths = df.select(F.length(F.to_json(F.struct("*")))).limit(max_rows + 1).collect()
    return len(widths) <= max_rows and sum(w[0] for w in widths) <= max_bytes


def size_checked(df: DataFrame, measure: DataFrame | None = None, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``(broadcast-hinted df, True)`` when it is measured small, else ``(df, False)``.

    ``measure`` may name a cheaper frame that is an upper bound of ``df``, such
    as the table that ``df`` deduplicates.
    """
    small = is_small(df if measure is None else measure, max_rows)
    return (F.broadcast(df), True) if small else (df, False)


def key_hash(cols: Sequence[Column | str]) -> Column:
    return F.xxhash64(*cols)


def hot_keys(
    df: DataFrame,
    cols: Sequence[Column | str],
    min_rows: int = HOT_MIN_ROWS,
    share: float | None = None,
) -> dict[int, int]:
    """Keys that hold more rows than one shuffle partition's fair share.

    Maps the hash of a heavy key to the number of parts it should be cut into,
    a power of two. One column-pruned pass with a frequent-items sketch: each
    task keeps a bounded number of counters and a single row reaches the
    driver. At most ``1 / share`` keys can qualify. The answer only routes rows
    between exact code paths, so an estimate never changes a result.
    """
    if share is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        share = 1.0 / max(parts, 2)
    k = min(MAX_HOT_KEYS, int(1 / share) + 1)
    tracked = min(1_000_000, max(10_000, 4 * k))
    row = (
        df.select(key_hash(cols).alias("h"))
        .agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {k}, {tracked})").alias("top"))
        .first()
    )
    fair = max(min_rows, share * row["n"])
    return {item["item"]: 2 << int(math.log2(item["count"] / fair)) for item in (row["top"] or []) if item["count"] >= fair}


def is_hot(cols: Sequence[Column | str], hot: Iterable[int]) -> Column:
    listed = list(hot)
    return key_hash(cols).isin(listed) if listed else F.lit(False)


def _parts(cols: Sequence[str], hot: Mapping[int, int]) -> Column:
    """Number of parts of a row's key, 1 for keys that are not hot."""
    parts = F.lit(1)
    for n in sorted(set(hot.values())):
        parts = F.when(is_hot(cols, [h for h, size in hot.items() if size == n]), F.lit(n)).otherwise(parts)
    return parts


def salt_sides(
    left: DataFrame, right: DataFrame, left_key: Sequence[str], right_key: Sequence[str], hot: Mapping[int, int]
) -> tuple[DataFrame, DataFrame]:
    """Add ``_salt`` to both sides: hot left rows spread, hot right rows repeat.

    A key gets as many salts as its size asks for, so all repeats together stay
    in the order of the partition count per right row. Left rows with a null in
    the key match nothing and spread as well, so that an outer join does not
    gather them in one task. The salt mixes a hash of the row with the partition
    that holds it: it is the same on a task retry, and equal rows read by
    different tasks part ways.
    """
    spread = F.xxhash64(*left.columns) + F.spark_partition_id()
    absent = reduce(or_, [F.col(c).isNull() for c in left_key])
    parts = F.when(absent, F.lit(MAX_HOT_KEYS)).otherwise(_parts(left_key, hot))
    left = left.withColumn("_salt", F.pmod(spread, parts).cast("int"))
    if not hot:
        return left, right.withColumn("_salt", F.lit(0))
    return left, right.withColumn("_salt", F.explode(F.sequence(F.lit(0), _parts(right_key, hot) - 1)))


def grid_sides(
    left: DataFrame,
    right: DataFrame,
    left_key: Sequence[str],
    right_key: Sequence[str],
    left_hot: Mapping[int, int],
    right_hot: Mapping[int, int],
) -> tuple[DataFrame, DataFrame]:
    """Add ``_row`` and ``_col`` to both sides, so that a hot key's rows meet in a grid of tasks.

    A key cut into ``r`` parts on the left and ``c`` on the right gets ``r x c``
    cells: a left row lies in one row of the grid and repeats over its columns, a
    right row in one column and repeats over its rows. Each pair of rows meets in
    one cell, and a cell holds about a fair share of either side. A key that is
    hot on one side alone is a single column, or a single row. Rows without a
    key match nothing and spread. The parts mix a hash of the row with the partition that
    holds it, as in :func:`salt_sides`.
    """

    def dealt(df: DataFrame, key: Sequence[str], mine: Mapping[int, int], other: Mapping[int, int], own: str, across: str) -> DataFrame:
        spread = F.xxhash64(*df.columns) + F.spark_partition_id()
        absent = reduce(or_, [F.col(c).isNull() for c in key])
        df = df.withColumn(own, F.pmod(spread, F.when(absent, F.lit(MAX_HOT_KEYS)).otherwise(_parts(key, mine))).cast("int"))
        copies = F.when(absent, F.lit(1)).otherwise(_parts(key, other))
        return df.withColumn(across, F.explode(F.sequence(F.lit(0), copies - 1)) if other else F.lit(0))

    return dealt(left, left_key, left_hot, right_hot, "_row", "_col"), dealt(right, right_key, right_hot, left_hot, "_col", "_row")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only in local mode, one per process.

    On a cluster executors and driver do not share local disks, so a missing
    setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return _local_folder()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="starloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder path for intermediate tables."""
    return f"{shared_folder(spark).rstrip('/')}/starloom/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it ends, not when the driver happens to collect its garbage.

    For jobs of many queries that each run once: a plan that runs again shuffles again.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write a derived dimension once and read it back.

    Its size is then known from its files, so a join with it is planned as a
    broadcast exactly when it fits, and it is not derived again per use.
    """
    path = scratch(df.sparkSession, name)
    df.hint("rebalance").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and freezes generated ids."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
