"""Session construction and the runtime settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings. Partition counts and memory stay with the cluster:
# adaptive execution coalesces shuffle partitions down to the advisory size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more shuffle above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Shuffle sizing: stored bytes per partition.
PARTITION_BYTES = 256 * 1024 * 1024


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below ``path``, asked anew each time: tables grow."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength()


def size_shuffles(spark: SparkSession, path: str) -> SparkSession:
    """Raise the shuffle partition count to what the input at ``path`` needs.

    Adaptive execution merges small partitions but cannot add any, so the count
    must start high enough. It is never lowered.
    """
    needed = -(-stored_bytes(spark, path) // PARTITION_BYTES)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else has built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session; ``conf`` entries use ``_`` for ``.`` in keys."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
