"""Run-to-completion incremental loads.

Each run picks up the files that arrived since the last one and stops. Progress
lives in the checkpoint; the sinks are idempotent, so a replayed micro-batch
leaves the target as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.sources.snapshots import upsert
from starloom.sources.writers import append_new, keep

BatchSink = Callable[[DataFrame, int], None]


def load_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sink: BatchSink,
    checkpoint: str,
    fmt: str = "json",
    max_files: int | None = None,
) -> None:
    """Feed files that have not been loaded yet to ``sink``, then return."""
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.load(path).writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@contextmanager
def _held(batch: DataFrame) -> Iterator[DataFrame]:
    """Hold a micro-batch while a sink reads it several times, so its files are parsed once."""
    rows = keep(batch)
    try:
        yield rows
    finally:
        rows.unpersist()


def fact_sink(
    path: str,
    key: Sequence[str],
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    partition_by: Sequence[str] = (),
) -> BatchSink:
    """Append rows with a new key, after shaping the batch."""

    def write(batch: DataFrame, _: int) -> None:
        with _held(shape(batch)) as rows:
            append_new(rows, path, key, partition_by)

    return write


def dimension_sink(
    path: str,
    key: Sequence[str],
    order: Sequence[str | Column],
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> BatchSink:
    """Keep the latest row per key. A micro-batch is known by its stream's id and number, so a replay is no second merge."""

    def write(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        with _held(shape(batch)) as rows:
            upsert(rows, path, key, order, writer=stream, batch_id=number)

    return write
