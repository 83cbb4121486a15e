"""Keyed tables in plain Parquet, upserted bucket by bucket.

A table's rows lie in buckets of their key. An upsert reads and rewrites only the
buckets that its batch touches; the others keep their files. The new buckets
count once the manifest names them, so a lost executor or a failed job never
shows half a table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.dedup import latest_per_key
from starloom.sources.manifest import KEEP_VERSIONS, Change, Store
from starloom.sources.writers import keep as held

BUCKETS = 64
_TABLE = "rows"
_BUCKET = "starloom_bucket"
_AGE = "starloom_age"


def committed(spark: SparkSession, path: str) -> int | None:
    """Number of the newest committed snapshot, or None."""
    return (Store(spark, path).versions() or [None])[-1]


def read_snapshot(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of a snapshot, the newest by default."""
    return Store(spark, path).read(_TABLE, number).drop(_BUCKET)


def bucket_versions(spark: SparkSession, path: str, number: int | None = None) -> dict[int, int]:
    """By bucket, the snapshot that wrote it."""
    commit = Store(spark, path).commit(number)
    return {int(u.split("=")[1]): int(v.split("-")[0]) for u, v in commit.units[_TABLE].items()} if commit else {}


def _bucketed(df: DataFrame, key: Sequence[str], buckets: int, spread: str) -> DataFrame:
    """Add the bucket. A hash of the key by default; ``spread`` names another long expression. Null keys have one as well."""
    value = F.coalesce(F.expr(spread).cast("long"), F.lit(0).cast("long")) if spread else F.xxhash64(*key)
    return df.withColumn(_BUCKET, F.pmod(value, F.lit(buckets)).cast("int"))


def _layout(change: Change, table: str, key: Sequence[str], buckets: int, spread: str | None) -> tuple[int, str]:
    """Buckets and their expression: what the table began with, and for a new table the arguments."""
    known = change.properties.setdefault(table, {})
    if not known:
        known |= {"key": ",".join(key), "buckets": str(buckets), "spread": spread or ""}
    if known["key"] != ",".join(key):
        raise ValueError(f"the key of {table} is ({known['key']}), not ({','.join(key)})")
    return int(known["buckets"]), known["spread"]


def merge(
    change: Change,
    table: str,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column],
    arrival_wins: bool = False,
    buckets: int = BUCKETS,
    spread: str | None = None,
    pick: Callable[..., DataFrame] = latest_per_key,
) -> None:
    """Merge a batch into a keyed table as part of a change, which may hold other tables too.

    Only buckets with keys of the batch are read, shuffled once by bucket,
    merged and written. ``pick`` keeps a row per key: the greatest by ``order``, or with
    :func:`~starloom.operators.dedup.first_per_key` the least.
    """
    n, by = _layout(change, table, key, buckets, spread)
    if change.has(table):  # a key must have its stored type to fall into its bucket
        batch = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in change.schemas[table] if f.name != _BUCKET])
    newest = held(_bucketed(pick(batch, key, order), key, n, by))
    try:
        if not change.has(table):
            change.replace(table, newest, [_BUCKET])
            return
        touched = [f"{_BUCKET}={r[0]}" for r in newest.select(_BUCKET).distinct().collect()]
        stored = change.read(table, touched).select(*newest.columns).withColumn(_AGE, F.lit(0))
        both = stored.unionByName(newest.withColumn(_AGE, F.lit(1))).repartition(_BUCKET)
        rule = [_AGE, *order] if arrival_wins else [*order, _AGE]
        change.replace(table, pick(both, [_BUCKET, *key], rule).drop(_AGE), [_BUCKET], even=False)
    finally:
        newest.unpersist()


def merged(change_or_store: Change | Store, table: str) -> DataFrame:
    """A keyed table without its bucket column."""
    return change_or_store.read(table).drop(_BUCKET)


def upsert(
    batch: DataFrame,
    path: str,
    key: Sequence[str],
    order: Sequence[str | Column],
    arrival_wins: bool = False,
    writer: str = "",
    batch_id: int | None = None,
    keep: int = KEEP_VERSIONS,
    buckets: int = BUCKETS,
    spread: str | None = None,
) -> int:
    """Merge a batch into the table at ``path``; returns the new snapshot's number.

    A key's greatest row by ``order`` survives; with ``arrival_wins`` any batch
    row beats a stored one, and ``order`` decides inside the batch. Nulls in the
    key equal each other. ``writer`` and ``batch_id`` name a batch, and a writer's
    numbers rise: one that is committed already is not merged again. Numbers go on
    from the newest commit, whoever wrote it.

    ``buckets`` is set when the table begins, so that one of them is a file or
    two; :func:`rebucket` changes it later. Buckets without keys of the batch
    keep their files. The newest ``keep`` snapshots stay readable.
    """
    store = Store(batch.sparkSession, path)
    change = store.begin(writer, batch_id)
    if change is None:
        return store.versions()[-1]
    merge(change, _TABLE, batch, key, order, arrival_wins, buckets, spread)
    return change.commit(keep)


def rebucket(spark: SparkSession, path: str, buckets: int, spread: str | None = None, keep: int = KEEP_VERSIONS) -> int:
    """Deal the whole table into another number of buckets, as a new snapshot of the same rows."""
    change = Store(spark, path).begin()
    if not change.has(_TABLE):
        raise FileNotFoundError(f"no table in {path}")
    known = change.properties[_TABLE]
    known |= {"buckets": str(buckets), "spread": known["spread"] if spread is None else spread}
    rows = _bucketed(change.read(_TABLE).drop(_BUCKET), known["key"].split(","), buckets, known["spread"])
    change.replace(_TABLE, rows.select(*change.schemas[_TABLE].names), [_BUCKET], drop=list(change.units[_TABLE]))
    return change.commit(keep)
