"""Distinct rows, one row per key, surrogate ids.

Every operator here shrinks its input inside the map tasks (partial aggregates
or a per-task top-n), so a hot key sends at most a row per task over the wire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _extreme(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], pick) -> DataFrame:
    """The whole row that ``pick`` (max or min) finds per key, compared by ``order``.

    One struct holds the order and then the other columns, so rows that tie on
    the order are told apart by their content and the choice always repeats.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.select(*key).distinct()
    named = [o for o in order if isinstance(o, str) and o in rest]
    lead = [F.col(o) if o in named else (F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    tail = [F.col(c) for c in rest if c not in named]
    winner = df.groupBy(*key).agg(pick(F.struct(*lead, *tail)).alias("_row"))
    return winner.select(*[F.col(c) if c in key else F.col("_row")[c].alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Last write wins: the whole row that is greatest by ``order``, per key."""
    return _extreme(df, key, order, F.max)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First write wins: later rows of a key are ignored."""
    return _extreme(df, key, order, F.min)


def one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key; with no order given, all columns decide, so the pick repeats."""
    return first_per_key(df, key, order or [])


def top_n_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key by ``order``; Spark applies the limit before the shuffle too."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def distinct_dimension(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique but not gap-free ids; they change when the input layout changes."""
    return df.withColumn(name, F.monotonically_increasing_id())


def duplicated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
