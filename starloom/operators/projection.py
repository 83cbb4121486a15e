"""Column selection, casting, filters and row picks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename in bulk; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def cast_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Cast in bulk; text that does not fit the type becomes null instead of failing."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in mapping.items()})


def project(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Select computed columns under explicit output names."""
    return df.select(*[c.alias(name) for name, c in columns.items()])


def lookup(df: DataFrame, **key: object) -> DataFrame:
    """Rows of one composite key. On a clustered table the filter prunes row groups."""
    for name, value in key.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def differing(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows whose two columns differ; a null on either side drops the row."""
    return df.where(F.col(a) != F.col(b))


def members(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column] = ()) -> DataFrame:
    """First ``n`` rows; an order makes the pick repeatable."""
    return (df.orderBy(*order) if order else df).limit(n)


def sample_rows(df: DataFrame, fraction: float, n: int, seed: int) -> DataFrame:
    """A shuffled random sample of at most ``n`` rows."""
    return df.sample(fraction=fraction, seed=seed).orderBy(F.rand(seed)).limit(n)


def preview(df: DataFrame, n: int = 20):
    """A few rows on the driver, as pandas."""
    return df.limit(n).toPandas()
