"""Counts, summaries and profiles, one pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def value_counts(df: DataFrame, column: str, count_nulls: bool = True, by_value: bool = False) -> DataFrame:
    """Rows per value, most frequent first (or by value).

    With ``count_nulls`` off the null group stays in the result but counts 0.
    """
    counted = F.count("*") if count_nulls else F.count(column)
    out = df.groupBy(column).agg(counted.alias("n"))
    return out.orderBy(F.col(column)) if by_value else out.orderBy(F.desc("n"), F.col(column))


def _melt(df: DataFrame, measures: Mapping[str, Mapping[str, Column]], label: str) -> DataFrame:
    """One aggregate row over all measures, then one output row per label."""
    names = list(next(iter(measures.values())))
    wide = df.agg(*[c.alias(f"m{i}_{j}") for i, m in enumerate(measures.values()) for j, c in enumerate(m.values())])
    rows = F.array(*[
        F.struct(F.lit(key).alias(label), *[F.col(f"m{i}_{j}").alias(n) for j, n in enumerate(names)])
        for i, key in enumerate(measures)
    ])
    return wide.select(F.inline(rows))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and not-null counts of all columns in a single scan."""
    return _melt(
        df,
        {c: {"n_null": F.count_if(F.col(c).isNull()), "n_present": F.count(c)} for c in columns},
        "column",
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min and max of numeric columns, one row each."""
    return _melt(
        df,
        {
            c: {
                "count": F.count(c),
                "mean": F.avg(c).cast("double"),
                "stddev": F.stddev_samp(c).cast("double"),
                "min": F.min(c).cast("double"),
                "max": F.max(c).cast("double"),
            }
            for c in columns
        },
        "column",
    )


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Row counts of many predicates in a single scan."""
    return _melt(df, {name: {"n": F.count_if(predicate)} for name, predicate in steps.items()}, "step")


def group_by_flag(df: DataFrame, flag: Column, name: str = "flag") -> DataFrame:
    return df.groupBy(flag.alias(name)).agg(F.count("*").alias("n"))


def total(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    return df.agg(F.sum(column).alias(name))


def min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lowest"), F.max(column).alias("highest"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def invalid_values(df: DataFrame, column: str, valid: Sequence[object], allow_null: bool = False) -> DataFrame:
    """Values outside the valid set, with their row counts; null is outside unless allowed."""
    bad = df.where(F.coalesce(~F.col(column).isin(list(valid)), F.lit(not allow_null)))
    return bad.groupBy(column).agg(F.count("*").alias("n"))


def days_with_rows(daily: DataFrame, key: str) -> DataFrame:
    """Rows per key of a pre-aggregated table: the number of days, not of events."""
    return daily.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("days"))


def partition_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns that two frames do not share, or hold under different types."""
    left = {f.name: f.dataType.simpleString() for f in a.schema}
    right = {f.name: f.dataType.simpleString() for f in b.schema}
    rows = [
        (name, left.get(name), right.get(name))
        for name in sorted({*left, *right})
        if left.get(name) != right.get(name)
    ]
    return a.sparkSession.createDataFrame(rows, "column string, left_type string, right_type string")


def extra_column_profile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Null profile of the columns that only ``b`` has."""
    return null_profile(b, [c for c in b.columns if c not in a.columns])
