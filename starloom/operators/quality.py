"""Declarative table checks (Q1-Q10).

Checks on one table share a single aggregate pass. Uniqueness and references
need a shuffle each, and both collapse rows to keys before it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

REPORT_COLUMNS = ["table", "check", "value", "passed"]


class QualityError(RuntimeError):
    """At least one check failed."""


@dataclass(frozen=True)
class Check:
    """A named measure of a table and the test its value must pass.

    ``measure`` makes an aggregate column. ``frame`` takes its place where an
    aggregate cannot express the measure: it makes a one-row, one-column frame.
    Both are built when the check runs, so checks can be declared up front.
    """

    name: str
    test: Callable[[Column], Column]
    measure: Callable[[], Column] | None = None
    frame: Callable[[DataFrame], DataFrame] | None = None


def _none(value: Column) -> Column:
    return value == 0


def _count_bad(name: str, bad: Callable[[], Column]) -> Check:
    return Check(name, _none, lambda: F.count_if(bad()))


def not_empty() -> Check:
    return Check("not_empty", lambda v: v > 0, lambda: F.count("*"))


def no_nulls(column: str) -> Check:
    return _count_bad(f"no_nulls({column})", lambda: F.col(column).isNull())


def in_set(column: str, values: Sequence[object], allow_null: bool = False) -> Check:
    """Null is outside the set unless allowed."""
    return _count_bad(f"in_set({column})", lambda: F.coalesce(~F.col(column).isin(list(values)), F.lit(not allow_null)))


def in_range(column: str, low: float, high: float, allow_null: bool = False) -> Check:
    """Null is outside the range unless allowed."""
    return _count_bad(f"in_range({column})", lambda: F.coalesce(~F.col(column).between(low, high), F.lit(not allow_null)))


def lowest(column: str, test: Callable[[Column], Column]) -> Check:
    return Check(f"min({column})", test, lambda: F.min(column))


def highest(column: str, test: Callable[[Column], Column]) -> Check:
    return Check(f"max({column})", test, lambda: F.max(column))


def lossy_cast(column: str, kind: str) -> Check:
    return _count_bad(f"lossy_cast({column})", lambda: ~F.col(column).try_cast(kind).eqNullSafe(F.col(column)))


def max_length(column: str, n: int) -> Check:
    return _count_bad(f"max_length({column})", lambda: F.length(column) > n)


def unique(*key: str) -> Check:
    def surplus(df: DataFrame) -> DataFrame:
        per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
        return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("value"))

    return Check(f"unique({','.join(key)})", _none, frame=surplus)


def references(column: str, parent: DataFrame, parent_key: str) -> Check:
    def orphans(df: DataFrame) -> DataFrame:
        keys = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_fk")).agg(F.count("*").alias("n"))
        known = parent.select(F.col(parent_key).alias("_pk"))
        missing = keys.join(known, F.col("_fk") == F.col("_pk"), "left_anti")
        return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value"))

    return Check(f"references({column})", _none, frame=orphans)


def _report_row(table: str, frame: DataFrame, checks: Sequence[tuple[Check, str]]) -> DataFrame:
    rows = F.array(*[
        F.struct(
            F.lit(table).alias("table"),
            F.lit(check.name).alias("check"),
            F.col(name).cast("double").alias("value"),
            F.coalesce(check.test(F.col(name)), F.lit(False)).alias("passed"),
        )
        for check, name in checks
    ])
    return frame.select(F.inline(rows))


def run_checks(tables: Mapping[str, tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """One row per check: table, check, value, passed."""
    reports = []
    for table, (df, checks) in tables.items():
        simple = [(c, f"v{i}") for i, c in enumerate(checks) if c.measure]
        if simple:
            reports.append(_report_row(table, df.agg(*[c.measure().alias(n) for c, n in simple]), simple))
        for check in checks:
            if check.frame:
                reports.append(_report_row(table, check.frame(df).toDF("value"), [(check, "value")]))
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> None:
    """Log every check and raise when one failed. The report has a row per check."""
    failed = []
    for row in report.collect():
        level = logging.INFO if row["passed"] else logging.ERROR
        logger.log(level, "%s.%s = %s: %s", row["table"], row["check"], row["value"], "passed" if row["passed"] else "FAILED")
        if not row["passed"]:
            failed.append(f"{row['table']}.{row['check']} = {row['value']}")
    if failed:
        raise QualityError("; ".join(failed))
