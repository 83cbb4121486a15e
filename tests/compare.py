"""Run a registered query and its SQL twin, and compare names, types and rows."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type name to the DuckDB types it may be compared with.
TYPES = {
    "string": {"VARCHAR"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp": {"TIMESTAMP"},
}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable mismatches; empty when both sides agree."""
    cursor = con.execute(sql)
    expected = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    names = sorted(expected)
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    kinds = dict(df.dtypes)
    out = [f"type of {n}: {kinds[n]} != {expected[n]}" for n in names if expected[n] not in TYPES.get(kinds[n], set())]
    order = list(expected)
    left = Counter(tuple(_value(r[n]) for n in names) for r in df.collect())
    right = Counter(tuple(_value(r[order.index(n)]) for n in names) for r in rows)
    if left != right:
        out.append(f"rows {sum(left.values())} != {sum(right.values())}" if sum(left.values()) != sum(right.values()) else "values differ")
        out += [f"  spark only {r}" for r in list((left - right).elements())[:3]]
        out += [f"  sql only   {r}" for r in list((right - left).elements())[:3]]
    return out


def main() -> None:
    from starloom.session import build_session
    from starloom.suite import oracle_sql, queries

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = database(sf_dir), oracle_sql(), 0
    for key, fn in queries().items():
        if only and key not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problems = differences(df, con, sqls[key]) if key in sqls else [] if df.count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {key} {time.time() - start:.2f}s" + ("" if key in sqls else " (rows only)"), flush=True)
        for p in problems:
            print("   ", p)
    print("failed:", bad)


if __name__ == "__main__":
    main()
