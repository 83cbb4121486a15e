"""Queries for profiles, value counts and quality checks (A6-A13, T7, T8, U2, K13, P12, S9, Q)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.profile import (
    describe,
    distinct_values,
    extra_column_profile,
    invalid_values,
    min_max,
    null_profile as null_counts,
    partition_sizes as sizes,
    value_counts,
)
from starloom.operators.projection import sample_rows as random_rows
from starloom.plans.listening import LEVELS, plays, songs, time_dimension, users
from starloom.sources.writers import balance
from starloom.suite.registry import query
from starloom.suite.views import CATALOG_SQL, COUNTRIES_SQL, PLAY_LOG_SQL, catalog, countries, play_log, table


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"))


@query("SELECT nullif(o_orderstatus, 'O') AS status, count(*) AS n FROM orders GROUP BY ALL")
def value_counts_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(_status(spark, sf_dir), "status")


@query("SELECT nullif(o_orderstatus, 'O') AS status, count(nullif(o_orderstatus, 'O')) AS n FROM orders GROUP BY ALL")
def value_counts_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(_status(spark, sf_dir), "status", count_nulls=False)


@query("SELECT p_size, count(*) AS n FROM part GROUP BY ALL")
def value_counts_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "part"), "p_size", by_value=True)


@query("""
SELECT 'user_id' AS "column", count(*) FILTER (WHERE user_id % 7 = 0) AS n_null, count(*) FILTER (WHERE user_id % 7 <> 0) AS n_present FROM events
UNION ALL SELECT 'event_type', count(*) FILTER (WHERE event_type = 'error'), count(*) FILTER (WHERE event_type <> 'error') FROM events
UNION ALL SELECT 'value', 0, count(*) FROM events""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        "value",
    )
    return null_counts(events, ["user_id", "event_type", "value"])


_DESCRIBE = """SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM {t}"""


@query(" UNION ALL ".join(_DESCRIBE.format(c=c, t="orders") for c in ("o_totalprice", "o_custkey")))
def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = describe(table(spark, sf_dir, "orders"), ["o_totalprice", "o_custkey"])
    return summary.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query("SELECT min(p_retailprice) AS lowest, max(p_retailprice) AS highest FROM part")
def min_max_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return min_max(table(spark, sf_dir, "part"), "p_retailprice")


@query("""SELECT p_type, min(p_retailprice) AS lowest, max(p_retailprice) AS highest, count(DISTINCT p_size) AS n_sizes
FROM part GROUP BY p_type""")
def min_max_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_type").agg(
        F.min("p_retailprice").alias("lowest"),
        F.max("p_retailprice").alias("highest"),
        F.countDistinct("p_size").alias("n_sizes"),
    )


@query("SELECT DISTINCT p_type FROM part")
def distinct_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "part"), "p_type")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY ALL")
def values_outside_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_values(table(spark, sf_dir, "events"), "event_type", ["click", "view"])


@query("""
SELECT 'o_orderyear' AS "column", 0 AS n_null, count(*) AS n_present FROM orders
UNION ALL SELECT 'o_flag', count(*) FILTER (WHERE o_orderstatus = 'O'), count(*) FILTER (WHERE o_orderstatus <> 'O') FROM orders""", name="schema_diff")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    drifted = orders.withColumns({
        "o_orderyear": F.year("o_orderdate"), "o_flag": F.nullif(F.col("o_orderstatus"), F.lit("O"))
    })
    return extra_column_profile(orders, drifted)


@query("SELECT count(*) AS n_rows, true AS some_partition FROM lineitem")
def partition_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes differ from run to run; together they are the table."""
    counted = sizes(balance(table(spark, sf_dir, "lineitem")))
    return counted.agg(F.sum(counted.columns[-1]).alias("n_rows"), (F.count("*") > 0).alias("some_partition"))


@query("SELECT 100::BIGINT AS n_rows, 100::BIGINT AS n_distinct, 100::BIGINT AS n_from_table FROM events HAVING count(*) > 0")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows drawn are random; their number is fixed, and each is a different row of the table."""
    events = table(spark, sf_dir, "events")
    drawn = random_rows(events, 0.9, 100, seed=7)
    # drawn once more for the join: the same seed draws the same rows of the same files
    known = drawn.join(events.select(F.col("event_id").alias("_id")).distinct(), F.col("event_id") == F.col("_id"))
    return known.agg(F.count("*").alias("n_rows"), F.count_distinct("event_id").alias("n_distinct"), F.count("_id").alias("n_from_table"))


_CHECK = """SELECT '{t}' AS "table", '{c}' AS "check", ({v})::DOUBLE AS value, {p} AS passed FROM {f}"""
_REPORT = [
    ("users", "not_empty", "count(*)", "count(*) > 0", "users"),
    ("users", "no_nulls(user_id)", "count(*) FILTER (WHERE user_id IS NULL)", "true", "users"),
    ("users", "no_nulls(first_name)", "count(*) FILTER (WHERE first_name IS NULL)", "true", "users"),
    ("users", "in_set(level)", "count(*) FILTER (WHERE level IS NULL OR level NOT IN ('free', 'paid'))",
     "count(*) FILTER (WHERE level IS NULL OR level NOT IN ('free', 'paid')) = 0", "users"),
    ("users", "unique(user_id)", "count(*) - count(DISTINCT user_id)", "count(*) = count(DISTINCT user_id)", "users"),
    ("songs", "not_empty", "count(*)", "count(*) > 0", "catalog"),
    ("songs", "no_nulls(title)", "count(*) FILTER (WHERE title IS NULL)", "true", "catalog"),
    ("songs", "min(duration)", "min(duration)", "min(duration) > 0", "catalog"),
    ("songs", "max(duration)", "max(duration)", "max(duration) < 1500", "catalog"),
    ("songs", "unique(title)", "count(*) - count(DISTINCT title)", "count(*) = count(DISTINCT title)", "catalog"),
    ("part", "lossy_cast(p_retailprice)", "count(*) FILTER (WHERE p_retailprice::DECIMAL(18,0) <> p_retailprice)",
     "count(*) FILTER (WHERE p_retailprice::DECIMAL(18,0) <> p_retailprice) = 0", "part"),
    ("time", "not_empty", "count(*)", "count(*) > 0", "seconds"),
    ("time", "in_range(hour)", "count(*) FILTER (WHERE s IS NULL OR hour(make_timestamp(s * 1000000)) NOT BETWEEN 0 AND 23)",
     "count(*) FILTER (WHERE s IS NULL OR hour(make_timestamp(s * 1000000)) NOT BETWEEN 0 AND 23) = 0", "seconds"),
    ("time", "in_range(week)", "count(*) FILTER (WHERE s IS NULL OR week(make_timestamp(s * 1000000)) NOT BETWEEN 1 AND 53)",
     "count(*) FILTER (WHERE s IS NULL OR week(make_timestamp(s * 1000000)) NOT BETWEEN 1 AND 53) = 0", "seconds"),
    ("time", "in_range(weekday)", "count(*) FILTER (WHERE s IS NULL OR dayofweek(make_timestamp(s * 1000000)) NOT BETWEEN 0 AND 6)",
     "count(*) FILTER (WHERE s IS NULL OR dayofweek(make_timestamp(s * 1000000)) NOT BETWEEN 0 AND 6) = 0", "seconds"),
    ("time", "max(year)", "max(year(make_timestamp(s * 1000000)))", "max(year(make_timestamp(s * 1000000))) < 2030", "seconds"),
    ("plays", "references(userId)", "count(*)", "count(*) = 0",
     "(SELECT 1 FROM plays WHERE userId IS NOT NULL AND userId NOT IN (SELECT user_id FROM users))"),
    ("plays", "references(song)", "count(*)", "count(*) = 0", "(SELECT 1 FROM play_log WHERE song IS NOT NULL AND page = 'NextSong' "
     "AND song NOT IN (SELECT p_name FROM part WHERE p_type <> 'ECONOMY'))"),
    ("country", "not_empty", "count(*)", "count(*) > 0", "countries"),
    ("country", "max_length(country_code)", "count(*) FILTER (WHERE length(country_code) > 3)", "true", "countries"),
]


@query(
    f"WITH {PLAY_LOG_SQL},{CATALOG_SQL},{COUNTRIES_SQL}, seconds AS (SELECT DISTINCT start_time AS s FROM plays),"
    " users AS (SELECT userId AS user_id, firstName AS first_name, level FROM plays"
    " QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts DESC, level DESC) = 1) "
    + " UNION ALL ".join(_CHECK.format(t=t, c=c, v=v, p=p, f=f) for t, c, v, p, f in _REPORT)
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, part = play_log(spark, sf_dir, with_user=True), table(spark, sf_dir, "part")
    listened, people, tracks = plays(log), users(log), songs(catalog(spark, sf_dir))
    some_titles = part.where(F.col("p_type") != "ECONOMY").select("p_name").distinct()
    return quality.run_checks({
        "users": (people, [
            quality.not_empty(), quality.no_nulls("user_id"), quality.no_nulls("first_name"),
            quality.in_set("level", LEVELS), quality.unique("user_id"),
        ]),
        "songs": (tracks, [
            quality.not_empty(), quality.no_nulls("title"), quality.lowest("duration", lambda v: v > 0),
            quality.highest("duration", lambda v: v < 1500), quality.unique("title"),
        ]),
        "part": (part, [quality.lossy_cast("p_retailprice", "decimal(18,0)")]),
        "time": (time_dimension(listened, "start_time"), [
            quality.not_empty(), quality.in_range("hour", 0, 23), quality.in_range("week", 1, 53),
            quality.in_range("weekday", 0, 6), quality.highest("year", lambda v: v < 2030),
        ]),
        "plays": (listened, [
            quality.references("userId", people, "user_id"), quality.references("song", some_titles, "p_name"),
        ]),
        "country": (countries(spark, sf_dir), [quality.not_empty(), quality.max_length("country_code", 3)]),
    })
