"""Queries for column functions, filters and projections (P, E)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import (
    date_from_days,
    epoch_seconds,
    flag_equals,
    hash_key,
    impute,
    is_present,
    map_codes,
    normalize_codes,
    null_if,
    parse_date,
    title_trim,
    to_long,
    value_or,
)
from starloom.operators.joins import keep_if_valid
from starloom.operators.projection import cast_columns, differing, first_rows, lookup, members, rename
from starloom.plans.arrivals import GENDERS, MODES, VISA_CATEGORIES, match_countries
from starloom.plans.listening import time_dimension
from starloom.suite.registry import query
from starloom.suite.views import CLEAN_SQL, RAW_SQL, dimensions, raw_arrivals, table


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_returnflag = 'N' AND l_linestatus = 'O' AND NOT l_tax > 0.045""")
def predicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    unreturned = F.col("l_returnflag") == "N"
    open_line = F.col("l_linestatus") == "O"
    taxed = F.col("l_tax") > 0.045
    return table(spark, sf_dir, "lineitem").where(unreturned & open_line & ~taxed).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def member_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return members(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(f"WITH {RAW_SQL} SELECT cicid, i94cit, i94res FROM raw WHERE i94cit <> i94res")
def cross_column_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differing(raw_arrivals(spark, sf_dir).select("cicid", "i94cit", "i94res"), "i94cit", "i94res")


@query(f"""WITH {RAW_SQL}
SELECT (matflag IS NULL) AS no_match, (depdate IS NULL) AS not_departed, count(*) AS n
FROM raw WHERE i94cit IS NOT NULL AND gender IS NULL GROUP BY ALL""")
def null_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = raw_arrivals(spark, sf_dir).where(F.col("i94cit").isNotNull() & F.col("gender").isNull())
    return kept.groupBy(F.col("matflag").isNull().alias("no_match"), F.col("depdate").isNull().alias("not_departed")).agg(
        F.count("*").alias("n")
    )


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup(table(spark, sf_dir, "orders"), o_orderstatus="F", o_orderpriority="1-URGENT")
    return found.select("o_orderkey", "o_custkey")


@query("SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_name LIMIT 10")
def first_rows_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), 10, ["c_name"])


@query("""
SELECT o_orderkey AS order_id, o_custkey::INTEGER AS user_id, try_cast(o_orderstatus AS INTEGER) AS status_code,
       try_cast(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
       trunc((o_totalprice * 100000)::FLOAT)::BIGINT AS total_single, trunc(o_totalprice)::BIGINT AS total_double
FROM orders""")
def rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumns({
        "priority": F.substring("o_orderpriority", 1, 1),
        "total_single": to_long(F.col("o_totalprice") * 100000, via_float=True),
        "total_double": to_long("o_totalprice"),
    })
    named = rename(orders, {"o_orderkey": "order_id", "o_custkey": "user_id", "o_orderstatus": "status_code"})
    return cast_columns(named, {"user_id": "int", "status_code": "int", "priority": "int"}).select(
        "order_id", "user_id", "status_code", "priority", "total_single", "total_double"
    )


_TIME_SQL = """
SELECT {distinct} start_time, hour(t)::INTEGER AS hour, day(t)::INTEGER AS day, week(t)::INTEGER AS week,
       month(t)::INTEGER AS month, year(t)::INTEGER AS year, ({weekday})::INTEGER AS weekday
FROM (SELECT epoch_us(ts) // 1000000 AS start_time, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS t FROM events)"""


def _event_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(epoch_seconds(ms).alias("seconds"))


@query(_TIME_SQL.format(distinct="DISTINCT", weekday="dayofweek(t)"))
def time_dimension_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_dimension(_event_seconds(spark, sf_dir), "seconds")


@query(_TIME_SQL.format(distinct="", weekday="isodow(t) - 1"))
def time_dimension_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_dimension(_event_seconds(spark, sf_dir), "seconds", week_start="monday", distinct=False)


@query(f"WITH {CLEAN_SQL} SELECT cicid, arrival_date::VARCHAR AS arrival, departure_date::VARCHAR AS departure FROM clean", name="date_from_days")
def dates_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_arrivals(spark, sf_dir).select(
        "cicid",
        date_from_days("arrdate").cast("string").alias("arrival"),
        date_from_days("depdate").cast("string").alias("departure"),
    )


@query(f"""WITH {CLEAN_SQL}
SELECT cicid, permitted_date::VARCHAR AS permitted, unrestricted_stay, coalesce(admnum, 0) AS admnum,
       admnum IS NOT NULL AS known FROM clean""")
def parse_date_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = null_if(to_long("admnum"), 0)
    return raw_arrivals(spark, sf_dir).select(
        "cicid",
        parse_date("dtaddto").cast("string").alias("permitted"),
        flag_equals("dtaddto", "D/S").alias("unrestricted_stay"),
        value_or(known, 0).alias("admnum"),
        is_present(known).alias("known"),
    )


@query("""
SELECT c_custkey, CASE WHEN g IS NULL THEN 'UNSPECIFIED' WHEN g IN ('F', 'M') THEN g ELSE 'OTHER' END AS gender
FROM (SELECT c_custkey, nullif(substr(c_mktsegment, 1, 1), 'A') AS g FROM customer)""", name="normalize_codes")
def normalized_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.nullif(F.substring("c_mktsegment", 1, 1), F.lit("A"))
    return table(spark, sf_dir, "customer").select("c_custkey", normalize_codes(code, GENDERS).alias("gender"))


@query(f"WITH {CLEAN_SQL} SELECT cicid, travel_mode, visa_category, dates_match_flag FROM clean", name="map_codes")
def mapped_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_arrivals(spark, sf_dir).select(
        "cicid",
        map_codes(F.col("i94mode").cast("int"), MODES).alias("travel_mode"),
        map_codes(F.col("i94visa").cast("int"), VISA_CATEGORIES).alias("visa_category"),
        is_present("matflag").alias("dates_match_flag"),
    )


@query("SELECT c_custkey::INTEGER AS country_id, c_mktsegment AS country_code, c_name AS country_name FROM customer")
def title_trim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    ids = customer.select(
        F.col("c_custkey").cast("string").alias("country_id"), F.concat(F.upper("c_name"), F.lit("  ")).alias("country_name")
    )
    names = customer.select(F.col("c_mktsegment").alias("country_code"), F.col("c_name").alias("country_name"))
    return match_countries(ids, names)


@query("SELECT n_nationkey, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS title, lower(n_name) AS low FROM nation")
def title_lower_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col("n_name"), F.lit(" "))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", title_trim(padded).alias("title"), F.lower("n_name").alias("low")
    )


@query("""
SELECT md5(l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR || '|' || l_partkey::VARCHAR || '|' ||
           coalesce(nullif(l_returnflag, 'R'), '\\N') || '|' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')) AS play_id,
       l_orderkey, l_linenumber
FROM lineitem""", name="hash_key")
def hashed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.nullif(F.col("l_returnflag"), F.lit("R"))
    return table(spark, sf_dir, "lineitem").select(
        hash_key("l_orderkey", "l_linenumber", "l_partkey", flag, "l_shipdate", timestamps=["l_shipdate"]).alias("play_id"),
        "l_orderkey",
        "l_linenumber",
    )


@query(f"""WITH {RAW_SQL}
SELECT cicid, 'N' || n_nationkey::VARCHAR AS i94addr FROM raw LEFT JOIN nation ON i94addr = 'N' || n_nationkey::VARCHAR""")
def null_invalid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = raw_arrivals(spark, sf_dir).select("cicid", "i94addr")
    return keep_if_valid(arrivals, "i94addr", dimensions(spark, sf_dir).states, "state_code")


@query(f"""WITH {RAW_SQL}
SELECT cicid, coalesce(i94bir, 0) AS i94bir, coalesce(gender, 'MISSING') AS gender FROM raw""")
def imputed_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute(raw_arrivals(spark, sf_dir).select("cicid", "i94bir", "gender"), {"i94bir": 0.0, "gender": "MISSING"})
