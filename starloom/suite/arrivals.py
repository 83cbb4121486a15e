"""Queries of the arrivals domain."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.joins import enrich
from starloom.operators.profile import days_with_rows, funnel, group_by_flag, total
from starloom.plans import arrivals as plan
from starloom.scale import scratch, stored
from starloom.sources.readers import union_frames
from starloom.sources.writers import write_parquet
from starloom.suite.registry import query
from starloom.suite.views import CLEAN_SQL, COUNTRIES_SQL, FACT_SQL, GDP_SQL, RAW_SQL, countries, dimensions, raw_arrivals

_CLEAN = "WITH " + CLEAN_SQL
_FACT = "WITH " + FACT_SQL


def _clean(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return plan.clean_arrivals(raw_arrivals(spark, sf_dir), tie=["cicid"], **options)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.typed_arrivals(raw_arrivals(spark, sf_dir), tie=["cicid"])


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.enrich_arrivals(_clean(spark, sf_dir), dimensions(spark, sf_dir), ["cicid", *plan.FACT_COLUMNS])


_DATES = ("arrival_date", "departure_date", "permitted_date")


@query(f"""{_FACT} SELECT * REPLACE (arrival_date::VARCHAR AS arrival_date, departure_date::VARCHAR AS departure_date,
  permitted_date::VARCHAR AS permitted_date) FROM fact""")
def arrivals_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in _DATES})


@query(f"{_CLEAN} SELECT cicid, is_overstay FROM clean")
def overstay_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).select("cicid", "is_overstay")


@query(f"{_CLEAN} SELECT cicid, num_previous_stays FROM clean")
def previous_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select("cicid", "num_previous_stays")


@query(f"{_CLEAN} SELECT cicid, num_previous_any AS num_previous_stays FROM clean")
def previous_visits_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir, previous_of_unknown=True).select("cicid", "num_previous_stays")


@query(f"{_CLEAN} SELECT cicid, num_previous_any AS num_previous_stays FROM clean")
def previous_visits_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``previous_visits_star``; the unknown persons, a tenth of all rows, are ranked as a heavy key."""
    out = _clean(spark, sf_dir, previous_of_unknown=True, hot_rows=1, hot_share=0.05)
    return out.select("cicid", "num_previous_stays")


@query(f"""WITH {RAW_SQL},{COUNTRIES_SQL}
SELECT cicid, c.country_code AS citizenship, r.country_code AS residence FROM raw
LEFT JOIN countries c ON i94cit = c.country_id LEFT JOIN countries r ON i94res = r.country_id""")
def enrich_two_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = countries(spark, sf_dir)
    out = raw_arrivals(spark, sf_dir).select("cicid", F.col("i94cit").cast("int"), F.col("i94res").cast("int"))
    out = enrich(out, known, "i94cit", "country_id", {"country_code": "citizenship"})
    return enrich(out, known, "i94res", "country_id", {"country_code": "residence"}).drop("i94cit", "i94res")


@query(f"""WITH {RAW_SQL},{COUNTRIES_SQL}
SELECT cicid, country_code AS residence, continent FROM raw JOIN countries ON i94res = country_id""")
def required_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raw_arrivals(spark, sf_dir).select("cicid", F.col("i94res").cast("int"))
    columns = {"country_code": "residence", "continent": "continent"}
    return enrich(out, countries(spark, sf_dir), "i94res", "country_id", columns, required=True).drop("i94res")


@query(f"""WITH {RAW_SQL},{COUNTRIES_SQL}
SELECT role, i94::INTEGER AS country_id, count(*) AS n FROM (
  SELECT 'citizenship' AS role, i94cit AS i94 FROM raw UNION ALL SELECT 'residence', i94res FROM raw)
LEFT JOIN countries c ON i94 = c.country_id WHERE c.country_id IS NULL GROUP BY ALL""")
def arrivals_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.dropped_arrivals(_typed(spark, sf_dir), countries(spark, sf_dir)).select("role", "country_id", "n")


@query(f"{_FACT} SELECT DISTINCT visa_type, visa_category FROM fact")
def visa_type_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.visa_types(_fact(spark, sf_dir))


_DAILY = """daily AS (
  SELECT country_code_iso_2, year, month, day, count(*) AS count FROM fact
  JOIN countries ON country_citizenship = country_code GROUP BY ALL)"""


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.daily_counts(_fact(spark, sf_dir), dimensions(spark, sf_dir).iso)


@query(f"{_FACT}, {_DAILY} SELECT * FROM daily")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir)


@query(f"{_FACT}, {_DAILY} SELECT country_code_iso_2, count(*) AS days FROM daily GROUP BY ALL", name="days_with_rows")
def days_with_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days_with_rows(_daily(spark, sf_dir), "country_code_iso_2")


@query(f"{_FACT}, {_DAILY} SELECT sum(count)::BIGINT AS total FROM daily")
def sum_of_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total(_daily(spark, sf_dir), "count")


@query(f"""{_FACT},{GDP_SQL}
SELECT cicid, month, day, country_citizenship, c.gdp_value AS country_citizenship_gdp, country_residence,
       r.gdp_value AS country_residence_gdp, age, gender, num_previous_stays, visa_type, destination_state, is_overstay
FROM fact LEFT JOIN gdp c ON country_citizenship = c.country_code LEFT JOIN gdp r ON country_residence = r.country_code""")
def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    gdp = stored(dimensions(spark, sf_dir).gdp, "gdp")
    return plan.ml_features(_fact(spark, sf_dir), gdp, ["cicid", *plan.FEATURE_COLUMNS])


@query(f"WITH {GDP_SQL} SELECT country_code, gdp_value FROM gdp")
def latest_gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions(spark, sf_dir).gdp.select("country_code", "gdp_value")


@query(f"""{_CLEAN}
SELECT departure_date IS NOT NULL OR entdepd IS NOT NULL AS did_depart, count(*) AS n FROM clean
WHERE dates_match_flag AND unrestricted_stay GROUP BY ALL""", name="group_by_flag")
def departed_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    matching = _typed(spark, sf_dir).where("dates_match_flag AND unrestricted_stay")
    return group_by_flag(matching, F.col("departure_date").isNotNull() | F.col("entdepd").isNotNull(), "did_depart")


@query(f"""{_CLEAN}
SELECT entdepu, count(*) AS n FROM clean
WHERE NOT dates_match_flag AND NOT unrestricted_stay AND departure_date IS NULL AND entdepd IS NULL GROUP BY ALL""")
def candidate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = _typed(spark, sf_dir).where(
        "NOT dates_match_flag AND NOT unrestricted_stay AND departure_date IS NULL AND entdepd IS NULL"
    )
    return candidates.groupBy("entdepu").agg(F.count("*").alias("n"))


# Predicates both engines read the same way.
_STEPS = {
    "late_departure": "dates_match_flag AND NOT unrestricted_stay AND departure_date > permitted_date AND entdepu IS NULL",
    "unmatched": "NOT dates_match_flag",
    "matched_not_departed": "dates_match_flag AND departure_date IS NULL",
    "matched_no_trace": "dates_match_flag AND departure_date IS NULL AND entdepd IS NULL",
    "unmatched_unrestricted": "NOT dates_match_flag AND unrestricted_stay",
    "unmatched_unrestricted_departed": "NOT dates_match_flag AND unrestricted_stay AND departure_date IS NOT NULL",
    "matched_unrestricted": "dates_match_flag AND unrestricted_stay",
    "unmatched_restricted": "NOT dates_match_flag AND NOT unrestricted_stay",
    "unmatched_restricted_departed": "NOT dates_match_flag AND NOT unrestricted_stay AND "
    "(departure_date IS NOT NULL OR entdepd IS NOT NULL)",
    "overstay_updated": "NOT dates_match_flag AND NOT unrestricted_stay AND departure_date IS NULL "
    "AND entdepd IS NULL AND entdepu IS NOT NULL",
    "overstay": "is_overstay",
}


@query(_CLEAN + " " + " UNION ALL ".join(
    f"SELECT '{name}' AS step, count(*) FILTER (WHERE {rule}) AS n FROM clean" for name, rule in _STEPS.items()
))
def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel(_typed(spark, sf_dir), {name: F.expr(rule) for name, rule in _STEPS.items()})


@query(f"""{_FACT}, {_DAILY},{GDP_SQL}
SELECT 'immigration' AS "table", count(*) AS n FROM fact
UNION ALL SELECT 'visa_type', count(DISTINCT (visa_type, visa_category)) FROM fact
UNION ALL SELECT 'ml_data', count(*) FROM fact
UNION ALL SELECT 'immigration_stats', count(*) FROM daily
UNION ALL SELECT 'country', count(*) FROM countries
UNION ALL SELECT 'state', count(*) FROM nation
UNION ALL SELECT 'gdp', count(*) FROM gdp""")
def arrivals_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records loaded to the fact, its dimensions and the derived tables, counted from storage."""
    path = scratch(spark, "arrivals")
    plan.run(spark, raw_arrivals(spark, sf_dir), dimensions(spark, sf_dir), path, ["cicid"], ["year", "month"])
    names = ["immigration", "visa_type", "ml_data", "immigration_stats", "country", "state", "gdp"]
    counts = [
        plan.output(spark, path, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        for name in names
    ]
    return union_frames(counts, ["table", "n"])


def _by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dated records, stored by year: a load of a year opens only its files."""
    raw, path = raw_arrivals(spark, sf_dir).where("arrdate >= 0"), scratch(spark, "raw")
    write_parquet(raw, path, ["i94yr"])
    return spark.read.schema(raw.schema).parquet(path)


def _settled(spark: SparkSession, sf_dir: str) -> plan.Dimensions:
    """The dimensions with the figures per country worked out once, not by every load."""
    dims = dimensions(spark, sf_dir)
    return replace(dims, gdp=stored(dims.gdp, "gdp"))


# a record without a date has no place in loads by date
_DATED = _FACT.replace("FROM raw", "FROM raw WHERE arrdate >= 0", 1)


@query(f"""{_DATED}, {_DAILY}
SELECT 'fact' AS "table", year, month, count(*) AS n, sum(num_previous_stays)::BIGINT AS stays, max(num_previous_stays)::BIGINT AS most,
  count(DISTINCT admnum) AS persons, sum(age)::BIGINT AS total, min(arrival_date)::VARCHAR AS first_date FROM fact GROUP BY ALL
UNION ALL SELECT 'immigration_stats', year, month, count(*), sum(count)::BIGINT, max(count)::BIGINT, count(DISTINCT country_code_iso_2),
  sum(day)::BIGINT, NULL FROM daily GROUP BY ALL
UNION ALL SELECT 'visa_type', NULL, NULL, count(*), NULL, NULL, count(DISTINCT visa_type), NULL, NULL
  FROM (SELECT DISTINCT visa_type, visa_category FROM fact)""")
def arrivals_daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records loaded year by year, the last year twice, against one full load."""
    path, dims = scratch(spark, "daily"), _settled(spark, sf_dir)
    raw = _by_year(spark, sf_dir)
    years = [r[0] for r in raw.select("i94yr").distinct().orderBy("i94yr").collect()]
    for year in [*years, years[-1]]:
        plan.run(spark, raw.where(F.col("i94yr") == year), dims, path, ["cicid"], ["year", "month"])
    fact, daily, visas = (plan.output(spark, path, t) for t in ("immigration", "immigration_stats", "visa_type"))
    whole = lambda c, name: c.cast("long").alias(name)
    of_fact = fact.groupBy("year", "month").agg(
        F.count("*").alias("n"), whole(F.sum("num_previous_stays"), "stays"), whole(F.max("num_previous_stays"), "most"),
        F.count_distinct("admnum").alias("persons"), whole(F.sum("age"), "total"), F.min("arrival_date").cast("string").alias("first_date"),
    )
    of_days = daily.groupBy("year", "month").agg(
        F.count("*").alias("n"), whole(F.sum("count"), "stays"), whole(F.max("count"), "most"),
        F.count_distinct("country_code_iso_2").alias("persons"), whole(F.sum("day"), "total"), F.lit(None).cast("string").alias("first_date"),
    )
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    of_visas = visas.agg(F.count("*").alias("n"), F.count_distinct("visa_type").alias("persons")).select(
        none("int", "year"), none("int", "month"), "n", none("long", "stays"), none("long", "most"), "persons", none("long", "total"),
        none("string", "first_date"),
    )
    columns = ["table", "year", "month", "n", "stays", "most", "persons", "total", "first_date"]
    frames = {"fact": of_fact, "immigration_stats": of_days, "visa_type": of_visas}
    return union_frames([df.withColumn("table", F.lit(name)) for name, df in frames.items()], columns)


_ANY_ORDER = (
    "admnum", "year", "month", "day", "arrival_date", "departure_date", "country_citizenship", "country_residence", "age", "gender",
    "visa_type", "visa_category", "destination_state", "is_overstay", "num_previous_stays",
)


@query(f"{_DATED} SELECT {', '.join(f'{c}::VARCHAR AS {c}' if c.endswith('_date') else c for c in _ANY_ORDER)} FROM fact")
def arrivals_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years loaded from the last to the first, one of them with half its records and then again with all: row by row one full load."""
    path, dims = scratch(spark, "any-order"), _settled(spark, sf_dir)
    raw = _by_year(spark, sf_dir)
    years = [r[0] for r in raw.select("i94yr").distinct().orderBy(F.desc("i94yr")).collect()]
    half = raw.where((F.col("i94yr") == years[1]) & (F.col("cicid") % 2 == 0))
    for rows in [half, *[raw.where(F.col("i94yr") == y) for y in years]]:
        plan.run(spark, rows, dims, path, ["cicid"], ["year", "month"])
    loaded = plan.output(spark, path, "immigration")
    return loaded.select(*[F.col(c).cast("string").alias(c) if c.endswith("_date") else c for c in _ANY_ORDER])


@query(f"""{_DATED}, {_DAILY},{GDP_SQL}
SELECT 'immigration' AS "table", count(*) AS n, sum(num_previous_stays)::BIGINT AS total, count(DISTINCT admnum) AS n_keys FROM fact
UNION ALL SELECT 'ml_data', count(*), sum(num_previous_stays)::BIGINT, count(DISTINCT country_citizenship) FROM fact
UNION ALL SELECT 'immigration_stats', count(*), sum(count)::BIGINT, count(DISTINCT country_code_iso_2) FROM daily
UNION ALL SELECT 'country', count(*), 0, count(DISTINCT country_code) FROM countries
UNION ALL SELECT 'gdp', count(*), sum(gdp_value)::BIGINT, count(DISTINCT country_code) FROM gdp""")
def arrivals_failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records loaded; then a load of other records that fails after its first tables leaves every table as it was."""
    path, dims = scratch(spark, "failed"), _settled(spark, sf_dir)
    raw = stored(raw_arrivals(spark, sf_dir).where("arrdate >= 0"), "raw")
    plan.run(spark, raw, dims, path, ["cicid"], ["year", "month"])
    broken = replace(dims, iso=dims.iso.withColumn("country_code", F.raise_error(F.lit("lookup is broken")).cast("string")))
    try:
        plan.run(spark, raw.where("cicid % 3 = 0"), broken, path, ["cicid"], ["year", "month"])
    except PySparkException:
        pass
    keys = {
        "immigration": ("num_previous_stays", "admnum"), "ml_data": ("num_previous_stays", "country_citizenship"),
        "immigration_stats": ("count", "country_code_iso_2"), "country": (None, "country_code"), "gdp": ("gdp_value", "country_code"),
    }
    frames = []
    for name, (value, key) in keys.items():
        total = F.sum(value).cast("long") if value else F.lit(0).cast("long")
        counted = plan.output(spark, path, name).agg(F.count("*").alias("n"), total.alias("total"), F.count_distinct(key).alias("n_keys"))
        frames.append(counted.withColumn("table", F.lit(name)))
    return union_frames(frames, ["table", "n", "total", "n_keys"])
