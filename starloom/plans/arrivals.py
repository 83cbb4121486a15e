"""Cleaning, enriching and aggregating arrival records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions import (
    date_from_days,
    flag_equals,
    is_present,
    label_when,
    map_codes,
    normalize_codes,
    null_if,
    parse_date,
    title_trim,
    to_long,
    value_or,
)
from starloom.operators.dedup import distinct_dimension, top_n_per_key
from starloom.operators.joins import enrich, keep_if_valid
from starloom.operators.projection import cast_columns, rename
from starloom.operators.windows import count_previous
from starloom.scale import stored
from starloom.sources.manifest import KEEP_VERSIONS, Change, Store, partition_values
from starloom.sources.readers import read_csv

# Raw field names and the names they get here.
FIELD_NAMES = {
    "i94yr": "year",
    "i94mon": "month",
    "i94cit": "country_citizenship_id",
    "i94res": "country_residence_id",
    "i94port": "entry_port",
    "i94addr": "destination_state",
    "i94mode": "travel_mode",
    "i94bir": "age",
    "i94visa": "visa_category",
    "visatype": "visa_type",
    "matflag": "dates_match_flag",
    "arrdate": "arrival_date",
    "depdate": "departure_date",
    "dtaddto": "permitted_date",
}
# Raw fields that keep their names.
OTHER_FIELDS = ("admnum", "gender", "entdepa", "entdepd", "entdepu")

# Codes and labels of the record format.
DURATION_OF_STATUS = "D/S"
GENDERS = ("F", "M")
MODES = {1: "Air", 2: "Sea", 3: "Land"}
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}

# The columns of the fact and of the feature table.
FACT_COLUMNS = (
    "admnum", "year", "month", "day", "arrival_date", "departure_date", "permitted_date", "unrestricted_stay",
    "country_citizenship", "country_residence", "port_name", "destination_state", "age", "gender",
    "num_previous_stays", "visa_type", "visa_category", "is_overstay",
)
FEATURE_COLUMNS = (
    "month", "day", "country_citizenship", "country_citizenship_gdp", "country_residence", "country_residence_gdp",
    "age", "gender", "num_previous_stays", "visa_type", "destination_state", "is_overstay",
)


@dataclass(frozen=True)
class Dimensions:
    """Lookup tables of the arrivals domain."""

    countries: DataFrame  # country_id, country_code, country_name
    iso: DataFrame  # country_code, country_name, country_code_iso_2, continent
    gdp: DataFrame  # country_code, country_name, year, gdp_value
    states: DataFrame  # state_code, state_name
    ports: DataFrame  # port_id, port_name


def typed_arrivals(raw: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Renamed, typed and labelled arrivals; a pure projection of the raw records."""
    named = rename(raw.select(*OTHER_FIELDS, *FIELD_NAMES, *tie), FIELD_NAMES)
    counts = ["year", "month", "age", "travel_mode", "visa_category", "country_citizenship_id", "country_residence_id"]
    typed = cast_columns(named, dict.fromkeys(counts, "int")).withColumns({
        "admnum": null_if(to_long("admnum"), 0),
        "unrestricted_stay": flag_equals("permitted_date", DURATION_OF_STATUS),
        "permitted_date": parse_date("permitted_date"),
        "arrival_date": date_from_days("arrival_date"),
        "departure_date": date_from_days("departure_date"),
        "gender": normalize_codes("gender", GENDERS),
        "dates_match_flag": is_present("dates_match_flag"),
        "travel_mode": map_codes("travel_mode", MODES),
        "visa_category": map_codes("visa_category", VISA_CATEGORIES),
    })
    return typed.withColumns({
        "day": F.dayofmonth("arrival_date"),
        "is_overstay": label_when(
            ~F.col("dates_match_flag")
            & ~F.col("unrestricted_stay")
            & F.col("departure_date").isNull()
            & F.col("entdepd").isNull()
            & F.col("entdepu").isNull()
        ),
    })


def clean_arrivals(raw: DataFrame, tie: Sequence[str] = (), previous_of_unknown: bool = False, **window_options) -> DataFrame:
    """Typed arrivals with each person's number of earlier ones.

    ``tie`` orders arrivals of one person on one day; it defaults to the other
    dates and flags of the record. ``previous_of_unknown`` counts earlier
    arrivals among records without a person id instead of giving them 0.
    """
    return counted_arrivals(typed_arrivals(raw, tie), tie, previous_of_unknown, **window_options)


def counted_arrivals(typed: DataFrame, tie: Sequence[str] = (), previous_of_unknown: bool = False, **window_options) -> DataFrame:
    """:func:`clean_arrivals` of records that are typed already."""
    order = list(tie) or ["departure_date", "permitted_date", "entdepa", "entdepd", "entdepu"]
    counted = count_previous(typed, "admnum", ["arrival_date"], order, "num_previous_stays", previous_of_unknown, **window_options)
    return counted.withColumn("admnum", value_or("admnum", 0))


def latest_gdp(gdp: DataFrame) -> DataFrame:
    """The newest figure per country."""
    return top_n_per_key(gdp, ["country_code"], [F.desc("year"), F.desc_nulls_last("gdp_value")])


def match_countries(ids: DataFrame, iso: DataFrame) -> DataFrame:
    """Numeric country ids with their ISO codes, matched by cleaned name.

    Both sides are lookup tables; resolving names here keeps text functions and
    two of four joins off the arrivals.
    """
    named = ids.select(F.col("country_id").try_cast("int").alias("country_id"), title_trim("country_name").alias("_name"))
    return named.join(iso, F.col("_name") == F.col("country_name")).select("country_id", "country_code", "country_name")


def read_dimensions(spark: SparkSession, folder: str, gdp_via_float: bool = False) -> Dimensions:
    """The five lookup CSV files, cleaned."""
    iso = rename(
        read_csv(spark, f"{folder}/country_iso.csv"),
        {"name": "country_name", "alpha-2": "country_code_iso_2", "alpha-3": "country_code", "region": "continent"},
    ).select("country_code", "country_name", "country_code_iso_2", "continent")
    gdp = rename(
        read_csv(spark, f"{folder}/gdp.csv"),
        {"Country Name": "country_name", "Country Code": "country_code", "Year": "year", "Value": "gdp_value"},
    ).withColumns({
        "year": F.col("year").try_cast("int"),
        "gdp_value": to_long("gdp_value", gdp_via_float),
        "country_name": F.initcap("country_name"),
    })
    return Dimensions(
        countries=match_countries(read_csv(spark, f"{folder}/country_ids.csv"), iso),
        iso=iso,
        gdp=latest_gdp(gdp),
        states=read_csv(spark, f"{folder}/states.csv"),
        ports=read_csv(spark, f"{folder}/ports.csv"),
    )


def enrich_arrivals(clean: DataFrame, dims: Dimensions, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    """Resolve codes; arrivals whose countries do not resolve are dropped."""
    ports = dims.ports.withColumn("port_name", F.trim("port_name"))
    out = clean
    for role in ("citizenship", "residence"):
        out = enrich(out, dims.countries, f"country_{role}_id", "country_id", {"country_code": f"country_{role}"}, required=True)
    out = keep_if_valid(out, "destination_state", dims.states, "state_code")
    out = enrich(out, ports, "entry_port", "port_id", {"port_name": "port_name"})
    return out.select(*columns)


def dropped_arrivals(clean: DataFrame, countries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Arrivals that :func:`enrich_arrivals` drops, counted per role and country id, without one included.

    An arrival with two unknown countries counts in both roles. Rows collapse to ids before the lookup.
    """
    known = countries.select(F.col("country_id").alias("_known"))
    roles = []
    for role in ("citizenship", "residence"):
        ids = clean.groupBy(F.col(f"country_{role}_id").alias("country_id"), *by).agg(F.count("*").alias("n"))
        roles.append(ids.join(known, F.col("country_id") == F.col("_known"), "left_anti").withColumn("role", F.lit(role)))
    return reduce(DataFrame.unionByName, roles)


def visa_types(fact: DataFrame) -> DataFrame:
    return distinct_dimension(fact, ["visa_type", "visa_category"])


def ml_features(fact: DataFrame, gdp: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Model input: the fact with the GDP of both countries."""
    out = fact
    for role in ("citizenship", "residence"):
        out = enrich(out, gdp, f"country_{role}", "country_code", {"gdp_value": f"country_{role}_gdp"})
    return out.select(*columns)


def daily_counts(fact: DataFrame, countries: DataFrame, code: str = "country_citizenship", key: str = "country_code",
                 label: str = "country_code_iso_2") -> DataFrame:
    """Arrivals per country and day; countries without a row in the dimension are left out.

    Arrivals are counted per code and day before they meet the dimension.
    """
    days = ["year", "month", "day"]
    per_code = fact.groupBy(F.col(code).alias("_code"), *days).agg(F.count("*").alias("n"))
    side = countries.select(F.col(key).alias("_key"), F.col(label).alias(label))
    joined = per_code.join(side, F.col("_code") == F.col("_key"))
    return joined.groupBy(label, *days).agg(F.sum("n").alias("count"))


class SplitDayError(ValueError):
    """A person's arrivals of one day lie in a batch and in stored partitions that it does not replace, so their order is unknown."""


def stays(typed: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Arrivals per known person and day, before any are dropped for their countries."""
    days = list(dict.fromkeys(["admnum", "arrival_date", *partition_by]))
    return typed.where(F.col("admnum").isNotNull()).groupBy(*days).agg(F.count("*").alias("n"))


def _timeline(change: Change, visits: DataFrame, partition_by: Sequence[str], touched: set) -> DataFrame:
    """What a batch means for the persons in it, and what it means for their stored arrivals.

    A row per person and day: of the batch with ``earlier``, the stored stays
    before it, and of the store with ``shift``, by how much the number of
    earlier stays changes. Stays of partitions that the batch replaces count as
    taken away. A person's days are summed along one window, a row per day, so
    nothing is paired. Of the ledger, a row per person and day, only those of the batch's persons are shuffled.
    """
    gone_units = change.units_of("stays", partition_by, touched)
    gone = change.read("stays", gone_units)
    moved = visits.withColumn("kind", F.lit("batch")).unionByName(gone.withColumn("kind", F.lit("gone"))).where("arrival_date IS NOT NULL")
    persons = moved.select("admnum").distinct()
    others = [u for u in change.units["stays"] if u not in set(gone_units)]
    prior = change.read("stays", others).where("arrival_date IS NOT NULL").join(persons, "admnum", "left_semi")
    days = moved.unionByName(prior.withColumn("kind", F.lit("stored")))
    is_stored = F.col("kind") == "stored"
    before = Window.partitionBy("admnum").orderBy(F.unix_date("arrival_date")).rangeBetween(Window.unboundedPreceding, -1)
    same_day = Window.partitionBy("admnum").orderBy(F.unix_date("arrival_date")).rangeBetween(0, 0)
    change_of = F.when(is_stored, 0).when(F.col("kind") == "gone", -F.col("n")).otherwise(F.col("n"))
    return (
        days.withColumns({"stored_n": F.when(is_stored, F.col("n")).otherwise(0), "change_n": change_of})
        .withColumns({
            "earlier": F.coalesce(F.sum("stored_n").over(before), F.lit(0)),
            "shift": F.coalesce(F.sum("change_n").over(before), F.lit(0)),
            "split": (F.col("kind") == "batch") & (F.sum("stored_n").over(same_day) > 0),
        })
        .where((F.col("kind") == "batch") | is_stored & (F.col("shift") != 0))
        .select("admnum", "arrival_date", *partition_by, "kind", "earlier", "shift", "split")
    )


def _shifted(fact: DataFrame, moved: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Stored arrivals with their numbers of earlier stays moved."""
    keys = list(dict.fromkeys(["admnum", "arrival_date", *partition_by]))
    by = moved.select(*[F.col(c).alias(f"_{c}") for c in keys], "shift")
    joined = fact.join(by, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]), "left")
    count = (F.col("num_previous_stays") + F.coalesce("shift", F.lit(0))).cast(fact.schema["num_previous_stays"].dataType)
    return joined.withColumn("num_previous_stays", count).select(*fact.columns)


def _together(*steps: Callable[[], object]) -> None:
    """Run steps that do not depend on each other at one time: the small ones wait for the driver more than for tasks."""
    with ThreadPoolExecutor(len(steps)) as pool:
        begun = [pool.submit(inheritable_thread_target(step)) for step in steps]
    for step in begun:
        step.result()


def run(
    spark: SparkSession,
    raw: DataFrame,
    dims: Dimensions,
    out: str,
    tie: Sequence[str] = (),
    partition_by: Sequence[str] = ("year", "month", "day"),
    writer: str = "",
    batch: int | None = None,
    keep: int = KEEP_VERSIONS,
) -> int:
    """Raw records to the fact, its dimensions and the feature table; returns the version that holds them.

    ``out`` is a store (:mod:`starloom.sources.manifest`): all outputs of a run
    appear in one commit or not at all, and :func:`output` reads them. ``writer``
    and ``batch`` name a run, so that one that is committed is not done again.

    A run replaces the partitions of its own days in the fact, the ledger of
    stays, the feature table, the counts and the report of dropped arrivals, and adds new visa types. Days may
    come in any order, and again with other records: where later days of the
    batch's persons are stored already, their numbers of earlier stays are moved
    and only their partitions are written anew, so that the tables equal one
    full load. Records without a date count only inside their batch. One case is
    refused, with :class:`SplitDayError` and before anything counts: a person's arrivals
    of one day in two partitions that are loaded apart.
    """
    change = Store(spark, out).begin(writer, batch)
    if change is None:
        return Store(spark, out).versions()[-1]
    parts = list(partition_by)
    typed = stored(typed_arrivals(raw, tie), "typed")
    touched = partition_values(typed, parts)
    visits = stays(typed, parts)
    clean = counted_arrivals(typed, tie)
    late: set = set()
    shifts: list[Callable[[], object]] = []
    if change.has("stays"):
        visits = stored(visits, "visits")
        timeline = stored(_timeline(change, visits, parts, touched), "timeline")
        split = timeline.where("split").limit(1).collect()
        if split:
            raise SplitDayError(f"person {split[0]['admnum']} arrives on {split[0]['arrival_date']} in two partitions")
        # a person and day may lie in several partitions of one batch; the stays before it are the same
        earlier = timeline.where("kind = 'batch' AND earlier > 0").groupBy("admnum", "arrival_date").agg(F.max("earlier").alias("_earlier"))
        count = F.col("num_previous_stays") + F.coalesce("_earlier", F.lit(0))
        clean = clean.join(earlier, ["admnum", "arrival_date"], "left").withColumn("num_previous_stays", count).select(*clean.columns)
        moved = timeline.where("kind = 'stored'")
        late = partition_values(moved, parts)
        if late:
            before = change.read("immigration", change.units_of("immigration", parts, late))
            shifts = [lambda: change.replace("immigration", _shifted(before, moved, parts), parts)]
    # dropped arrivals are counted before the window: it neither drops nor adds any
    _together(
        lambda: change.replace("immigration", enrich_arrivals(clean, dims), parts, change.units_of("immigration", parts, touched)),
        *shifts,
        lambda: change.replace("dropped", dropped_arrivals(typed, dims.countries, parts), parts, change.units_of("dropped", parts, touched)),
        lambda: change.replace("stays", visits, parts, change.units_of("stays", parts, touched)),
        *[lambda n=name, d=dimension: change.replace(n, d) for name, dimension in {"country": dims.iso, "state": dims.states, "gdp": dims.gdp}.items()],
    )
    fact = change.read("immigration", change.units_of("immigration", parts, touched))
    seen = visa_types(fact)
    types = seen.unionByName(change.read("visa_type")).distinct() if change.has("visa_type") else seen
    changed = change.read("immigration", change.units_of("immigration", parts, touched | late))
    features = ml_features(changed, change.read("gdp"), list(dict.fromkeys([*FEATURE_COLUMNS, *parts])))
    _together(
        lambda: change.replace("visa_type", types),
        # the fact is read partition by partition, so its features are written as they lie
        lambda: change.replace("ml_data", features, parts, change.units_of("ml_data", parts, touched | late), even=False),
        lambda: change.replace("immigration_stats", daily_counts(fact, dims.iso), parts, change.units_of("immigration_stats", parts, touched)),
    )
    return change.commit(keep)


def output(spark: SparkSession, out: str, name: str, version: int | None = None) -> DataFrame:
    """A table that :func:`run` has written, as of the newest commit or an earlier one."""
    return Store(spark, out).read(name, version)
