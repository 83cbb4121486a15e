"""Table schemas and quality checks of both domains."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starloom.operators import quality as q
from starloom.plans.listening import LEVELS
from starloom.sources.manifest import open_table

# Columns and types of the listening tables.
LISTENING_TABLES = {
    "songplays": "play_id string, start_time bigint, user_id string, level string, song_id string, artist_id string, "
    "session_id int, item int, location string, user_agent string, year int, month int",
    "users": "user_id string, first_name string, last_name string, gender string, level string",
    "songs": "song_id string, title string, artist_id string, year int, duration double",
    "artists": "artist_id string, name string, location string, latitude double, longitude double",
    "time": "start_time bigint, hour int, day int, week int, month int, year int, weekday int",
}

# Columns and types of the arrivals tables.
ARRIVALS_TABLES = {
    "country": "country_code string, country_name string, country_code_iso_2 string, continent string",
    "state": "state_code string, state_name string",
    "visa_type": "visa_type string, visa_category string",
    "gdp": "country_code string, year int, gdp_value bigint",
    "immigration": "admnum bigint, arrival_date date, year int, month int, day int, country_citizenship string, "
    "country_residence string, destination_state string, age int, gender string, visa_type string, "
    "num_previous_stays bigint, unrestricted_stay boolean, is_overstay boolean",
}

# Bounds of plausible figures.
LONGEST_SONG = 10_000
FIRST_YEAR, LAST_YEAR = 1900, 2030


def _plausible_year(value):
    return (value > FIRST_YEAR) & (value < LAST_YEAR)


def listening_checks(tables: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, list[q.Check]]]:
    """What must hold after a load; a play without a known song is fine."""
    calendar = {"hour": (0, 23), "day": (1, 31), "weekday": (0, 6), "week": (1, 53), "month": (1, 12)}
    checks = {
        "songplays": [
            q.not_empty(),
            q.unique("play_id"),
            q.references("user_id", tables["users"], "user_id"),
            q.references("song_id", tables["songs"], "song_id"),
            q.references("artist_id", tables["artists"], "artist_id"),
            q.references("start_time", tables["time"], "start_time"),
        ],
        "users": [
            q.not_empty(), *[q.no_nulls(c) for c in ("user_id", "first_name", "last_name")],
            q.in_set("level", LEVELS), q.unique("user_id"),
        ],
        "artists": [q.not_empty(), q.no_nulls("name"), q.unique("artist_id")],
        "songs": [
            q.not_empty(), q.no_nulls("title"), q.no_nulls("artist_id"), q.unique("song_id"),
            q.lowest("duration", lambda v: v > 0), q.highest("duration", lambda v: v < LONGEST_SONG),
        ],
        "time": [
            q.not_empty(), q.no_nulls("year"), *[q.no_nulls(c) for c in calendar],
            *[q.in_range(c, low, high) for c, (low, high) in calendar.items()],
            q.highest("year", _plausible_year), q.unique("start_time"),
        ],
    }
    return {name: (tables[name], found) for name, found in checks.items()}


def arrivals_checks(tables: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, list[q.Check]]]:
    """What must hold after a load. Visa types repeat where they serve several categories."""
    checks = {
        "country": [q.not_empty(), q.unique("country_code"), q.max_length("country_code", 3)],
        "state": [q.not_empty(), q.unique("state_code")],
        "visa_type": [q.not_empty(), q.unique("visa_type", "visa_category")],
        "gdp": [q.not_empty(), q.unique("country_code"), q.lowest("gdp_value", lambda v: v >= 0)],
        "immigration": [
            q.not_empty(), q.no_nulls("arrival_date"), q.lowest("num_previous_stays", lambda v: v >= 0),
            q.in_range("day", 1, 31), q.in_range("month", 1, 12), q.highest("year", _plausible_year),
            *[q.no_nulls(c) for c in ("year", "month", "day")],
            *[q.references(c, tables["country"], "country_code") for c in ("country_citizenship", "country_residence")],
            *[q.max_length(c, 3) for c in ("country_citizenship", "country_residence")], q.max_length("destination_state", 2),
            q.references("destination_state", tables["state"], "state_code"),
        ],
    }
    return {name: (tables[name], found) for name, found in checks.items()}


def read_tables(spark: SparkSession, folder: str, schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    """The named tables of a folder or a store, with the columns each has in storage."""
    return {name: open_table(spark, f"{folder}/{name}") for name in schemas}
