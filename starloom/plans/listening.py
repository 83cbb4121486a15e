"""Star schema and analysis of a listening log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import epoch_seconds, epoch_timestamp, hash_key, time_parts
from starloom.operators.dedup import distinct_dimension, latest_per_key, one_per_key, with_row_id
from starloom.operators.joins import attribute_join, lookup_join
from starloom.operators.projection import project
from starloom.sources.readers import read_json
from starloom.sources.writers import stage, write_parquet

# The fields of the two raw record kinds, and the action of a play.
LOG_SCHEMA = (
    "artist string, auth string, firstName string, gender string, itemInSession int, lastName string, "
    "length double, level string, location string, method string, page string, registration string, "
    "sessionId int, song string, status int, ts bigint, userAgent string, userId string"
)
SONG_SCHEMA = (
    "num_songs int, artist_id string, artist_name string, artist_latitude double, artist_longitude double, "
    "artist_location string, song_id string, title string, duration double, year int"
)
PLAY = "NextSong"
LEVELS = ("free", "paid")

# Durations are compared as exact decimals; floating-point equality would depend on the loader.
DURATION_TYPE = "decimal(18,5)"


def plays(log: DataFrame) -> DataFrame:
    """Log rows that are song plays, with ``start_time`` in epoch seconds."""
    return log.where(F.col("page") == PLAY).withColumn("start_time", epoch_seconds("ts"))


# A user's states by time; all columns take part, so a tie on time is still decided.
USER_ORDER = ["ts", "level", "first_name", "last_name", "gender"]


def user_states(log: DataFrame) -> DataFrame:
    """What the plays say of their users, with the time they say it."""
    return project(
        log.where((F.col("page") == PLAY) & F.col("userId").isNotNull() & (F.col("userId") != "")),
        {
            "user_id": F.col("userId"),
            "first_name": F.col("firstName"),
            "last_name": F.col("lastName"),
            "gender": F.col("gender"),
            "level": F.col("level"),
            "ts": F.col("ts"),
        },
    )


def users(log: DataFrame, rule: str = "latest") -> DataFrame:
    """User dimension of the plays.

    ``latest`` keeps a user's last state, ``one`` a fixed but arbitrary row, and
    ``distinct`` every state, so a user may occur at both levels.
    """
    named = user_states(log)
    if rule == "latest":
        return latest_per_key(named, ["user_id"], USER_ORDER).drop("ts")
    if rule == "one":
        return one_per_key(named.drop("ts"), ["user_id"])
    if rule == "distinct":
        return named.drop("ts").distinct()
    raise ValueError(f"unknown rule {rule!r}")


def songs(catalog: DataFrame, rule: str = "one") -> DataFrame:
    columns = ["song_id", "title", "artist_id", "year", "duration"]
    known = catalog.where(F.col("song_id").isNotNull())
    if rule == "distinct":
        return distinct_dimension(known, columns)
    return one_per_key(known.select(*columns), ["song_id"])


def artists(catalog: DataFrame, rule: str = "one") -> DataFrame:
    named = project(
        catalog.where(F.col("artist_id").isNotNull()),
        {
            "artist_id": F.col("artist_id"),
            "name": F.col("artist_name"),
            "location": F.col("artist_location"),
            "latitude": F.col("artist_latitude"),
            "longitude": F.col("artist_longitude"),
        },
    )
    return named.distinct() if rule == "distinct" else one_per_key(named, ["artist_id"])


def time_dimension(df: DataFrame, seconds: str | Column, week_start: str = "sunday", distinct: bool = True) -> DataFrame:
    """Calendar parts per epoch second; one row per second unless ``distinct`` is off.

    Seconds are made distinct before the parts are computed: the narrow column
    is what gets shuffled.
    """
    start = df.select((F.col(seconds) if isinstance(seconds, str) else seconds).alias("start_time"))
    if distinct:
        start = start.distinct()
    return start.select("start_time", *[
        c.alias(name) for name, c in time_parts(epoch_timestamp("start_time"), week_start).items()
    ])


def build_fact(
    log: DataFrame,
    catalog: DataFrame,
    match: str = "lookup",
    row_id: str = "hash",
    extra: Sequence[str] = ("location", "userAgent"),
    **join_options: int,
) -> DataFrame:
    """Song-play fact.

    ``match`` decides how a play finds its song:

    * ``lookup``: title, artist and duration, at most one song, every play kept.
    * ``inner``: title and artist, every matching song, unmatched plays dropped.
    * ``left``: title, artist and duration, every matching song, every play kept.
    """
    played = plays(log)
    found = ["song_id", "artist_id"]
    two = {"song": "title", "artist": "artist_name"}
    three = {**two, "length": "duration"}
    exact = {"length": DURATION_TYPE}
    if match == "lookup":
        matched = lookup_join(played, catalog, three, found, found, exact, **join_options)
    elif match == "inner":
        matched = attribute_join(played, catalog, two, "inner", keep=found, **join_options)
    elif match == "left":
        matched = attribute_join(played, catalog, three, "left", exact, keep=found, **join_options)
    else:
        raise ValueError(f"unknown match {match!r}")
    fact = project(
        matched,
        {
            "start_time": F.col("start_time"),
            "user_id": F.col("userId"),
            "level": F.col("level"),
            "song_id": F.col("song_id"),
            "artist_id": F.col("artist_id"),
            "session_id": F.col("sessionId"),
            "item": F.col("itemInSession"),
            **{c: F.col(c) for c in extra},
        },
    ).withColumnsRenamed({"userAgent": "user_agent"})
    if row_id == "sequence":
        return with_row_id(fact, "play_id")
    return fact.withColumn("play_id", hash_key("start_time", "user_id", "session_id", "item", "song_id"))


def count_by(
    fact: DataFrame,
    fact_key: str,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[str],
    name: str = "num_listens",
) -> DataFrame:
    """Fact rows per dimension attributes.

    The fact collapses to counts per key before it meets the dimension, so the
    join is as small as the dimension and a popular key weighs one row. Equal
    to joining first, also where the dimension repeats a key.
    """
    per_key = fact.where(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("_fk")).agg(F.count("*").alias("_n"))
    side = dimension.select(F.col(key).alias("_pk"), *[F.col(a).alias(f"_a_{a}") for a in attributes])
    joined = per_key.join(side, F.col("_fk") == F.col("_pk"))
    return joined.groupBy(*[F.col(f"_a_{a}").alias(a) for a in attributes]).agg(F.sum("_n").alias(name))


def top(counts: DataFrame, n: int, ascending: bool = False, name: str = "num_listens") -> DataFrame:
    """First ``n`` by count; the other columns break ties."""
    by = F.asc(name) if ascending else F.desc(name)
    return counts.orderBy(by, *[c for c in counts.columns if c != name]).limit(n)


def top_songs(fact: DataFrame, song_dim: DataFrame, n: int = 10) -> DataFrame:
    return top(count_by(fact, "song_id", song_dim, "song_id", ["song_id", "title"]), n)


def top_artists(fact: DataFrame, artist_dim: DataFrame, n: int = 10, ascending: bool = False) -> DataFrame:
    return top(count_by(fact, "artist_id", artist_dim, "artist_id", ["artist_id", "name"]), n, ascending)


def top_users(fact: DataFrame, user_dim: DataFrame, n: int = 100) -> DataFrame:
    return top(count_by(fact, "user_id", user_dim, "user_id", ["user_id", "first_name", "last_name", "level"]), n)


def plays_on(fact: DataFrame, time_dim: DataFrame, year: int, month: int, day: int) -> DataFrame:
    """Number of plays on one date."""
    days = time_dim.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
    counted = count_by(fact, "start_time", days, "start_time", ["day"])
    return counted.agg(F.coalesce(F.sum("num_listens"), F.lit(0)).alias("num_listens"))


def plays_by_weekday(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    return count_by(fact, "start_time", time_dim, "start_time", ["weekday"]).orderBy("weekday")


def plays_by_month(fact: DataFrame, time_dim: DataFrame, year: int, n: int = 10) -> DataFrame:
    months = time_dim.where(F.col("year") == year)
    return top(count_by(fact, "start_time", months, "start_time", ["year", "month"]), n)


def query_table(
    rows: DataFrame,
    partition_key: Sequence[str],
    cluster_key: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Table shaped for one question: a row per key, the latest by ``order``."""
    key = [*partition_key, *cluster_key]
    needed = [*key, *[c for c in (*columns, *order) if c not in key]]
    latest = latest_per_key(rows.select(*dict.fromkeys(needed)), key, order)
    return latest.select(*key, *[c for c in columns if c not in key])


def write_query_table(table: DataFrame, path: str, partition_key: Sequence[str], cluster_key: Sequence[str]) -> None:
    """Write clustered by key: range partitions give narrow min/max per file.

    The range covers the cluster key too, so one large partition key spreads
    over files instead of landing in one task.
    """
    key = [*partition_key, *cluster_key]
    table.repartitionByRange(*key).sortWithinPartitions(*key).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, log_path: str, song_path: str, out: str, match: str = "lookup") -> None:
    """Raw JSON to the five Parquet tables.

    Both inputs serve several tables: they are staged as Parquet, so each JSON
    record is parsed once and every table reads only its columns.
    """
    catalog = stage(read_json(spark, song_path, SONG_SCHEMA), f"{out}/staging/songs")
    log = stage(read_json(spark, log_path, LOG_SCHEMA).where(F.col("page") == PLAY), f"{out}/staging/plays")
    write_parquet(songs(catalog), f"{out}/songs", ["year"])
    write_parquet(artists(catalog), f"{out}/artists", compact=True)
    write_parquet(users(log), f"{out}/users", compact=True)
    write_parquet(time_dimension(plays(log), "start_time"), f"{out}/time", ["year", "month"])
    moment = epoch_timestamp("start_time")
    fact = build_fact(log, catalog, match).withColumns({"year": F.year(moment), "month": F.month(moment)})
    write_parquet(fact, f"{out}/songplays", ["year", "month"])
