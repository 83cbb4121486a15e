"""The listening tables kept current step by step.

A step takes the log records, or the songs, that arrived since the last one. It
brings the fact and every dimension up to date, checks what it is about to add, and commits all
tables at once. A step whose checks fail, or that dies on its way, leaves
nothing behind, and its files come again with the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import epoch_timestamp
from starloom.operators import quality as q
from starloom.operators.dedup import first_per_key, one_per_key
from starloom.plans import listening
from starloom.scale import discard, freed_shuffles, scratch
from starloom.sources.manifest import KEEP_VERSIONS, Change, Store, partition_values
from starloom.sources.snapshots import merge, merged
from starloom.sources.writers import by_key
from starloom.streaming.incremental import load_stream

MONTH = ["year", "month"]
# What tells a play from another, and which songs it may have found.
PLAY_KEY = ["start_time", "user_id", "session_id", "item"]
_MATCHES = ["song_id", "artist_id", "title", "artist_name", "duration"]
_KEYED = ("songs", "artists", "users", "catalog")


def table(store: Store | Change, name: str) -> DataFrame:
    """One of the tables ``songplays, users, songs, artists, time``."""
    found = merged(store, name) if name in _KEYED else store.read(name)
    return found.drop("ts") if name == "users" else found


def add_songs(spark: SparkSession, songs: DataFrame, out: str, writer: str = "", batch: int | None = None, kept: int = KEEP_VERSIONS) -> int | None:
    """Bring ``songs`` and ``artists`` up to date with raw song records; the new version, or None for a batch that is in already.

    The records of an id are settled as :func:`listening.songs` and
    :func:`listening.artists` settle them, over all steps together.
    """
    change = Store(spark, out).begin(writer, batch)
    if change is None:
        return None
    with _staging(spark) as (staged, _):
        rows = staged(songs, "songs")
        for name, dimension, key in (("songs", listening.songs(rows), "song_id"), ("artists", listening.artists(rows), "artist_id")):
            merge(change, name, dimension, [key], [c for c in dimension.columns if c != key], pick=first_per_key)
            q.enforce(q.run_checks({name: (dimension, [q.unique(key), q.no_nulls(key)])}))
        # what plays look their songs up in
        merge(change, "catalog", rows.select(*_MATCHES).distinct(), _MATCHES, [], pick=first_per_key)
        return change.commit(kept)


@contextmanager
def _staging(spark: SparkSession) -> Iterator[tuple[Callable[[DataFrame, str], DataFrame], Callable[[str], None]]]:
    """How a step stages rows, and how it drops some of them early; all of them go with the step.

    They are Parquet, read by the session itself: a stream's own session plans without adaptive execution.
    """
    folder = scratch(spark, "step")

    def staged(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    try:
        with freed_shuffles(spark):
            yield staged, lambda name: discard(spark, f"{folder}/{name}")
    finally:
        discard(spark, folder)


def _unknown(change: Change, name: str, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key the table does not hold; only its units with the rows' months are read."""
    if not change.has(name):
        return rows
    near = change.read(name, change.units_of(name, MONTH, partition_values(rows, MONTH)))
    return by_key(rows, near, key, "left_anti")


def hourly_checks(change: Change, plays: DataFrame, users: DataFrame, moments: DataFrame, key: Sequence[str]) -> Mapping[str, tuple]:
    """What must hold for the rows that a step adds, against the tables as it will leave them."""
    known = {name: table(change, name) for name in ("users", "songs", "artists", "time") if change.has(name)}
    references = {"user_id": "users", "song_id": "songs", "artist_id": "artists", "start_time": "time"}
    calendar = {"hour": (0, 23), "day": (1, 31), "weekday": (0, 6), "week": (1, 53), "month": (1, 12)}
    return {
        "songplays": (plays, [
            q.unique(*key), q.no_nulls("start_time"), q.in_set("level", listening.LEVELS),
            *[q.references(c, known[t], c) for c, t in references.items() if t in known],
        ]),
        "users": (users, [q.no_nulls("user_id"), q.in_set("level", listening.LEVELS)]),
        "time": (moments, [q.unique("start_time"), *[q.in_range(c, low, high) for c, (low, high) in calendar.items()]]),
    }


def add_plays(
    spark: SparkSession,
    log: DataFrame,
    out: str,
    match: str = "lookup",
    writer: str = "",
    batch: int | None = None,
    kept: int = KEEP_VERSIONS,
) -> int | None:
    """Bring the fact, ``users`` and ``time`` up to date with raw log records; the new version, or None for a batch that is in already.

    A play that is stored is not added again, whichever stream it comes by. A
    user keeps the last state, also when an older one arrives later. Raises
    :class:`~starloom.operators.quality.QualityError`, with nothing committed, when a check fails.
    """
    change = Store(spark, out).begin(writer, batch)
    if change is None:
        return None
    with _staging(spark) as (staged, done):
        rows = staged(log.where(F.col("page") == listening.PLAY), "plays")
        known = merged(change, "catalog") if change.has("catalog") else spark.createDataFrame([], listening.SONG_SCHEMA).select(*_MATCHES)
        moment = epoch_timestamp("start_time")
        months = {"year": F.year(moment), "month": F.month(moment)}
        if match == "lookup":
            # a song is no part of the key: stored plays are left out before they are matched
            named = listening.plays(rows).withColumns({"user_id": F.col("userId"), "session_id": F.col("sessionId"), "item": F.col("itemInSession")})
            new, key = _unknown(change, "songplays", named.withColumns(months), PLAY_KEY), PLAY_KEY
            fact = listening.build_fact(new.select(*rows.columns), known, match).withColumns(months)
            fresh = one_per_key(fact, key)
        else:
            key = [*PLAY_KEY, "song_id"]
            fact = listening.build_fact(rows, known, match).withColumns(months)
            fresh = _unknown(change, "songplays", one_per_key(fact, key), key)
        fresh = staged(fresh, "fresh")
        states = staged(listening.latest_per_key(listening.user_states(rows), ["user_id"], listening.USER_ORDER), "states")
        moments = _unknown(change, "time", listening.time_dimension(listening.plays(rows), "start_time"), ["start_time"])
        moments = staged(moments, "moments")
        done("plays")
        merge(change, "users", states, ["user_id"], listening.USER_ORDER)
        change.append("time", moments, MONTH)
        change.append("songplays", fresh, MONTH)
        q.enforce(q.run_checks(hourly_checks(change, fresh, states, moments, key)))
        for name in ("time", "songplays"):
            change.compact(name, MONTH)
        return change.commit(kept)


def run(
    spark: SparkSession, log_path: str, song_path: str, out: str, progress: str, match: str = "lookup", max_files: int | None = None
) -> None:
    """Load the song and log files that have not been loaded, then return.

    Songs go first, so that the plays of a step find them. ``progress`` keeps the checkpoints of the two
    streams. A step is known by its stream and number, so a replayed one is not applied twice.
    """
    failed: list[q.QualityError] = []

    def step(apply, **options):
        def sink(batch: DataFrame, number: int) -> None:
            stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
            try:
                apply(spark, batch, out, writer=stream, batch=number, **options)
            except q.QualityError as error:
                failed.append(error)
                raise

        return sink

    streams: Iterable = (
        (song_path, listening.SONG_SCHEMA, step(add_songs), f"{progress}/songs"),
        (log_path, listening.LOG_SCHEMA, step(add_plays, match=match), f"{progress}/log"),
    )
    for path, schema, sink, checkpoint in streams:
        try:
            load_stream(spark, path, schema, sink, checkpoint, max_files=max_files)
        except StreamingQueryException:
            if failed:
                raise failed[0] from None
            raise
