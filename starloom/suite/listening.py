"""Queries of the listening domain (J1-J4, J9, J11, D, F1-F5, F9, A1-A5, T1-T6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.dedup import first_per_key, top_n_per_key, with_row_id
from starloom.operators.joins import attribute_join_sums, unmatched_counts
from starloom.operators.profile import group_count
from starloom.operators.projection import lookup
from starloom.plans import listening as plan
from starloom.plans import listening_hourly as hourly
from starloom.scale import discard, freed_shuffles, scratch, stored
from starloom.sources.manifest import Store
from starloom.sources.readers import union_frames
from starloom.suite.registry import query
from starloom.suite.views import CATALOG_SQL, PLAY_LOG_SQL, catalog, play_log, table

_LOG = "WITH " + PLAY_LOG_SQL
_BOTH = _LOG + "," + CATALOG_SQL

_HASH = """md5(concat_ws('|', start_time::VARCHAR, userId, sessionId::VARCHAR, itemInSession::VARCHAR,
  coalesce(song_id, '\\N'))) AS play_id"""
_FACT = f"""{_HASH}, start_time, userId AS user_id, level, song_id, artist_id, sessionId AS session_id,
  itemInSession AS item, location, userAgent AS user_agent"""

# Row numbers stand in for the lookup's pick: the smallest song, then artist, per attribute triple.
_SINGLE = """
single AS (
  SELECT title, artist_name, duration, song_id, artist_id FROM catalog
  QUALIFY row_number() OVER (PARTITION BY title, artist_name, duration ORDER BY song_id, artist_id) = 1
)"""
_LOOKUP_JOIN = "LEFT JOIN single s ON song = title AND artist = artist_name AND length = duration"


def _fact(spark: SparkSession, sf_dir: str, match: str) -> DataFrame:
    return plan.build_fact(play_log(spark, sf_dir, with_user=True), catalog(spark, sf_dir), match)


def _thin_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact without user columns: spares the join of lines with orders."""
    return plan.build_fact(play_log(spark, sf_dir), catalog(spark, sf_dir), "lookup", extra=())


@query(f"{_BOTH} SELECT {_FACT} FROM plays JOIN catalog ON song = title AND artist = artist_name")
def songplay_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, "inner")


@query(f"""{_BOTH} SELECT {_FACT} FROM plays
LEFT JOIN catalog ON song = title AND artist = artist_name AND length = duration""")
def songplay_left_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, "left")


@query(f"{_BOTH},{_SINGLE} SELECT {_FACT} FROM plays {_LOOKUP_JOIN}")
def songplay_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, "lookup")


@query(f"""{_BOTH} SELECT song, artist, length, count(*) AS n FROM play_log p
WHERE song IS NOT NULL AND NOT EXISTS (SELECT 1 FROM catalog c WHERE p.song = c.title AND p.artist = c.artist_name
  AND p.length = c.duration) GROUP BY ALL""")
def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    on = {"song": "title", "artist": "artist_name", "length": "duration"}
    return unmatched_counts(play_log(spark, sf_dir), catalog(spark, sf_dir), on)


_USER = "userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level"


@query(f"{_LOG} SELECT DISTINCT {_USER} FROM plays")
def user_dimension_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.users(play_log(spark, sf_dir, with_user=True), "distinct")


@query(f"""{_LOG} SELECT {_USER} FROM plays
QUALIFY row_number() OVER (PARTITION BY userId ORDER BY firstName, lastName, gender, level) = 1""")
def user_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.users(play_log(spark, sf_dir, with_user=True), "one")


@query(f"""{_LOG} SELECT {_USER} FROM plays
QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts DESC, level DESC) = 1""")
def user_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.users(play_log(spark, sf_dir, with_user=True), "latest")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def user_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    first = first_per_key(
        orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
    )
    return first.drop("o_orderdate")


@query("""SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return top_n_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).drop("o_orderdate")


@query("""SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def top_three_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_n_per_key(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).drop("o_totalprice")


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.distinct_dimension(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem ORDER BY l_suppkey, l_returnflag LIMIT 10")
def distinct_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = plan.distinct_dimension(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag"])
    return pairs.orderBy("l_suppkey", "l_returnflag").limit(10)


@query("SELECT count(*) AS n_rows, count(*) AS n_ids FROM orders")
def row_id_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = with_row_id(table(spark, sf_dir, "orders"))
    return numbered.agg(F.count("*").alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))


_ONE_ARTIST = """
artists AS (
  SELECT artist_id, artist_name AS name, artist_location AS location FROM catalog
  QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY artist_name, artist_location) = 1
)"""


@query(f"{_BOTH},{_ONE_ARTIST} SELECT artist_id, name, location FROM artists")
def artist_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.artists(catalog(spark, sf_dir)).select("artist_id", "name", "location")


@query(f"{_BOTH} SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location FROM catalog")
def artist_dimension_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.artists(catalog(spark, sf_dir), "distinct").select("artist_id", "name", "location")


@query(f"{_BOTH} SELECT song_id, title, artist_id, year, duration FROM catalog")
def song_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.songs(catalog(spark, sf_dir))


@query(f"""{_BOTH},{_SINGLE}, heard AS (SELECT s.* FROM plays {_LOOKUP_JOIN})
SELECT c.song_id, c.title, count(*) AS num_listens FROM heard h JOIN catalog c ON h.song_id = c.song_id
GROUP BY ALL ORDER BY num_listens DESC, c.song_id, c.title LIMIT 10""")
def top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.top_songs(_thin_fact(spark, sf_dir), plan.songs(catalog(spark, sf_dir)))


_ARTIST_SQL = f"""{_BOTH},{_SINGLE},{_ONE_ARTIST}, heard AS (SELECT s.* FROM plays {_LOOKUP_JOIN})
SELECT a.artist_id, a.name, count(*) AS num_listens FROM heard h JOIN artists a ON h.artist_id = a.artist_id
GROUP BY ALL ORDER BY num_listens {{direction}}, a.artist_id, a.name LIMIT {{n}}"""


@query(_ARTIST_SQL.format(direction="DESC", n=10))
def top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.top_artists(_thin_fact(spark, sf_dir), plan.artists(catalog(spark, sf_dir)))


@query(_ARTIST_SQL.format(direction="ASC", n=100))
def bottom_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.top_artists(_thin_fact(spark, sf_dir), plan.artists(catalog(spark, sf_dir)), 100, ascending=True)


@query(f"""{_LOG}, users AS (SELECT {_USER} FROM plays
  QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts DESC, level DESC) = 1)
SELECT u.user_id, first_name, last_name, u.level, count(*) AS num_listens FROM plays p JOIN users u ON p.userId = u.user_id
GROUP BY ALL ORDER BY num_listens DESC, u.user_id, first_name, last_name, u.level LIMIT 100""")
def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = play_log(spark, sf_dir, with_user=True)
    return plan.top_users(plan.plays(log).withColumnRenamed("userId", "user_id"), plan.users(log))


@query(f"{_LOG} SELECT count(DISTINCT userId) AS n_users FROM plays")
def count_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.users(play_log(spark, sf_dir, with_user=True)).agg(F.count("*").alias("n_users"))


def _timed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # the time dimension depends on nothing but the seconds of the plays
    played = plan.plays(play_log(spark, sf_dir)).select("start_time")
    return played, plan.time_dimension(played, "start_time")


_PLAY_DAY = "make_timestamp(start_time * 1000000)"


@query(f"{_LOG} SELECT count(*) AS num_listens FROM plays WHERE {_PLAY_DAY}::DATE = DATE '1998-11-03'")
def plays_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.plays_on(*_timed(spark, sf_dir), 1998, 11, 3)


@query(f"{_LOG} SELECT dayofweek({_PLAY_DAY})::INTEGER AS weekday, count(*) AS num_listens FROM plays GROUP BY ALL")
def plays_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.plays_by_weekday(*_timed(spark, sf_dir))


@query(f"""{_LOG} SELECT year({_PLAY_DAY})::INTEGER AS year, month({_PLAY_DAY})::INTEGER AS month, count(*) AS num_listens
FROM plays WHERE year({_PLAY_DAY}) = 1998 GROUP BY ALL ORDER BY num_listens DESC, year, month LIMIT 10""")
def plays_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.plays_by_month(*_timed(spark, sf_dir), 1998)


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL")
def count_by_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(table(spark, sf_dir, "events"), ["event_type", "user_id"])


def _heard(spark: SparkSession, sf_dir: str, with_user: bool) -> DataFrame:
    log = play_log(spark, sf_dir, with_user)
    return log.where(F.col("artist").isNotNull())


@query(f"""{_LOG} SELECT sessionId, itemInSession, artist, song, length FROM play_log WHERE artist IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY sessionId, itemInSession ORDER BY ts DESC, artist DESC, song DESC, length DESC) = 1""")
def query_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.query_table(
        _heard(spark, sf_dir, False), ["sessionId"], ["itemInSession"], ["artist", "song", "length"],
        ["ts", "artist", "song", "length"],
    )


@query(f"""{_LOG} SELECT userId, sessionId, itemInSession, artist, song, firstName, lastName FROM play_log WHERE artist IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY userId, sessionId, itemInSession ORDER BY ts DESC, artist DESC, song DESC) = 1""")
def query_by_user_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.query_table(
        _heard(spark, sf_dir, True), ["userId", "sessionId"], ["itemInSession"], ["artist", "song", "firstName", "lastName"],
        ["ts", "artist", "song"],
    )


@query(f"""{_LOG} SELECT song, userId, any_value(firstName) AS firstName, any_value(lastName) AS lastName
FROM play_log WHERE artist IS NOT NULL GROUP BY song, userId""")
def query_by_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.query_table(_heard(spark, sf_dir, True), ["song"], ["userId"], ["firstName", "lastName"], ["ts"])


@query(f"""{_LOG} SELECT song, userId FROM play_log WHERE artist IS NOT NULL AND song = 'blue bolt' GROUP BY ALL""")
def query_table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The song table written clustered, read back through a key lookup."""
    path = scratch(spark, "by-song")
    rows = _heard(spark, sf_dir, True)
    plan.write_query_table(plan.query_table(rows, ["song"], ["userId"], [], ["ts"]), path, ["song"], ["userId"])
    return lookup(spark.read.parquet(path), song="blue bolt")


@query(f"{_BOTH},{_SINGLE} SELECT {_FACT} FROM plays {_LOOKUP_JOIN}")
def songplay_lookup_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``songplay_lookup``, by the shuffle join for catalogs beyond the broadcast bound, popular songs salted."""
    log, songs = play_log(spark, sf_dir, with_user=True), catalog(spark, sf_dir)
    return plan.build_fact(log, songs, "lookup", broadcast_rows=0, hot_rows=1, hot_share=0.001)


@query(f"""{_BOTH}, moments AS (SELECT DISTINCT start_time FROM plays)
SELECT 'songplays' AS "table", count(*) AS n, count(song_id) AS n_matched FROM (
  SELECT song_id FROM plays LEFT JOIN (SELECT DISTINCT title, artist_name, duration, 'x' AS song_id FROM catalog)
  ON song = title AND artist = artist_name AND length = duration)
UNION ALL SELECT 'songs', count(*), count(*) FROM catalog
UNION ALL SELECT 'artists', count(DISTINCT artist_id), count(DISTINCT artist_id) FROM catalog
UNION ALL SELECT 'users', count(DISTINCT userId), count(DISTINCT userId) FROM plays
UNION ALL SELECT 'time', count(*), count(*) FROM moments""")
def listening_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log and catalog as raw JSON, loaded to the five tables and counted from storage."""
    path = scratch(spark, "listening")
    # raw logs are kept compressed: as plain text they would outweigh all else that is written
    play_log(spark, sf_dir, with_user=True).write.option("compression", "gzip").json(f"{path}/log")
    catalog(spark, sf_dir).write.option("compression", "gzip").json(f"{path}/songs")
    plan.load(spark, f"{path}/log", f"{path}/songs", f"{path}/out")
    keys = {"songplays": "song_id", "songs": "song_id", "artists": "artist_id", "users": "user_id", "time": "start_time"}
    counts = [
        spark.read.parquet(f"{path}/out/{name}").agg(F.count("*").alias("n"), F.count(key).alias("n_matched"))
        .select(F.lit(name).alias("table"), "n", "n_matched")
        for name, key in keys.items()
    ]
    return union_frames(counts, ["table", "n", "n_matched"])


@query(f"""{_BOTH},{_SINGLE}, steps AS (SELECT DISTINCT ts // 1000 AS start_time, userId, sessionId, itemInSession FROM plays),
  months AS (SELECT year(make_timestamp(start_time * 1000000))::INTEGER AS year,
    month(make_timestamp(start_time * 1000000))::INTEGER AS month, * FROM steps),
  states AS (SELECT userId, level FROM plays
    QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts DESC, level DESC, firstName DESC, lastName DESC, gender DESC) = 1)
SELECT 'songplays' AS "table", year, month, count(*) AS n, count(DISTINCT userId) AS n_keys, sum(start_time)::BIGINT AS total FROM months GROUP BY ALL
UNION ALL SELECT 'time', year, month, count(DISTINCT start_time), count(DISTINCT start_time), sum(DISTINCT start_time)::BIGINT FROM months GROUP BY ALL
UNION ALL SELECT 'users', NULL, NULL, count(*), count(*) FILTER (WHERE level = 'paid'), sum(userId::BIGINT)::BIGINT FROM states
UNION ALL SELECT 'songs', NULL, NULL, count(*), count(DISTINCT song_id), sum(year)::BIGINT FROM catalog
UNION ALL SELECT 'artists', NULL, NULL, count(DISTINCT artist_id), count(DISTINCT artist_id), NULL FROM catalog""")
def listening_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files arrive in three steps, each loaded by its own run; the last run again, and once more from a lost checkpoint."""
    path = scratch(spark, "hourly")
    with freed_shuffles(spark):
        log = play_log(spark, sf_dir, with_user=True).withColumn("step", F.pmod(F.xxhash64("sessionId"), F.lit(3)))
        log.write.partitionBy("step").parquet(f"{path}/steps")
    # raw logs are kept compressed, as for listening_load
    catalog(spark, sf_dir).write.option("compression", "gzip").json(f"{path}/songs")
    for step in range(3):
        arrived = spark.read.schema(log.schema).parquet(f"{path}/steps").where(F.col("step") == step).drop("step")
        arrived.write.option("compression", "gzip").json(f"{path}/log/hour={step}")
        discard(spark, f"{path}/steps/step={step}")
        hourly.run(spark, f"{path}/log", f"{path}/songs", f"{path}/out", f"{path}/progress")
    hourly.run(spark, f"{path}/log", f"{path}/songs", f"{path}/out", f"{path}/progress")
    hourly.run(spark, f"{path}/log", f"{path}/songs", f"{path}/out", f"{path}/lost")
    store = Store(spark, f"{path}/out")
    plays, time, users, songs, artists = (hourly.table(store, n) for n in ("songplays", "time", "users", "songs", "artists"))

    def counted(name, df, keys, total, by=()):
        out = df.groupBy(*by).agg(F.count("*").alias("n"), keys.alias("n_keys"), total.cast("long").alias("total"))
        return out.withColumns({"table": F.lit(name), **{c: F.lit(None).cast("int") for c in ("year", "month") if c not in by}})

    months = ["year", "month"]
    frames = [
        counted("songplays", plays, F.count_distinct("user_id"), F.sum("start_time"), months),
        counted("time", time, F.count_distinct("start_time"), F.sum("start_time"), months),
        counted("users", users, F.count_if(F.col("level") == "paid"), F.sum(F.col("user_id").cast("long"))),
        counted("songs", songs, F.count_distinct("song_id"), F.sum("year")),
        counted("artists", artists, F.count_distinct("artist_id"), F.lit(None)),
    ]
    return union_frames(frames, ["table", "year", "month", "n", "n_keys", "total"])


@query("""WITH c AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey % 500 + 1 END AS k, c_custkey FROM customer),
  s AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey % 500 + 1 END AS sk, s_suppkey FROM supplier)
SELECT kind, k, count(*) AS n, sum(c_custkey)::BIGINT AS customers, sum(s_suppkey)::BIGINT AS suppliers FROM (
  SELECT 'inner' AS kind, k, c_custkey, s_suppkey FROM c JOIN s ON k = sk
  UNION ALL SELECT 'left', k, c_custkey, s_suppkey FROM c LEFT JOIN s ON k = sk) GROUP BY ALL""")
def attribute_join_hot_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key holds a third of both sides; its pairs are counted and summed from a row per key of either side."""
    key = lambda c: F.when(F.col(c) % 3 == 0, F.lit(0)).otherwise(F.col(c) % 500 + 1)
    left = table(spark, sf_dir, "customer").select(key("c_custkey").alias("k"), "c_custkey")
    right = table(spark, sf_dir, "supplier").select(key("s_suppkey").alias("sk"), "s_suppkey")
    frames = []
    for how in ("inner", "left"):
        sums = attribute_join_sums(left, right, {"k": "sk"}, how, {"customers": "c_custkey"}, {"suppliers": "s_suppkey"}, broadcast_rows=0)
        frames.append(sums.withColumn("kind", F.lit(how)))
    return union_frames(frames, ["kind", "k", "n", "customers", "suppliers"])
