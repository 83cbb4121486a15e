"""Queries that write tables and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.scale import scratch
from starloom.sources import readers, writers
from starloom.sources.key_index import candidates
from starloom.sources.snapshots import bucket_versions, read_snapshot, rebucket, upsert
from starloom.streaming.incremental import dimension_sink, fact_sink, load_stream
from starloom.suite.registry import query
from starloom.suite.views import PLAY_LOG_SQL, play_log, table

ORDER_FIELDS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
EVENT_FIELDS = "event_id bigint, ts bigint, user_id bigint, event_type string, value double"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").drop("o_orderdate")


def _cents(column: str) -> F.Column:
    return F.sum(F.round(F.col(column) * 100).cast("long"))


@query("""SELECT format, o_orderstatus, count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents
FROM orders, (VALUES ('csv'), ('json'), ('parquet')) f(format) GROUP BY ALL""")
def read_formats_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON and CSV folders and Parquet, read under one schema and queried as views."""
    orders, path = _orders(spark, sf_dir), scratch(spark, "formats")
    orders.write.partitionBy("o_orderstatus").json(f"{path}/json/nested")
    writers.write_csv(orders, f"{path}/csv")
    writers.write_parquet(orders, f"{path}/parquet")
    by_folder = spark.read.schema(ORDER_FIELDS).json(f"{path}/json/nested")
    readers.register(spark, {
        "orders_json": by_folder,
        "orders_csv": readers.read_csv(spark, f"{path}/csv", ORDER_FIELDS),
        "orders_parquet": readers.read_parquet(spark, f"{path}/parquet"),
    })
    return spark.sql(" UNION ALL ".join(
        f"""SELECT '{fmt}' AS format, o_orderstatus, count(*) AS n, sum(cast(round(o_totalprice * 100) AS bigint)) AS cents
        FROM orders_{fmt} GROUP BY o_orderstatus""" for fmt in ("csv", "json", "parquet")
    ))


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS n_ids, sum(user_id)::BIGINT AS users FROM events")
def read_json_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder tree of JSON lines, without a schema."""
    path = scratch(spark, "tree")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("kind"))
    events.write.partitionBy("kind").json(path)
    read = readers.read_json(spark, path, glob="*.json")
    return read.agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_ids"), F.sum("user_id").alias("users"))


@query("SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events")
def stage_json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.json_fields(table(spark, sf_dir, "events").select("event_id", "props"), "props", {"k": "$.k"}, "k int").drop("props")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("eventId"),
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("action")).alias("user"),
        F.col("value").alias("VALUE"),
    )


@query("SELECT event_id, user_id, event_type AS action FROM events")
def stage_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records staged twice by field paths; the second copy replaces the first."""
    path = scratch(spark, "staged")
    _records(spark, sf_dir).write.json(f"{path}/raw")
    paths = {"event_id": "$['eventId']", "user_id": "$.user.id", "action": "$['user']['action']"}
    staged = readers.stage_json(spark, f"{path}/raw", "event_id bigint, user_id bigint, action string", paths)
    writers.stage(staged, f"{path}/table")
    return writers.stage(staged, f"{path}/table")


@query("SELECT event_id AS eventid, value, try_cast(NULL AS BIGINT) AS absent FROM events")
def stage_json_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "staged")
    _records(spark, sf_dir).write.json(path)
    return readers.stage_json(spark, path, "eventid bigint, value double, absent bigint")


@query(f"""WITH {PLAY_LOG_SQL} SELECT artist, count(*) AS n, sum(sessionId)::BIGINT AS sessions
FROM play_log WHERE artist IS NOT NULL GROUP BY artist""")
def consolidate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files by position; rows without an artist fall out."""
    path = scratch(spark, "csv")
    log = play_log(spark, sf_dir).select("artist", "page", "song", "sessionId", "level")
    writers.write_csv(log, path)
    rows = readers.consolidate_csv(spark, path, {0: "artist", 2: "song", 3: "session_id"}, require=0)
    sessions = F.sum(F.col("session_id").cast("long")).alias("sessions")
    return rows.groupBy("artist").agg(F.count("*").alias("n"), sessions)


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders GROUP BY ALL")
def union_common_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two file sets, one with extra columns, read under the common ones."""
    path = scratch(spark, "drift")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")).drop("o_orderdate")
    early = F.col("year") < 1998
    writers.write_parquet(orders.where(early), f"{path}/early")
    writers.write_parquet(orders.where(~early).withColumn("note", F.lit("late")), f"{path}/late")
    read = readers.read_union(spark, [f"{path}/early", f"{path}/late"], "year int, o_custkey bigint")
    return read.groupBy("year").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


@query("SELECT event_id, user_id FROM events UNION ALL SELECT o_orderkey, o_custkey FROM orders")
def union_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    orders = table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "event_id", "o_custkey": "user_id"})
    return readers.union_frames([events, orders], ["event_id", "user_id"])


@query("""SELECT o_orderstatus, year(o_orderdate)::INTEGER AS year, count(*) AS n,
       sum(CASE WHEN year(o_orderdate) = 1998 THEN 1 ELSE 0 END)::BIGINT AS replaced FROM orders GROUP BY ALL""")
def partition_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year is loaded again; the other partitions stay."""
    path = scratch(spark, "refresh")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"), F.lit(0).cast("long").alias("version")
    )
    writers.write_partitions(orders, path, ["year"])
    writers.write_partitions(orders.where(F.col("year") == 1998).withColumn("version", F.lit(1).cast("long")), path, ["year"])
    stored = readers.read_parquet(spark, path)
    return stored.groupBy("o_orderstatus", F.col("year").cast("int").alias("year")).agg(
        F.count("*").alias("n"), F.sum("version").alias("replaced")
    )


@query("""SELECT 'customer' AS "table", count(*) AS n, sum(c_nationkey)::BIGINT AS total FROM customer
UNION ALL SELECT 'supplier', count(*), sum(s_nationkey)::BIGINT FROM supplier""")
def export_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "export")
    names = {"customer": "c_nationkey", "supplier": "s_nationkey"}
    writers.export_json({name: table(spark, sf_dir, name) for name in names}, path)
    counts = [
        readers.read_json(spark, f"{path}/{name}", f"{column} bigint").agg(
            F.count("*").alias("n"), F.sum(column).alias("total")
        ).select(F.lit(name).alias("table"), "n", "total")
        for name, column in names.items()
    ]
    return readers.union_frames(counts, ["table", "n", "total"])


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'O') DESC, o_orderkey DESC) = 1""")
def upsert_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends under one key: the later one replaces, whatever its order columns say."""
    path = scratch(spark, "upsert")
    orders = _orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_orderstatus")
    is_open = F.col("o_orderstatus") == "O"
    upsert(orders.where(~is_open), path, ["o_custkey"], ["o_orderkey"], arrival_wins=True)
    upsert(orders.where(is_open), path, ["o_custkey"], ["o_orderkey"], arrival_wins=True)
    return read_snapshot(spark, path)


@query("SELECT c_mktsegment, 2 * count(*) AS n FROM customer GROUP BY ALL")
def load_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reloads and one append leave every row twice."""
    path = scratch(spark, "dimension")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    writers.load_dimension(customer, path)
    writers.load_dimension(customer, path)
    writers.load_dimension(customer, path, truncate=False)
    return readers.read_parquet(spark, path).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(nullif(o_orderstatus, 'O')) AS n_present FROM orders")
def append_blank_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "append")
    orders = _orders(spark, sf_dir).select(F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")).alias("s"))
    writers.append(orders, path, blank_to_null=True)
    return readers.read_parquet(spark, path).agg(F.count("*").alias("n"), F.count("s").alias("n_present"))


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY ALL")
def created_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DDL, a load into the created table, and a query by name."""
    path = scratch(spark, "tables")
    writers.drop_tables(spark, ["starloom_customer"])
    writers.create_tables(spark, {"starloom_customer": "c_custkey bigint, c_nationkey int"}, path)
    table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").write.insertInto("starloom_customer")
    return spark.sql("SELECT c_nationkey, count(*) AS n FROM starloom_customer GROUP BY c_nationkey")


@query("SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users FROM events GROUP BY ALL")
def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, a repeat of it, and an overlapping one add every event once."""
    path = scratch(spark, "fact")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    some = events.where(F.col("event_type").isin("click", "view"))
    for batch in (some, some, events):
        writers.append_new(batch, path, ["event_id"], ["event_type"])
    return readers.read_parquet(spark, path).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


@query("SELECT p_type, count(*) AS n FROM part GROUP BY ALL")
def append_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load of the same keys is refused."""
    path = scratch(spark, "unique")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    writers.append_unique(part, path, ["p_partkey"])
    try:
        writers.append_unique(part, path, ["p_partkey"])
    except writers.DuplicateKeyError:
        pass
    return readers.read_parquet(spark, path).groupBy("p_type").agg(F.count("*").alias("n"))


def _event_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """All events as JSON in three folders."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"), "user_id", "event_type", "value",
        (F.dayofmonth("ts") / 11).cast("int").alias("batch"),
    )
    events.write.partitionBy("batch").json(path)


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM events GROUP BY ALL")
def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files streamed in micro-batches, then run again from scratch into the same table."""
    path = scratch(spark, "stream")
    _event_files(spark, sf_dir, f"{path}/in")
    sink = fact_sink(f"{path}/fact", ["event_id"])
    for run in ("first", "replay"):
        load_stream(spark, f"{path}/in", EVENT_FIELDS, sink, f"{path}/progress-{run}", max_files=8)
    facts = readers.read_parquet(spark, f"{path}/fact")
    return facts.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_ids"))


@query("""SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) = 1""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's newest event, kept current by micro-batches."""
    path = scratch(spark, "state")
    _event_files(spark, sf_dir, f"{path}/in")
    load_stream(spark, f"{path}/in", EVENT_FIELDS, dimension_sink(f"{path}/users", ["user_id"], ["ts", "event_id"]),
                f"{path}/progress", max_files=8)
    return read_snapshot(spark, f"{path}/users").select("user_id", "event_id", "event_type")


@query("SELECT CASE WHEN user_id % 7 > 0 THEN user_id END AS k, count(DISTINCT event_type) AS n FROM events GROUP BY 1")
def append_new_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key with nulls in it, loaded three times, is there once per event type."""
    path = scratch(spark, "null-keys")
    key = F.when(F.col("user_id") % 7 > 0, F.col("user_id"))
    batch = table(spark, sf_dir, "events").select(key.alias("k"), "event_type", "event_id")
    for _ in range(3):
        writers.append_new(batch, path, ["k", "event_type"])
    return readers.read_parquet(spark, path).groupBy("k").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN o_custkey % 5 > 0 THEN o_custkey END AS k, max(o_orderkey) AS o_orderkey, path
FROM orders, (VALUES ('small'), ('large')) p(path) GROUP BY ALL""")
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null key is one key, whether a batch is small or takes the shuffle path."""
    orders = table(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 5 > 0, F.col("o_custkey")).alias("k"), "o_orderkey")
    tail = F.col("o_orderkey") % 100 == 0
    results = []
    for name, batches in {"small": [orders.where(~tail), orders.where(tail)], "large": [orders.where(tail), orders]}.items():
        path = scratch(spark, f"upsert-{name}")
        for batch in batches:
            upsert(batch, path, ["k"], ["o_orderkey"])
        results.append(read_snapshot(spark, path).withColumn("path", F.lit(name)))
    return readers.union_frames(results, ["k", "o_orderkey", "path"])


@query("SELECT o_orderstatus, count(*) AS n, true AS refused FROM orders GROUP BY ALL")
def append_unique_moved_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that come again in another partition are refused, and nothing is written."""
    path, refused = scratch(spark, "moved"), False
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    writers.append_unique(orders, path, ["o_orderkey"], ["o_orderstatus"])
    try:
        writers.append_unique(orders.withColumn("o_orderstatus", F.lit("X")), path, ["o_orderkey"], ["o_orderstatus"])
    except writers.DuplicateKeyError:
        refused = True
    stored = readers.read_parquet(spark, path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return stored.withColumn("refused", F.lit(refused))


@query("SELECT o_orderkey, o_custkey FROM orders")
def union_drifted_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of one folder with different headers, one with an extra column in the middle."""
    path = scratch(spark, "drift")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    even = F.col("o_orderkey") % 2 == 0
    orders.where(even).write.option("header", True).csv(path)
    orders.where(~even).drop("o_orderstatus").write.option("header", True).mode("append").csv(path)
    return readers.read_union(spark, [path], "o_orderkey bigint, o_custkey bigint", fmt="csv")


@query("""SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) = 1""")
def stream_upsert_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders are streamed; then, with a fresh checkpoint, those again and the third."""
    path = scratch(spark, "restart")
    _event_files(spark, sf_dir, f"{path}/in")
    sink = dimension_sink(f"{path}/users", ["user_id"], ["ts", "event_id"])
    load_stream(spark, f"{path}/in/batch=[01]", EVENT_FIELDS, sink, f"{path}/progress-0", max_files=8)
    load_stream(spark, f"{path}/in", EVENT_FIELDS, sink, f"{path}/progress-1", max_files=8)
    return read_snapshot(spark, f"{path}/users").select("user_id", "event_id", "event_type")


@query("""WITH b AS (SELECT c_custkey, c_custkey % 16 AS bucket, c_nationkey = 3 AND c_custkey % 16 < 5 AS again FROM customer),
  t AS (SELECT bucket, bool_or(again) AS touched FROM b GROUP BY ALL)
SELECT b.bucket::INTEGER AS bucket, CASE WHEN touched THEN 2 ELSE 1 END AS written_by, count(*) AS n,
       count(*) FILTER (WHERE again) AS n_again, sum(CASE WHEN again THEN -1 ELSE c_custkey END)::BIGINT AS total
FROM b JOIN t ON b.bucket = t.bucket GROUP BY ALL""")
def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which snapshot wrote each bucket, after a second batch with keys of some buckets and a replay of it."""
    path = scratch(spark, "buckets")
    first = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("value"), F.lit(1).alias("t"))
    again = table(spark, sf_dir, "customer").where("c_nationkey = 3 AND c_custkey % 16 < 5")
    second = again.select("c_custkey", F.lit(-1).cast("long").alias("value"), F.lit(2).alias("t"))
    upsert(first, path, ["c_custkey"], ["t"], buckets=16, spread="c_custkey", writer="load", batch_id=0)
    for _ in range(2):
        upsert(second, path, ["c_custkey"], ["t"], writer="load", batch_id=1)
    held = spark.createDataFrame(list(bucket_versions(spark, path).items()), "bucket int, written_by int")
    rows = read_snapshot(spark, path).withColumn("bucket", F.pmod("c_custkey", F.lit(16)).cast("int"))
    counted = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if(F.col("t") == 2).alias("n_again"), F.sum("value").alias("total"))
    return counted.join(F.broadcast(held), "bucket").select("bucket", "written_by", "n", "n_again", "total")


@query("""SELECT user_id, max(event_id) AS event_id, buckets FROM events, (VALUES (64), (7)) b(buckets) GROUP BY ALL""")
def upsert_rebucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half upserted, the table dealt into another number of buckets, then the other half; both snapshots of the end agree."""
    path = scratch(spark, "rebucket")
    events = table(spark, sf_dir, "events").select("user_id", "event_id")
    odd = F.col("event_id") % 2 == 1
    upsert(events.where(odd), path, ["user_id"], ["event_id"])
    rebucket(spark, path, 7)
    seven = upsert(events.where(~odd), path, ["user_id"], ["event_id"])
    more = rebucket(spark, path, 64)
    frames = [read_snapshot(spark, path, v).withColumn("buckets", F.lit(n)) for v, n in ((seven, 7), (more, 64))]
    return readers.union_frames(frames, ["user_id", "event_id", "buckets"])


@query("""SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids, true AS new_opens_none, true AS old_opens_few
FROM events GROUP BY ALL""")
def append_new_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads by ten-day spans, each with the span before once more; new keys open no file, keys of one span not all of them."""
    path = scratch(spark, "indexed")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", F.floor(F.dayofmonth("ts") / 11).alias("span"))
    stored = events.drop("span", "ts")
    for span in range(3):  # many small files, as hourly loads leave them
        batch = events.where(F.col("span").between(span - 1, span)).drop("span", "ts")
        writers.append_new(batch.repartition(writers.INDEXED_FILES), path, ["event_id"])
    target = writers.read_target(spark, path, stored.schema)
    opened = {
        "new_opens_none": len(candidates(stored.withColumn("event_id", -F.col("event_id") - 1), target, path, ["event_id"])) == 0,
        "old_opens_few": 0 < len(candidates(events.where("span = 0").drop("span", "ts"), target, path, ["event_id"])) < len(target.inputFiles()),
    }
    counted = target.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_ids"))
    return counted.withColumns({name: F.lit(flag) for name, flag in opened.items()})
