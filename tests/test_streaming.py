import json

from pyspark.sql import functions as F

from starloom.sources.snapshots import read_snapshot
from starloom.streaming.incremental import dimension_sink, fact_sink, load_stream
from tests.conftest import rows

SCHEMA = "id int, user int, ts int, level string"


def drop_file(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(dict(zip(("id", "user", "ts", "level"), r))) + "\n" for r in records))


def test_each_run_loads_only_new_files(spark, tmp_path):
    source, fact, seen = tmp_path / "in", str(tmp_path / "fact"), []
    sink = fact_sink(fact, ["id"], lambda df: df.withColumn("paid", F.col("level") == "paid"))

    def watched(batch, number):
        seen.append(batch.count())
        sink(batch, number)

    def run(progress="progress"):
        load_stream(spark, str(source), SCHEMA, watched, str(tmp_path / progress))

    drop_file(source / "h1", "a.json", [(1, 1, 1, "free"), (2, 1, 2, "paid")])
    run()
    drop_file(source / "h2", "b.json", [(3, 2, 3, "free"), (2, 1, 2, "paid")])
    run()
    run()
    assert [n for n in seen if n] == [2, 2]
    stored = spark.read.parquet(fact).select("id", "paid")
    assert rows(stored) == [(1, False), (2, True), (3, False)]
    run("lost-progress")
    assert rows(spark.read.parquet(fact).select("id", "paid")) == [(1, False), (2, True), (3, False)]


def test_dimension_follows_the_latest_state(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "users")
    sink = dimension_sink(target, ["user"], ["ts"], lambda df: df.select("user", "ts", "level"))
    for name, records in (("a", [(1, 1, 5, "free"), (2, 2, 5, "free")]), ("b", [(3, 1, 9, "paid"), (4, 2, 1, "paid")])):
        drop_file(source, f"{name}.json", records)
        load_stream(spark, str(source), SCHEMA, sink, str(tmp_path / "progress"))
    assert rows(read_snapshot(spark, target)) == [(1, 9, "paid"), (2, 5, "free")]
    # a lost checkpoint replays all files into a stream of another id, and later files still count
    drop_file(source, "c.json", [(5, 3, 1, "free")])
    load_stream(spark, str(source), SCHEMA, sink, str(tmp_path / "lost"))
    drop_file(source, "d.json", [(6, 1, 10, "free")])
    load_stream(spark, str(source), SCHEMA, sink, str(tmp_path / "lost"))
    assert rows(read_snapshot(spark, target)) == [(1, 10, "free"), (2, 5, "free"), (3, 1, "free")]
