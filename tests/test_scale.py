import pathlib
import pytest
import random
import time

from pyspark.sql import functions as F

from starloom import scale


def test_is_small_checks_rows_and_bytes(spark):
    df = spark.range(1000)
    assert scale.is_small(df, 1000)
    assert not scale.is_small(df, 999)
    assert not scale.is_small(df, 0)
    assert not scale.is_small(df.withColumn("text", F.repeat(F.lit("x"), 1000)), 1000, max_bytes=100_000)


def test_hot_keys_finds_the_heavy_ones(spark):
    data = [("hot",)] * 4000 + [("warm",)] * 1500 + [(f"k{i}",) for i in range(4500)]
    random.Random(3).shuffle(data)
    df = spark.createDataFrame(data, "k string").repartition(6)
    hot = scale.hot_keys(df, ["k"], min_rows=1, share=0.1)
    names = {r["h"]: r["k"] for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert {names[h]: parts for h, parts in hot.items()} == {"hot": 8, "warm": 2}
    assert scale.hot_keys(df, ["k"]) == {}
    assert scale.hot_keys(df.limit(0), ["k"], min_rows=1) == {}


def test_salt_spreads_hot_and_null_keys(spark):
    left = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 4 == 1, 2).alias("k"))
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    hot = {left.where("k = 1").select(F.xxhash64("k")).first()[0]: 16}
    salted, copies = scale.salt_sides(left, right, ["k"], ["k"], hot)
    spread = {r["k"]: r["n"] for r in salted.groupBy("k").agg(F.countDistinct("_salt").alias("n")).collect()}
    assert spread[1] == 16 and spread[2] == 1 and spread[None] > 500
    assert {r["k"]: r["n"] for r in copies.groupBy("k").agg(F.count("*").alias("n")).collect()} == {1: 16, 2: 1}


def test_folders_follow_the_session(spark):
    assert scale.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scale.scratch(spark, "x") != scale.scratch(spark, "x")


def test_measuring_a_large_table_stops_early(spark):
    """Partitions behind the bound are not computed: they would fail."""
    late = F.when(F.col("id") >= 5000, F.raise_error(F.lit("read too far")).cast("string")).otherwise(F.lit("x"))
    df = spark.range(0, 10_000, 1, 100).select(late.alias("text"))
    assert not scale.is_small(df, max_rows=50)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scale.shared_folder(Session())
    Session.conf["spark.checkpoint.dir"] = "s3a://shared/tmp"
    assert scale.shared_folder(Session()) == "s3a://shared/tmp"
    Session.conf.clear()
    Context.master = "local[4]"
    assert scale.shared_folder(Session()) == scale.shared_folder(Session())


def test_shuffle_files_go_with_their_query(spark):
    """Inside, a query leaves no shuffle behind; the setting is as before afterwards, and a frame may still run twice."""
    spark.sparkContext._jvm.System.gc()
    names = "/".join(["**", "shuffle_*.data"])
    folder = pathlib.Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    before = spark.conf.get(scale._FREED, None)
    with scale.freed_shuffles(spark):
        known = set(folder.glob(names))
        counts = spark.range(100_000).groupBy(F.xxhash64("id").alias("h")).count()
        assert len(counts.collect()) == 100_000 and counts.where("h is null").count() == 0
        time.sleep(1)
        assert not set(folder.glob(names)) - known
        assert len(counts.collect()) == 100_000
    assert spark.conf.get(scale._FREED, None) == before
