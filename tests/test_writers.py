import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from starloom.sources import snapshots, writers
from tests.conftest import rows


def files(path):
    return [f for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.basename(f).startswith("part-")]


def test_compression_and_single_file(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(spark.range(100).repartition(8), path, codec="gzip", compact=True)
    assert len(files(path)) == 1 and files(path)[0].endswith(".gz.parquet")
    writers.write_parquet(spark.range(100), path, files=3)
    assert len(files(path)) == 3


def test_partition_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(spark.range(100).selectExpr("id", "id % 2 AS y", "id % 3 AS m").repartition(8), path, ["y", "m"])
    assert len(files(path)) == 6 and os.path.isdir(f"{path}/y=1/m=2")


def test_only_partitions_in_the_batch_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    day = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "d int, v string")
    writers.write_partitions(day, path, ["d"])
    writers.write_partitions(spark.createDataFrame([(1, "z")], "d int, v string"), path, ["d"])
    assert rows(spark.read.parquet(path).select("d", "v")) == [(1, "z"), (2, "c")]


def test_blank_text_becomes_null(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("", 1), ("a", 2), (None, 3)], "s string, n int")
    writers.append(df, path, blank_to_null=True)
    writers.append(df, path)
    assert rows(spark.read.parquet(path)) == [("", 1), ("a", 2), ("a", 2), (None, 1), (None, 3), (None, 3)]


def test_dimension_reload(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "k int")
    for truncate, count in ((True, 1), (True, 1), (False, 2)):
        writers.load_dimension(df, path, truncate)
        assert spark.read.parquet(path).count() == count


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_append_new_twice_equals_once(spark, tmp_path, parts):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", "1", 1), ("a", "1", 1), ("b", "2", 2)], "k string, p string, v int")
    writers.append_new(batch, path, ["k"], parts)
    writers.append_new(batch, path, ["k"], parts)
    writers.append_new(spark.createDataFrame([("c", "1", 3), ("a", "1", 9)], "k string, p string, v int"), path, ["k"], parts)
    assert rows(spark.read.parquet(path).select("k", "v")) == [("a", 1), ("b", 2), ("c", 3)]


def test_append_new_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "k string, p int")
    writers.append_new(batch, path, ["k", "p"], ["p"])
    target = writers.read_target(spark, path, batch.schema)
    known = writers._existing_keys(batch.where("p = 1"), target, ["k", "p"], ["p"])
    assert rows(known) == [("a", 1)]
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(p#" in scan and "<=> 1)" in scan


NULL_KEYS = "k int, j string, v int"


def test_null_keys_equal_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(None, "a", 1), (None, None, 2), (1, None, 3), (1, "a", 4), (None, None, 1)], NULL_KEYS)
    for _ in range(3):
        writers.append_new(batch, path, ["k", "j"])
    assert rows(spark.read.parquet(path)) == rows(spark.createDataFrame([(None, "a", 1), (None, None, 1), (1, None, 3), (1, "a", 4)], NULL_KEYS))
    for row in ((None, None, 9), (1, None, 9)):
        with pytest.raises(writers.DuplicateKeyError):
            writers.append_unique(spark.createDataFrame([row], NULL_KEYS), path, ["k", "j"])
    writers.append_unique(spark.createDataFrame([(2, None, 9)], NULL_KEYS), path, ["k", "j"])


@pytest.mark.parametrize("most", [500, 0])
def test_a_key_that_moved_is_known_in_any_partition(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(writers, "PRUNED_PARTITIONS", most)
    path = str(tmp_path / "t")
    writers.append_new(spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string"), path, ["k"], ["p"])
    moved = spark.createDataFrame([(1, "b"), (3, "a")], "k int, p string")
    with pytest.raises(writers.DuplicateKeyError):
        writers.append_unique(moved, path, ["k"], ["p"])
    writers.append_new(moved, path, ["k"], ["p"])
    assert rows(spark.read.parquet(path).select("k", "p")) == [(1, "a"), (2, "b"), (3, "a")]


@pytest.mark.parametrize("buckets", [1, 64])
def test_upsert_null_keys(spark, tmp_path, buckets):
    path = str(tmp_path / "t")
    snapshots.upsert(spark.createDataFrame([(None, 1), (7, 1)], "k int, t int"), path, ["k"], ["t"], buckets=buckets)
    snapshots.upsert(spark.createDataFrame([(None, 2)], "k int, t int"), path, ["k"], ["t"])
    assert rows(snapshots.read_snapshot(spark, path)) == rows(spark.createDataFrame([(None, 2), (7, 1)], "k int, t int"))


def test_append_unique_refuses(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(writers.DuplicateKeyError):
        writers.append_unique(df.union(df), path, ["k"])
    writers.append_unique(df, path, ["k"])
    with pytest.raises(writers.DuplicateKeyError):
        writers.append_unique(spark.createDataFrame([(2,), (3,)], "k int"), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_tables(spark, tmp_path):
    writers.drop_tables(spark, ["starloom_t"])
    writers.create_tables(spark, {"starloom_t": "k int, v string"}, str(tmp_path))
    writers.create_tables(spark, {"starloom_t": "k int, v string"}, str(tmp_path))
    spark.createDataFrame([(1, "a")], "k int, v string").write.insertInto("starloom_t")
    assert rows(spark.table("starloom_t")) == [(1, "a")]
    writers.drop_tables(spark, ["starloom_t"])
    assert not spark.catalog.tableExists("starloom_t")


def test_csv_and_json_exports(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1)], "s string, n int")
    writers.write_csv(df, str(tmp_path / "csv"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "csv"))) == [("a,b", "1")]
    writers.export_json({"x": df, "y": df}, str(tmp_path / "json"))
    assert rows(spark.read.schema("s string, n int").json(str(tmp_path / "json" / "y"))) == [("a,b", 1)]


def test_keep_and_balance(spark):
    df = writers.keep(writers.balance(spark.range(10), 4))
    assert df.rdd.getNumPartitions() == 4 and df.storageLevel.useDisk
    df.unpersist()


def test_upsert_by_order_and_by_arrival(spark, tmp_path):
    first = spark.createDataFrame([(1, 5, "old"), (2, 5, "keep"), (1, 4, "older")], "k int, t int, v string")
    late = spark.createDataFrame([(1, 3, "late"), (3, 1, "new")], "k int, t int, v string")
    by_order, by_arrival = str(tmp_path / "o"), str(tmp_path / "a")
    for path, wins in ((by_order, False), (by_arrival, True)):
        assert snapshots.upsert(first, path, ["k"], ["t"], arrival_wins=wins) == 1
        assert snapshots.upsert(late, path, ["k"], ["t"], arrival_wins=wins) == 2
    assert rows(snapshots.read_snapshot(spark, by_order)) == [(1, 5, "old"), (2, 5, "keep"), (3, 1, "new")]
    assert rows(snapshots.read_snapshot(spark, by_arrival)) == [(1, 3, "late"), (2, 5, "keep"), (3, 1, "new")]
    assert rows(snapshots.read_snapshot(spark, by_order, 1)) == [(1, 5, "old"), (2, 5, "keep")]


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.upsert(spark.createDataFrame([(k, 1) for k in range(40)], "k int, t int"), path, ["k"], ["t"], buckets=8, spread="k")
    before = set(files(path + "/data"))
    snapshots.upsert(spark.createDataFrame([(3, 2), (11, 2), (100, 2), (6, 0)], "k long, t int"), path, ["k"], ["t"])
    assert snapshots.bucket_versions(spark, path) == {b: 2 if b in (3, 4, 6) else 1 for b in range(8)}
    assert before <= set(files(path + "/data"))
    scanned = {f.rsplit("/", 2)[1] for f in set(files(path + "/data")) - before}
    assert scanned == {"starloom_bucket=3", "starloom_bucket=4", "starloom_bucket=6"}
    want = {**dict.fromkeys(range(40), 1), 3: 2, 11: 2, 100: 2}
    assert dict(rows(snapshots.read_snapshot(spark, path))) == want
    assert dict(rows(snapshots.read_snapshot(spark, path, 1))) == dict.fromkeys(range(40), 1)
    assert snapshots.rebucket(spark, path, 3) == 3
    assert dict(rows(snapshots.read_snapshot(spark, path))) == want and set(snapshots.bucket_versions(spark, path)) == {0, 1, 2}
    with pytest.raises(ValueError):
        snapshots.upsert(spark.createDataFrame([(1, 1)], "k int, t int"), path, ["t"], ["k"])


def test_uncommitted_snapshot_is_invisible_and_redone(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, path)
    base = spark.createDataFrame([(1, 1)], "k int, t int")
    snapshots.upsert(base, path, ["k"], ["t"], writer="w", batch_id=0)
    spark.createDataFrame([(9, 9)], "k int, t int").write.parquet(f"{path}/data/snapshot=2")
    assert rows(snapshots.read_snapshot(spark, path)) == [(1, 1)]
    batch = spark.createDataFrame([(2, 1)], "k int, t int")
    for _ in range(2):
        assert snapshots.upsert(batch, path, ["k"], ["t"], writer="w", batch_id=1) == 2
        assert rows(snapshots.read_snapshot(spark, path)) == [(1, 1), (2, 1)]
    # another writer starts its count anew: its batch 0 is no replay
    assert snapshots.upsert(spark.createDataFrame([(3, 1)], "k int, t int"), path, ["k"], ["t"], writer="x", batch_id=0) == 3
    assert rows(snapshots.read_snapshot(spark, path)) == [(1, 1), (2, 1), (3, 1)]


def test_old_snapshots_expire(spark, tmp_path):
    """Buckets that a kept snapshot names stay, whoever wrote them; those that only older ones named go."""
    path = str(tmp_path / "t")
    for i in range(4):
        snapshots.upsert(spark.createDataFrame([(i, 1), (8, i)], "k int, t int"), path, ["k"], ["t"], keep=2, buckets=16, spread="k")
    left = sorted(re.search(r"version=(\d+)-\w+/starloom_bucket=(\d+)/", f).groups() for f in files(path + "/data"))
    assert left == [("1", "0"), ("2", "1"), ("3", "2"), ("3", "8"), ("4", "3"), ("4", "8")]
    assert rows(snapshots.read_snapshot(spark, path)) == [(0, 1), (1, 1), (2, 1), (3, 1), (8, 3)]
    assert rows(snapshots.read_snapshot(spark, path, 3)) == [(0, 1), (1, 1), (2, 1), (8, 2)]
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, path, 2)


def test_partitioned_write_splits_a_hot_value(spark):
    plan = writers.balance(spark.range(10).withColumn("d", F.lit(1)), None, "d")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
