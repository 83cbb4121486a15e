import glob
import random
import shutil

import pytest

from starloom.sources import key_index, writers
from starloom.sources.key_index import candidates, refresh
from tests.conftest import rows


@pytest.fixture(autouse=True, params=[0])
def indexed(request, monkeypatch):
    monkeypatch.setattr(writers, "INDEXED_FILES", request.param)


def target(spark, path, schema):
    return writers.read_target(spark, path, schema)


def test_only_files_with_keys_of_the_batch_are_opened(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, v string"
    for load in range(5):
        writers.append_new(spark.createDataFrame([(load * 100 + i, "x") for i in range(50)], schema).coalesce(1), path, ["k"])
    batch = spark.createDataFrame([(203, "y"), (260, "y"), (460, "y")], schema)
    hit = candidates(batch, target(spark, path, schema), path, ["k"])
    assert len(hit) == 1 and rows(spark.read.parquet(hit[0]).selectExpr("min(k)", "max(k)")) == [(200, 249)]
    assert candidates(batch.where("k <> 203"), target(spark, path, schema), path, ["k"]) == []
    plan = key_index.colliding_keys(batch, target(spark, path, schema), path, ["k"])
    assert len(plan.inputFiles()) == 1 < len(target(spark, path, schema).inputFiles())
    writers.append_new(batch, path, ["k"])
    assert spark.read.parquet(path).count() == 252 and spark.read.parquet(path).where("v = 'y'").count() == 2


@pytest.mark.parametrize("indexed", [0, 7], indirect=True)
@pytest.mark.parametrize("named", [500, 0])
def test_random_loads_equal_a_set(spark, tmp_path, monkeypatch, named):
    """Random keys with nulls, some of them again, in partitions or not, by few named files or by a join."""
    monkeypatch.setattr(key_index, "NAMED_FILES", named)
    rng, path = random.Random(3), str(tmp_path / "t")
    schema, known = "k int, j string, p string", set()
    for _ in range(4):
        batch = [(rng.choice([None, *range(30)]), rng.choice([None, "", "a", "b"]), rng.choice("xy")) for _ in range(40)]
        writers.append_new(spark.createDataFrame(batch, schema), path, ["k", "j"], ["p"])
        known |= {(k, j) for k, j, _ in batch}
        assert rows(spark.read.parquet(path).select("k", "j")) == sorted(known, key=repr)
    with pytest.raises(writers.DuplicateKeyError):
        writers.append_unique(spark.createDataFrame([(*sorted(known, key=repr)[0], "z")], schema), path, ["k", "j"])
    writers.append_unique(spark.createDataFrame([(99, "new", "z")], schema), path, ["k", "j"], ["p"])


def test_types_may_differ_between_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_new(spark.createDataFrame([(1,), (2,)], "k int"), path, ["k"])
    assert refresh(target(spark, path, "k int"), path, ["k"])
    assert len(candidates(spark.createDataFrame([(2,)], "k long"), target(spark, path, "k int"), path, ["k"])) == 1


def test_files_without_index_and_files_that_are_gone(spark, tmp_path):
    """A table from before the index, files appended past it, a lost index and a replaced file: none of them loses a key."""
    path, schema = str(tmp_path / "t"), "k long"
    spark.range(10).selectExpr("id AS k").coalesce(1).write.parquet(path)
    writers.append_new(spark.createDataFrame([(5,), (50,)], schema), path, ["k"])
    spark.createDataFrame([(70,)], schema).write.mode("append").parquet(path)
    writers.append_new(spark.createDataFrame([(70,), (71,)], schema), path, ["k"])
    shutil.rmtree(f"{path}/_keys")
    writers.append_new(spark.createDataFrame([(71,), (72,)], schema), path, ["k"])
    assert rows(spark.read.parquet(path)) == sorted([(i,) for i in (*range(10), 50, 70, 71, 72)], key=repr)
    kept = spark.createDataFrame([(1,)], schema).collect()
    spark.createDataFrame(kept, schema).write.mode("overwrite").parquet(path)
    assert not glob.glob(f"{path}/_keys/*")
    writers.append_new(spark.createDataFrame([(1,), (9,)], schema), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1,), (9,)]


def test_a_file_that_is_gone_is_no_candidate(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, p int"
    writers.append_new(spark.createDataFrame([(1, 1), (2, 2)], schema), path, ["k"], ["p"])
    writers.append_new(spark.createDataFrame([(3, 3)], schema), path, ["k"], ["p"])
    shutil.rmtree(f"{path}/p=1")
    writers.append_new(spark.createDataFrame([(1, 4), (2, 4)], schema), path, ["k"], ["p"])
    assert rows(spark.read.parquet(path)) == [(1, 4), (2, 2), (3, 3)]


def test_an_empty_batch_and_an_empty_table(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long"
    for _ in range(3):
        writers.append_new(spark.createDataFrame([], schema), path, ["k"])
    writers.append_new(spark.createDataFrame([(1,)], schema), path, ["k"])
    writers.append_new(spark.createDataFrame([], schema), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1,)]
