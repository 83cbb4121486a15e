import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.sources import manifest
from starloom.sources.manifest import ConflictError, Store, open_table, partition_values, table_folder, unit_values
from tests.conftest import rows


def test_tables_change_together(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.commit() is None and store.versions() == []
    change = store.begin()
    change.replace("a", spark.createDataFrame([(1, "x"), (2, "y")], "d int, v string"), ["d"])
    change.replace("b", spark.createDataFrame([(7,)], "k long"))
    assert store.commit() is None
    assert rows(change.read("a")) == [(1, "x"), (2, "y")]
    assert change.commit() == 1
    change = store.begin()
    assert change.replace("a", spark.createDataFrame([(2, "z"), (3, "w")], "d int, v string"), ["d"]) == ["d=2", "d=3"]
    change.replace("b", spark.createDataFrame([(8,), (9,)], "k long"))
    assert rows(store.read("a")) == [(1, "x"), (2, "y")] and rows(store.read("b")) == [(7,)]
    change.commit()
    assert rows(store.read("a")) == [(1, "x"), (2, "z"), (3, "w")] and rows(store.read("b")) == [(8,), (9,)]
    assert rows(store.read("a", 1)) == [(1, "x"), (2, "y")]
    assert rows(store.read("a", units=["d=3", "d=9"])) == [(3, "w")]


def test_units_can_go(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    change = store.begin()
    change.replace("a", spark.createDataFrame([(1, "x"), (2, "y")], "d int, v string"), ["d"])
    change.commit()
    change = store.begin()
    none = spark.createDataFrame([], "d int, v string")
    assert change.replace("a", none, ["d"], drop=change.units_of("a", ["d"], {("2",)})) == []
    change.commit()
    assert rows(store.read("a")) == [(1, "x")]
    change = store.begin()
    change.replace("a", none, ["d"], drop=["d=1"])
    change.commit()
    assert rows(store.read("a")) == [] and store.read("a").dtypes == [("d", "int"), ("v", "string")]


def test_odd_partition_values(spark, tmp_path):
    """Values that folders must escape, nulls, dates and empty text come back as they were."""
    data = [("a/b c:%=?*[{", dt.date(2020, 1, 2), 1), (None, None, 2), ("ü 100%25", dt.date(1999, 12, 31), 3)]
    df = spark.createDataFrame(data, "p string, d date, v int")
    store = Store(spark, str(tmp_path / "a b"))
    change = store.begin()
    units = change.replace("t", df, ["p", "d"])
    change.commit()
    assert rows(store.read("t")) == rows(df)
    values = partition_values(df, ["p", "d"])
    assert {tuple(unit_values(u)[c] for c in ("p", "d")) for u in units} == values
    change = store.begin()
    assert len(change.units_of("t", ["p", "d"], {(None, None)})) == 1
    change.replace("t", df.where("v = 3").withColumn("v", F.lit(4)), ["p", "d"], change.units_of("t", ["p", "d"], values))
    change.commit()
    assert [r.v for r in store.read("t").collect()] == [4]


def test_batches_are_taken_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for batch in (0, 1):
        change = store.begin("w", batch)
        change.replace("t", spark.range(batch + 1))
        change.commit()
    assert store.begin("w", 0) is None and store.begin("w", 1) is None
    assert store.begin("w", 2) is not None and store.begin("v", 0) is not None


def test_of_two_changes_the_later_commit_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    one, two = store.begin(), store.begin()
    for n, change in enumerate((one, two), 1):
        change.replace("t", spark.range(n))
    one.commit()
    with pytest.raises(ConflictError):
        two.commit()
    assert store.read("t").count() == 1 and store.versions() == [1]


def test_what_a_crashed_commit_leaves_does_not_count(spark, tmp_path):
    (tmp_path / "commits" / "version=1" / "_temporary").mkdir(parents=True)
    store = Store(spark, str(tmp_path))
    assert store.commit() is None
    change = store.begin()
    change.replace("t", spark.range(3))
    assert change.commit() == 1 and store.read("t").count() == 3


def test_expired_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for n in range(4):
        change = store.begin()
        change.replace("t", spark.createDataFrame([(n, n), (9, n)], "d int, v int"), ["d"])
        change.commit(keep=2)
    assert store.versions() == [3, 4]
    folders = sorted(p.parent.name.split("-")[0] + "/" + p.name for p in tmp_path.glob("data/t/*/d=*"))
    assert folders == [f"starloom_version={v}/d={d}" for v, d in ((1, 0), (2, 1), (3, 2), (3, 9), (4, 3), (4, 9))]
    assert rows(store.read("t")) == [(0, 0), (1, 1), (2, 2), (3, 3), (9, 3)] and rows(store.read("t", 3))[-1] == (9, 2)
    with pytest.raises(FileNotFoundError):
        store.read("t", 2)


def test_untouched_units_keep_their_files(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    change = store.begin()
    change.replace("t", spark.createDataFrame([(d, 0) for d in range(5)], "d int, v int"), ["d"])
    change.commit()
    first = set(store.read("t").inputFiles())
    change = store.begin()
    change.replace("t", spark.createDataFrame([(2, 1)], "d int, v int"), ["d"])
    change.commit()
    assert len(first & set(store.read("t").inputFiles())) == 4


def test_open_table(spark, tmp_path):
    change = Store(spark, str(tmp_path / "s")).begin()
    change.replace("t", spark.range(3))
    change.commit()
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert open_table(spark, str(tmp_path / "s" / "t")).count() == 3
    assert open_table(spark, str(tmp_path / "plain")).count() == 4
    assert table_folder(spark, str(tmp_path / "s" / "t")).endswith("s/data/t")
    assert table_folder(spark, str(tmp_path / "plain")) == str(tmp_path / "plain")
    assert manifest.KEEP_VERSIONS >= 1
