import json

import pytest
from pyspark.errors import AnalysisException

from starloom.sources import readers
from tests.conftest import rows


@pytest.fixture
def tree(tmp_path):
    for folder, records in {"2018/11": [{"a": 1, "b": "x"}, {"a": 2}], "2018/12/deep": [{"a": 3, "c": 4}]}.items():
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "events.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    (tmp_path / "2018" / "notes.txt").write_text("not json\n")
    return str(tmp_path)


def test_json_tree_with_schema(spark, tree):
    df = readers.read_json(spark, tree, "a int, b string", glob="*.json")
    assert rows(df) == [(1, "x"), (2, None), (3, None)]


def test_json_wildcard_and_inference(spark, tree):
    df = readers.read_json(spark, f"{tree}/2018/*/*.json")
    assert rows(df.select("a")) == [(1,), (2,)]
    assert dict(readers.read_json(spark, tree, glob="*.json").dtypes) == {"a": "bigint", "b": "string", "c": "bigint"}


def test_stage_json_by_paths(spark, tmp_path):
    records = [
        {"userId": 8, "user": {"name": {"first": "Ann"}}, "song": "s"},
        {"userId": "x", "user": None},
    ]
    (tmp_path / "r.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    paths = {"first": "$['user']['name']['first']", "song_title": "$.song"}
    df = readers.stage_json(spark, str(tmp_path), "first string, song_title string", paths)
    assert rows(df, "as is") == [("Ann", "s"), (None, None)]
    with pytest.raises(ValueError):
        readers.stage_json(spark, str(tmp_path), "a string", {"a": "a"})


def test_stage_json_auto_ignores_case(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"UserId": 8, "LEVEL": "paid", "extra": 1}\n{"userid": "bad", "level": null}\n')
    df = readers.stage_json(spark, str(tmp_path), "userid int, level string, absent double")
    assert rows(df, "as is") == [(8, "paid", None), (None, None, None)]


def test_consolidate_csv_by_position(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "one.csv").write_text('artist,auth,first,extra\n"Band, The",in,Ann,1\n,out,Bob,2\n')
    (tmp_path / "sub" / "two.csv").write_text("ARTIST,AUTH,FIRST\nSolo,in,Cid\n")
    df = readers.consolidate_csv(spark, str(tmp_path), {0: "artist", 2: "first_name"}, require=0)
    assert rows(df) == [("Band, The", "Ann"), ("Solo", "Cid")]


def test_read_union_projects_drifted_files(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "k int, v string").write.parquet(a)
    spark.createDataFrame([(True, 2, "y")], "extra boolean, k int, v string").write.parquet(b)
    assert rows(readers.read_union(spark, [a, b], "k int, v string")) == [(1, "x"), (2, "y")]
    for name, df in {"c": spark.read.parquet(a), "d": spark.read.parquet(b)}.items():
        df.write.option("header", True).csv(str(tmp_path / name))
    both = [str(tmp_path / "c"), str(tmp_path / "d")]
    assert rows(readers.read_union(spark, both, "k int, v string", fmt="csv")) == [(1, "x"), (2, "y")]


def test_read_union_groups_drifted_csv_of_one_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("x,extra,y\n3,e,4\n")
    (tmp_path / "c.csv").write_text("x,y\n5,6\n")
    assert rows(readers.read_union(spark, [str(tmp_path)], "x int, y int", fmt="csv")) == [(1, 2), (3, 4), (5, 6)]
    with pytest.raises(ValueError, match="absent"):
        readers.read_union(spark, [str(tmp_path)], "x int, absent int", fmt="csv")
    spark.range(2).write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError, match="absent"):
        readers.read_union(spark, [str(tmp_path / "p")], "id long, absent int")


def test_union_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(readers.union_frames([df, df.select("b", "a")], ["a", "b"])) == [(1, 2), (1, 2)]


def test_register_and_parquet_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id * 2 AS twice", "id % 3 AS part").write.parquet(path)
    readers.register(spark, {"t": readers.read_parquet(spark, path)})
    df = spark.sql("SELECT twice FROM t WHERE part = 1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:bigint,part:bigint>" in plan
    assert "EqualTo(part,1)" in plan
    assert rows(df) == [(14,), (2,), (8,)]


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_parquet(spark, str(tmp_path / "nothing"))


def test_json_text_is_parsed_once(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 2}, "c": "x", "d": 1.5}'), (2, None), (3, "no json")], "k int, t string")
    got = readers.json_fields(df, "t", {"b": "$.a.b", "c": "$['c']", "d": "$.d"}, "b int, c string, d double").drop("t")
    assert rows(got) == [(1, 2, "x", 1.5), (2, None, None, None), (3, None, None, None)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
