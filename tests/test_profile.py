import pytest
from pyspark.sql import functions as F

from starloom.operators import profile, projection
from tests.conftest import rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 5.0), (None, None)], "s string, x double")


def test_value_counts(df):
    assert rows(profile.value_counts(df, "s"), "as is") == [(None, 2), ("a", 2), ("b", 1)]
    assert rows(profile.value_counts(df, "s", count_nulls=False), "as is") == [("a", 2), ("b", 1), (None, 0)]
    assert rows(profile.value_counts(df, "x", by_value=True), "as is") == [(None, 2), (1.0, 1), (3.0, 1), (5.0, 1)]


def test_null_profile_and_describe(df):
    assert rows(profile.null_profile(df, ["s", "x"]), "as is") == [("s", 2, 3), ("x", 2, 3)]
    assert rows(profile.describe(df, ["x"]), "as is") == [("x", 3, 3.0, 2.0, 1.0, 5.0)]


def test_funnel_counts_null_predicates_as_no(df):
    got = profile.funnel(df, {"big": F.col("x") > 2, "named": F.col("s").isNotNull()})
    assert rows(got, "as is") == [("big", 2), ("named", 3)]


def test_sets_and_extremes(df):
    assert rows(profile.invalid_values(df, "s", ["a"])) == [("b", 1), (None, 2)]
    assert rows(profile.invalid_values(df, "s", ["a"], allow_null=True)) == [("b", 1)]
    assert rows(profile.min_max(df, "x")) == [(1.0, 5.0)]
    assert rows(profile.distinct_values(df, "s")) == [("a",), ("b",), (None,)]
    assert rows(profile.total(df, "x")) == [(9.0,)]
    assert rows(profile.days_with_rows(df, "s")) == [("a", 2), ("b", 1)]


def test_schema_diff(spark, df):
    other = spark.createDataFrame([("a", 1, None)], "s string, x int, extra string")
    assert rows(profile.schema_diff(df, other)) == [("extra", None, "string"), ("x", "double", "int")]
    assert rows(profile.extra_column_profile(df, other)) == [("extra", 1, 0)]


def test_partition_sizes(spark):
    got = profile.partition_sizes(spark.range(0, 100, 1, 4))
    assert rows(got) == [(0, 25), (1, 25), (2, 25), (3, 25)]


def test_projection(spark, df):
    assert rows(projection.lookup(df, s="a", x=3.0)) == [("a", 3.0)]
    assert rows(projection.members(df, "s", ["b"])) == [("b", None)]
    two = spark.createDataFrame([(1, 1), (1, 2), (None, 2)], "a int, b int")
    assert rows(projection.differing(two, "a", "b")) == [(1, 2)]
    assert rows(projection.first_rows(two, 1, [F.desc("b"), "a"]), "as is") == [(None, 2)]
    assert projection.rename(df, {"s": "t", "nope": "y"}).columns == ["t", "x"]
    text = spark.createDataFrame([("7",), ("x",), (None,)], "n string")
    assert rows(projection.cast_columns(text, {"n": "int"}), "as is") == [(7,), (None,), (None,)]
    assert projection.sample_rows(spark.range(1000), 0.5, 20, 3).count() == 20
    assert list(projection.preview(two, 2).columns) == ["a", "b"]
