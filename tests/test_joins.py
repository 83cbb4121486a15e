import random

import pytest
from pyspark.sql import functions as F

from starloom import scale
from starloom.operators.joins import attribute_join, attribute_join_sums, enrich, keep_if_valid, lookup_join, unmatched, unmatched_counts
from tests.conftest import rows

ON = {"song": "title", "artist": "name"}


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(
        [(1, "a", "x", 1.0), (2, "a", "x", 2.0), (3, "b", "x", 1.0), (4, None, "x", 1.0), (5, "c", "z", None)],
        "id int, song string, artist string, length double",
    )


@pytest.fixture(scope="module")
def songs(spark):
    return spark.createDataFrame(
        [("s1", "a", "x", 1.0), ("s2", "a", "x", 2.0), ("s3", "a", "x", 1.0), ("s4", None, "x", 1.0), ("s5", "c", "z", 3.0)],
        "song_id string, title string, name string, duration double",
    )


# one strategy each: broadcast, plain shuffle, salted shuffle
STRATEGIES = [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "hot_rows": 1, "hot_share": 0.1}]


@pytest.mark.parametrize("options", STRATEGIES)
def test_inner_fans_out(log, songs, options):
    got = attribute_join(log, songs, ON, keep=["song_id"], **options).select("id", "song_id")
    assert rows(got) == [(1, "s1"), (1, "s2"), (1, "s3"), (2, "s1"), (2, "s2"), (2, "s3"), (5, "s5")]


@pytest.mark.parametrize("options", STRATEGIES)
def test_left_keeps_misses_and_nulls(log, songs, options):
    on = {**ON, "length": "duration"}
    got = attribute_join(log, songs, on, "left", {"length": "decimal(18,5)"}, ["song_id"], **options)
    assert rows(got.select("id", "song_id")) == [(1, "s1"), (1, "s3"), (2, "s2"), (3, None), (4, None), (5, None)]
    assert got.columns == ["id", "song", "artist", "length", "song_id"]


@pytest.mark.parametrize("options", STRATEGIES)
def test_lookup_returns_each_row_once(log, songs, options):
    on = {**ON, "length": "duration"}
    got = lookup_join(log, songs, on, ["song_id"], ["song_id"], {"length": "decimal(18,5)"}, **options)
    assert rows(got.select("id", "song_id")) == [(1, "s1"), (2, "s2"), (3, None), (4, None), (5, None)]


def test_strategies_agree_on_skewed_keys(spark):
    rng = random.Random(5)
    left = spark.createDataFrame(
        [(i, "hot" if rng.random() < 0.4 else None if rng.random() < 0.2 else f"k{rng.randrange(50)}") for i in range(3000)],
        "id int, k string",
    ).repartition(5)
    right = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 50, 2)], "rk string, v int")
    results = [rows(attribute_join(left, right, {"k": "rk"}, "left", **o)) for o in STRATEGIES]
    assert results[0] == results[1] == results[2]
    looked = [rows(lookup_join(left, right, {"k": "rk"}, ["v"], ["v"], **o)) for o in STRATEGIES]
    assert looked[0] == looked[1] == looked[2]
    assert len(looked[0]) == 3000


def test_big_right_side_is_not_broadcast(log, songs):
    small = attribute_join(log, songs, ON, keep=["song_id"])
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    big = attribute_join(log, songs, ON, keep=["song_id"], broadcast_rows=2)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()


def test_enrich_roles_required_and_override(spark):
    df = spark.createDataFrame([(1, 10, 20, "old"), (2, 99, 10, "old"), (3, None, 10, "old")], "id int, a int, b int, name string")
    dim = spark.createDataFrame([(10, "ten"), (20, "twenty"), (None, "none")], "key int, label string")
    both = enrich(enrich(df, dim, "a", "key", {"label": "a_name"}), dim, "b", "key", {"label": "b_name"})
    assert rows(both.select("id", "a_name", "b_name")) == [(1, "ten", "twenty"), (2, None, "ten"), (3, None, "ten")]
    needed = enrich(df, dim, "a", "key", {"label": "name"}, required=True)
    assert rows(needed.select("id", "name")) == [(1, "ten")]


def test_keep_if_valid(spark):
    df = spark.createDataFrame([(1, "AL"), (2, "??"), (3, None)], "id int, state string")
    states = spark.createDataFrame([("AL",), ("AK",)], "code string")
    assert rows(keep_if_valid(df, "state", states, "code")) == [(1, "AL"), (2, None), (3, None)]


def test_unmatched_ignores_absent_keys(log, songs):
    assert rows(unmatched(log, songs, {"song": "title"}).select("id")) == [(3,)]
    assert rows(unmatched_counts(log, songs, {"song": "title"})) == [("b", 1)]


@pytest.mark.parametrize("options", STRATEGIES)
def test_keys_of_different_types_match(spark, options):
    left = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, k int")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "rk bigint, v string")
    assert attribute_join(left, right, {"k": "rk"}, **options).count() == 20


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.01, 0.05, 0.2])
def test_keys_hot_on_both_sides(spark, how, share):
    """Keys heavy on both sides, on one side only, absent on the other, and null ones: as a broadcast join."""
    rng = random.Random(9)
    pick = lambda heavy, n: [
        (i, rng.choice(heavy) if rng.random() < 0.6 else None if rng.random() < 0.1 else f"k{rng.randrange(60)}") for i in range(n)
    ]
    left = spark.createDataFrame(pick(["both", "left", "lone left"], 900), "id int, k string").repartition(4)
    right = spark.createDataFrame([*pick(["both", "right", "lone right"], 500), (-1, "left")], "v int, rk string").repartition(3)
    left = left.unionByName(spark.createDataFrame([(-2, "right")], "id int, k string"))
    plain = attribute_join(left, right, {"k": "rk"}, how)
    grid = attribute_join(left, right, {"k": "rk"}, how, broadcast_rows=0, hot_rows=1, hot_share=share)
    assert rows(grid) == rows(plain)


def test_grid_cells_are_even(spark):
    """A key with a third of both sides is dealt over cells of about equal size, and no side is copied to all of them."""
    n = 30_000
    side = spark.range(n).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k").repartition(6)
    hot = scale.hot_keys(side, ["k"], 1, 0.02)
    parts = next(iter(hot.values()))
    assert parts >= 8
    left, right = scale.grid_sides(side, side, ["k"], ["k"], hot, hot)
    for df, copies in ((left, parts), (right, parts)):
        cells = [r["count"] for r in df.where("k = 0").groupBy("_row", "_col").count().collect()]
        assert len(cells) == parts**2 and sum(cells) == copies * n // 3
        assert max(cells) < 1.3 * sorted(cells)[len(cells) // 2]
    assert left.where("k <> 0").count() == n - n // 3


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_sums_of_pairs_without_the_pairs(spark, how, kind):
    """Keys repeated on both sides, alone on one, null keys and values, right keys that a cast makes equal: as summed over the pairs."""
    left = spark.createDataFrame([(1, 5), (1, None), (1, 7), (2, 3), (3, 4), (None, 8), (None, 9), (4, None)], "k int, a int")
    right = spark.createDataFrame([("1", 10), ("1", 20), ("01", 5), ("2", None), ("4", 6), ("5", 1), (None, 2)], "rk string, b int")
    right = right.withColumn("rk", F.col("rk").cast(kind))
    pairs = attribute_join(left, right, {"k": "rk"}, how).groupBy("k").agg(F.count("*"), F.sum("a"), F.sum("b"))
    for options in ({}, {"broadcast_rows": 0}):
        assert rows(attribute_join_sums(left, right, {"k": "rk"}, how, {"sa": "a"}, {"sb": "b"}, **options)) == rows(pairs)


def test_sums_of_pairs_make_no_pairs(spark):
    """A key with 100,000 rows on both sides has 10 billion pairs."""
    side = spark.range(100_000).selectExpr("id", "0 AS k")
    got = attribute_join_sums(side, side.withColumnsRenamed({"id": "rid", "k": "rk"}), {"k": "rk"}, "left", {"a": "id"}, {"b": "rid"})
    assert rows(got) == [(0, 10**10, 4_999_950_000 * 10**5, 4_999_950_000 * 10**5)]
