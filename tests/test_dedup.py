import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import dedup
from tests.conftest import rows


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(11)
    data = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), i, rng.randrange(5), rng.choice([None, "x", "y"])) for i in range(500)]
    return spark.createDataFrame(data, "k string, seq int, n int, v string").repartition(4)


def brute(events, pick):
    best = {}
    for r in events.collect():
        key = r["k"]
        if key not in best or pick(r, best[key]):
            best[key] = r
    return sorted([tuple(r) for r in best.values()], key=repr)


def test_latest_and_first(events):
    assert rows(dedup.latest_per_key(events, ["k"], ["seq"])) == brute(events, lambda a, b: a["seq"] > b["seq"])
    assert rows(dedup.first_per_key(events, ["k"], ["seq"])) == brute(events, lambda a, b: a["seq"] < b["seq"])


def test_latest_equals_rank_one(events):
    ranked = dedup.top_n_per_key(events, ["k"], [F.desc("n"), F.desc("seq")])
    assert rows(ranked) == rows(dedup.latest_per_key(events, ["k"], ["n", "seq"]))


def test_top_n(events):
    got = dedup.top_n_per_key(events, ["k"], [F.asc("seq")], 3)
    assert got.groupBy("k").count().where("count <> 3").count() == 0


def test_one_per_key_is_repeatable(events):
    once = rows(dedup.one_per_key(events, ["k"]))
    assert once == rows(dedup.one_per_key(events.repartition(7), ["k"]))
    assert len(once) == 4


def test_key_only_frame(events):
    assert len(rows(dedup.one_per_key(events.select("k"), ["k"]))) == 4


def test_user_at_two_levels_stays_twice(spark):
    df = spark.createDataFrame([(1, "free"), (1, "paid"), (1, "free")], "user int, level string")
    assert rows(dedup.distinct_dimension(df, ["user", "level"])) == [(1, "free"), (1, "paid")]


def test_row_ids_are_unique(events):
    assert dedup.with_row_id(events).select("row_id").distinct().count() == 500


def test_duplicated_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedup.duplicated_keys(df, ["k"])) == [(1, 2)]


def test_per_task_reduction_before_the_shuffle(events):
    """A hot key must not reach one reducer row by row."""
    plan = dedup.top_n_per_key(events, ["k"], [F.desc("seq")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    plan = dedup.latest_per_key(events, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(" in plan
