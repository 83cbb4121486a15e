import datetime as dt

from pyspark.sql import functions as F

from starloom import functions as fn
from tests.conftest import rows


def one(spark, schema, values, *cols):
    return [tuple(r) for r in spark.createDataFrame([(v,) for v in values], schema).select(*cols).collect()]


def test_epoch_seconds_floors(spark):
    got = one(spark, "ms bigint", [1541105830796, 999, 0, -1, -1001, 9_007_199_254_740_993_000, None], fn.epoch_seconds("ms"))
    assert [g[0] for g in got] == [1541105830, 0, 0, -1, -2, 9_007_199_254_740_993, None]


def test_time_parts_at_year_turn(spark):
    # 2020-12-31 23:59:59 (Thursday, ISO week 53) and the next second
    df = spark.createDataFrame([(1609459199,), (1609459200,)], "s bigint")
    ts = fn.epoch_timestamp("s")
    sunday = df.select(*[c.alias(n) for n, c in fn.time_parts(ts).items()])
    assert rows(sunday, "as is") == [(23, 31, 53, 12, 2020, 4), (0, 1, 53, 1, 2021, 5)]
    monday = df.select(fn.time_parts(ts, "monday")["weekday"])
    assert rows(monday, "as is") == [(3,), (4,)]


def test_date_from_days(spark):
    got = one(spark, "d double", [0.0, 20566.0, 2.7, -1.0, -0.5, None], fn.date_from_days("d"))
    assert [g[0] for g in got] == [
        dt.date(1960, 1, 1), dt.date(2016, 4, 22), dt.date(1960, 1, 3), dt.date(1900, 1, 1), dt.date(1900, 1, 1), None,
    ]


def test_parse_date_and_flag(spark):
    got = one(spark, "s string", ["10292016", "D/S", "13452016", "", None], fn.parse_date("s"), fn.flag_equals("s", "D/S"))
    assert got == [(dt.date(2016, 10, 29), False), (None, True), (None, False), (None, False), (None, False)]


def test_codes(spark):
    got = one(spark, "g string", ["M", "F", "X", None], fn.normalize_codes("g", ["M", "F"]))
    assert [g[0] for g in got] == ["M", "F", "OTHER", "UNSPECIFIED"]
    kept = one(spark, "g string", ["X", None], fn.normalize_codes("g", ["M"], null_as=None))
    assert [g[0] for g in kept] == ["OTHER", None]
    modes = one(spark, "m int", [1, 2, 3, 9, None], fn.map_codes("m", {1: "Air", 2: "Sea", 3: "Land"}))
    assert [m[0] for m in modes] == ["Air", "Sea", "Land", "Other", None]


def test_sentinels(spark):
    got = one(spark, "n bigint", [0, 5, None], fn.null_if("n", 0), fn.value_or("n", 0), fn.is_present("n"))
    assert got == [(None, 0, True), (5, 5, True), (None, 0, False)]


def test_title_trim(spark):
    got = one(spark, "s string", ["MEXICO  ", " NEW  zealand", "GUINEA-BISSAU", None], fn.title_trim("s"))
    assert [g[0] for g in got] == ["Mexico", "New  Zealand", "Guinea-bissau", None]


def test_label_of_null_predicate_is_false(spark):
    got = one(spark, "b boolean", [True, False, None], fn.label_when(F.col("b")))
    assert [g[0] for g in got] == [True, False, False]


def test_to_long(spark):
    got = one(spark, "s string", ["18624475000000.0", "x", None], fn.to_long("s"), fn.to_long("s", via_float=True))
    assert got == [(18624475000000, 18624475561984), (None, None), (None, None)]


def test_hash_key_separates_columns_and_nulls(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("abc", None), ("ab", "c")], "x string, y string")
    got = [r[0] for r in df.select(fn.hash_key("x", "y")).collect()]
    assert len(set(got)) == 4 and got[0] == got[4] and all(len(g) == 32 for g in got)


def test_impute(spark):
    df = spark.createDataFrame([(None, None), (1.5, "a")], "n double, s string")
    assert rows(fn.impute(df, {"n": 0, "s": "MISSING"}), "as is") == [(0.0, "MISSING"), (1.5, "a")]
