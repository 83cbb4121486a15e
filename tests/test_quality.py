import pytest

from starloom.operators import quality as q


@pytest.fixture(scope="module")
def good(spark):
    return spark.createDataFrame([(1, "free", 10, 1.0), (2, "paid", 53, 2.0), (3, "free", 1, 3.0)], "k int, level string, n int, x double")


@pytest.fixture(scope="module")
def bad(spark):
    return spark.createDataFrame([(1, "trial", 54, -1.5), (1, "free", 0, 20000.0), (None, "paid", 5, 1.0)], "k int, level string, n int, x double")


CHECKS = {
    "not_null": q.no_nulls("k"),
    "set": q.in_set("level", ["free", "paid"]),
    "range": q.in_range("n", 1, 53),
    "low": q.lowest("x", lambda v: v > 0),
    "high": q.highest("x", lambda v: v < 10000),
    "unique": q.unique("k"),
    "exact": q.lossy_cast("x", "decimal(18,0)"),
    "length": q.max_length("level", 4),
}


@pytest.mark.parametrize("name", CHECKS)
def test_check_tells_good_from_bad(good, bad, name):
    assert q.run_checks({"t": (good, [CHECKS[name]])}).first()["passed"]
    assert not q.run_checks({"t": (bad, [CHECKS[name]])}).first()["passed"]


def test_null_and_overflow_fail(spark):
    df = spark.createDataFrame([("free", 5, 1e30), (None, None, 2.0)], "level string, n int, x double")
    checks = [q.in_set("level", ["free"]), q.in_range("n", 1, 9), q.lossy_cast("x", "decimal(18,0)")]
    assert [r["value"] for r in q.run_checks({"t": (df, checks)}).collect()] == [1.0, 1.0, 1.0]
    allowed = [q.in_set("level", ["free"], allow_null=True), q.in_range("n", 1, 9, allow_null=True)]
    assert [r["value"] for r in q.run_checks({"t": (df, allowed)}).collect()] == [0.0, 0.0]


def test_empty_table(spark, good):
    empty = good.limit(0)
    got = {r["check"]: r["passed"] for r in q.run_checks({"t": (empty, [q.not_empty(), q.lowest("x", lambda v: v > 0), q.unique("k")])}).collect()}
    assert got == {"not_empty": False, "min(x)": False, "unique(k)": True}


def test_references_allow_null(spark, good, bad):
    parent = spark.createDataFrame([("free",), ("paid",)], "level string")
    check = q.references("level", parent, "level")
    assert q.run_checks({"t": (good, [check])}).first()["passed"]
    report = q.run_checks({"t": (bad, [check])}).first()
    assert (report["value"], report["passed"]) == (1.0, False)


def test_report_and_enforce(good, bad):
    fine = q.run_checks({"good": (good, list(CHECKS.values()))})
    q.enforce(fine)
    mixed = q.run_checks({"good": (good, [q.not_empty()]), "bad": (bad, [q.not_empty(), q.unique("k"), q.in_set("level", ["free"])])})
    assert mixed.columns == q.REPORT_COLUMNS
    with pytest.raises(q.QualityError) as error:
        q.enforce(mixed)
    assert str(error.value) == "bad.in_set(level) = 2.0; bad.unique(k) = 1.0"


def test_simple_checks_share_one_aggregate(good):
    plan = q.run_checks({"t": (good, [CHECKS[c] for c in ("not_null", "set", "range", "low", "high")])})
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
