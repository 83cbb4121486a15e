import datetime as dt
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from starloom.plans import arrivals as plan
from tests.conftest import rows

SCHEMA = (
    "cicid bigint, admnum double, i94yr double, i94mon double, i94cit double, i94res double, i94port string, i94addr string, "
    "arrdate double, depdate double, dtaddto string, matflag string, i94mode double, i94visa double, i94bir double, "
    "gender string, visatype string, entdepa string, entdepd string, entdepu string, occup string"
)
NAMES = [field.strip().split(" ")[0] for field in SCHEMA.split(",")]
BASE = dict(
    cicid=0, admnum=1.0, i94yr=2016.0, i94mon=4.0, i94cit=582.0, i94res=582.0, i94port="ALC", i94addr="AL", arrdate=20566.0,
    depdate=20570.0, dtaddto="10292016", matflag="M", i94mode=1.0, i94visa=2.0, i94bir=30.0, gender="F", visatype="B2",
    entdepa="G", entdepd="O", entdepu=None, occup=None,
)
# One change each, after the edges the record format allows.
CHANGES = [
    {},
    {"arrdate": 20567.0, "depdate": -1.0},
    {"arrdate": 20567.0, "depdate": None, "dtaddto": "D/S"},
    {"admnum": 0.0, "dtaddto": "bad", "gender": "X", "i94mode": 9.0},
    {"admnum": 0.0, "dtaddto": None, "gender": None, "i94mode": None, "i94visa": 4.0},
    {"admnum": 2.0, "matflag": None, "depdate": None, "entdepd": None},
    {"admnum": 3.0, "matflag": None, "depdate": 20570.0, "entdepd": None},
    {"admnum": 4.0, "matflag": None, "depdate": None, "entdepd": "W"},
    {"admnum": 5.0, "matflag": None, "depdate": None, "entdepd": None, "entdepu": "U"},
    {"admnum": 6.0, "matflag": None, "depdate": None, "entdepd": None, "dtaddto": "D/S"},
    {"admnum": 7.0, "i94addr": "??", "i94port": "???"},
    {"admnum": 8.0, "i94cit": 999.0},
    {"admnum": 9.0, "i94res": 101.0, "i94bir": None},
]


@pytest.fixture(scope="module")
def raw(spark):
    records = [{**BASE, **change, "cicid": i} for i, change in enumerate(CHANGES)]
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in records], SCHEMA)


@pytest.fixture(scope="module")
def dims(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lookups")
    (folder / "country_ids.csv").write_text("country_id,country_name\n582,MEXICO  \n101,ALBANIA\n999,YUGOSLAVIA\n")
    (folder / "country_iso.csv").write_text(
        'name,alpha-2,alpha-3,country-code,region,sub-region\nMexico,MX,MEX,484,Americas,""\nAlbania,AL,ALB,008,Europe,Southern\n'
    )
    (folder / "gdp.csv").write_text(
        "Country Name,Country Code,Year,Value\nMexico,MEX,2015,1.5e9\nMexico,MEX,2016,18624475000000.0\nMexico,MEX,1999,7\n"
    )
    (folder / "states.csv").write_text("state_code,state_name\nAL,ALABAMA\n")
    (folder / "ports.csv").write_text('port_id,port_name\nALC," ALCAN, AK "\n')
    return plan.read_dimensions(spark, str(folder))


@pytest.fixture(scope="module")
def clean(raw):
    return plan.clean_arrivals(raw, tie=["cicid"])


def column(df, name):
    return [r[name] for r in df.orderBy("cicid").select(name).collect()]


def test_dates(clean):
    assert column(clean, "departure_date")[:3] == [dt.date(2016, 4, 26), dt.date(1900, 1, 1), None]
    assert column(clean, "permitted_date")[:5] == [dt.date(2016, 10, 29), dt.date(2016, 10, 29), None, None, None]
    assert column(clean, "unrestricted_stay")[:5] == [False, False, True, False, False]
    assert column(clean, "day")[:2] == [22, 23]


def test_codes(clean):
    assert column(clean, "gender")[2:5] == ["F", "OTHER", "UNSPECIFIED"]
    assert column(clean, "travel_mode")[2:5] == ["Air", "Other", None]
    assert column(clean, "visa_category")[3:5] == ["Pleasure", "Other"]
    assert "occup" not in clean.columns


def test_only_the_record_without_any_trace_is_an_overstay(clean):
    assert [i for i, flag in enumerate(column(clean, "is_overstay")) if flag] == [5]


def test_previous_stays(clean, raw):
    assert column(clean, "num_previous_stays")[:5] == [0, 1, 2, 0, 0]
    assert column(clean, "admnum")[3:5] == [0, 0]
    counted = plan.clean_arrivals(raw, tie=["cicid"], previous_of_unknown=True)
    assert column(counted, "num_previous_stays")[:5] == [0, 1, 2, 0, 1]
    assert rows(plan.clean_arrivals(raw)).__len__() == len(CHANGES)


def test_lookups(dims):
    assert rows(dims.countries) == [(101, "ALB", "Albania"), (582, "MEX", "Mexico")]
    assert rows(dims.gdp.select("country_code", "year", "gdp_value")) == [("MEX", 2016, 18624475000000)]
    assert dims.iso.columns == ["country_code", "country_name", "country_code_iso_2", "continent"]


def test_enrich(clean, dims):
    fact = plan.enrich_arrivals(clean, dims, ["cicid", *plan.FACT_COLUMNS])
    got = {r["cicid"]: r for r in fact.collect()}
    assert 11 not in got and len(got) == len(CHANGES) - 1
    assert (got[0]["port_name"], got[0]["destination_state"], got[0]["country_citizenship"]) == ("ALCAN, AK", "AL", "MEX")
    assert (got[10]["port_name"], got[10]["destination_state"]) == (None, None)
    assert got[12]["country_residence"] == "ALB"


def test_dropped_arrivals(spark, raw, dims):
    """Ids without a country, and arrivals without an id, are counted; the fact has the others."""
    some = raw.withColumn("i94res", F.when(F.col("cicid") < 2, None).otherwise(F.col("i94res")))
    clean = plan.clean_arrivals(some, tie=["cicid"])
    dropped = plan.dropped_arrivals(clean, dims.countries)
    assert rows(dropped.select("role", "country_id", "n")) == [("citizenship", 999, 1), ("residence", None, 2)]
    assert plan.enrich_arrivals(clean, dims).count() == len(CHANGES) - 3


def test_outputs(spark, raw, dims, tmp_path):
    out = str(tmp_path)
    for _ in range(2):
        plan.run(spark, raw, dims, out, tie=["cicid"])
    fact = plan.output(spark, out, "immigration")
    assert sorted(fact.columns) == sorted(plan.FACT_COLUMNS) and fact.count() == 12
    assert list(tmp_path.glob("data/immigration/*/year=2016/month=4/day=22"))
    assert rows(plan.output(spark, out, "visa_type")) == [("B2", "Other"), ("B2", "Pleasure")]
    ml = plan.output(spark, out, "ml_data")
    assert sorted(ml.columns) == sorted({*plan.FEATURE_COLUMNS, "year"})
    assert rows(ml.select("country_citizenship_gdp", "country_residence_gdp").distinct()) == [
        (18624475000000, 18624475000000), (18624475000000, None),
    ]
    stats = plan.output(spark, out, "immigration_stats").select("country_code_iso_2", "year", "month", "day", "count")
    assert rows(stats) == [("MX", 2016, 4, 22, 10), ("MX", 2016, 4, 23, 2)]
    assert rows(plan.output(spark, out, "dropped").select("role", "country_id", "n")) == [("citizenship", 999, 1)]
    before = rows(fact.select("admnum", "arrival_date", "num_previous_stays"))
    # the same persons a year on: their stays so far count, and the first year's rows stay as they are
    later = raw.withColumns({"arrdate": F.col("arrdate") + 365, "i94yr": F.lit(2017.0)})
    plan.run(spark, later, dims, out, tie=["cicid"])
    fact = plan.output(spark, out, "immigration")
    assert rows(fact.where("year = 2016").select("admnum", "arrival_date", "num_previous_stays")) == before
    known = fact.where("admnum > 0").groupBy("admnum").agg(F.max("num_previous_stays").alias("most"), F.count("*").alias("n"))
    assert known.where("most + 1 < n").count() == 0


def parts_of(raw):
    """The records as days: one person's over four days, others' on some of them, one day per batch."""
    day = lambda n: raw.where(F.col("cicid") % 2 == n % 2).withColumns({
        "arrdate": F.lit(20566.0 + n), "cicid": F.col("cicid") + 100 * n, "i94mon": F.lit(4.0),
        "admnum": F.when(F.col("cicid") > 8, 1.0).otherwise(F.col("admnum")),
    })
    return [day(n) for n in range(4)]


def everything(spark, out):
    return {n: rows(plan.output(spark, out, n)) for n in ("immigration", "ml_data", "immigration_stats", "visa_type", "stays", "gdp")}


@pytest.fixture(scope="module")
def full(spark, raw, dims, tmp_path_factory):
    """All tables after one load of all records."""
    out, days = str(tmp_path_factory.mktemp("full")), parts_of(raw)
    plan.run(spark, days[0].union(days[1]).union(days[2]).union(days[3]), dims, out, tie=["cicid"])
    return everything(spark, out)


@pytest.mark.parametrize("order", [[3, 1, 0, 2], [1, 2, 0, 3, 2]])
def test_days_in_any_order(spark, raw, dims, tmp_path, full, order):
    """Days in any order, some of them twice, equal one load of all records, in every table and row."""
    days = parts_of(raw)
    for n in order:
        plan.run(spark, days[n], dims, str(tmp_path), tie=["cicid"])
    assert everything(spark, str(tmp_path)) == full


def test_a_day_again_with_other_records(spark, raw, dims, tmp_path):
    """A day that comes again with fewer records moves the numbers of later days back."""
    days = parts_of(raw)
    fewer = days[0].where("cicid < 10")
    for part in (days[0], days[1], days[2], fewer):
        plan.run(spark, part, dims, str(tmp_path / "again"), tie=["cicid"])
    plan.run(spark, fewer.union(days[1]).union(days[2]), dims, str(tmp_path / "full"), tie=["cicid"])
    again, full = everything(spark, str(tmp_path / "again")), everything(spark, str(tmp_path / "full"))
    assert {k: v for k, v in again.items() if k != "visa_type"} == {k: v for k, v in full.items() if k != "visa_type"}
    assert set(again["visa_type"]) >= set(full["visa_type"])


def test_late_days_rewrite_only_touched_partitions(spark, raw, dims, tmp_path):
    out, days = str(tmp_path), parts_of(raw)
    person = lambda df, n: df.where(F.col("admnum") == n)
    other = days[2].withColumn("arrdate", F.lit(20572.0)).withColumn("admnum", F.col("admnum") + 50)
    for part in (days[3], other, person(days[1], 1.0)):
        plan.run(spark, part, dims, out, tie=["cicid"])
    written = {u: int(v.split("-")[0]) for u, v in plan.Store(spark, out).commit().units["immigration"].items()}
    assert written == {"year=2016/month=4/day=25": 3, "year=2016/month=4/day=28": 2, "year=2016/month=4/day=23": 3}


def test_one_day_of_a_person_in_two_partitions(spark, raw, dims, tmp_path):
    out = str(tmp_path)
    plan.run(spark, raw, dims, out, tie=["cicid"])
    before = everything(spark, out)
    with pytest.raises(plan.SplitDayError):
        plan.run(spark, raw.withColumn("i94mon", F.lit(5.0)), dims, out, tie=["cicid"])
    assert everything(spark, out) == before


def test_a_batch_runs_once(spark, raw, dims, tmp_path):
    days = parts_of(raw)
    for version, (part, batch) in enumerate([(days[0], 0), (days[1], 1)], 1):
        for _ in range(2):
            assert plan.run(spark, part, dims, str(tmp_path), tie=["cicid"], writer="daily", batch=batch) == version


def test_a_failed_load_shows_nothing(spark, raw, dims, tmp_path, monkeypatch, full):
    """A load that stops before any one of its writes, or before its commit, leaves all tables as they were, and can run again."""
    out, days = str(tmp_path), parts_of(raw)
    for n in (1, 2, 3):
        plan.run(spark, days[n], dims, out, tie=["cicid"])
    before, commit = everything(spark, out), plan.Store(spark, out).commit()
    real = plan.Change.replace
    for fails_at in range(10):
        calls = iter(range(100))

        def stopping(self, *args, **kwargs):
            if next(calls) == fails_at:
                raise RuntimeError("lost")
            return real(self, *args, **kwargs)

        monkeypatch.setattr(plan.Change, "replace", stopping)
        if fails_at == 9:
            monkeypatch.setattr(plan.Store, "_publish", lambda self, commit: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            plan.run(spark, days[0], dims, out, tie=["cicid"])
        assert plan.Store(spark, out).commit() == commit  # units of a commit are never written again
    assert everything(spark, out) == before
    monkeypatch.undo()
    plan.run(spark, days[0], dims, out, tie=["cicid"])
    assert everything(spark, out) == full


def test_no_python_in_the_plan(raw, dims):
    plan_text = plan.enrich_arrivals(plan.clean_arrivals(raw, ["cicid"]), dims)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan_text


def test_independent_outputs_are_written_at_one_time():
    """Each step waits for the others; an error of one is raised once all have ended."""
    meet, ended = Barrier(3), []

    def step(n):
        meet.wait(20)
        if n == 1:
            raise ValueError("broken")
        ended.append(n)

    with pytest.raises(ValueError, match="broken"):
        plan._together(*[lambda n=n: step(n) for n in range(3)])
    assert sorted(ended) == [0, 2]
