import datetime
import json
import shutil

import pytest

from starloom import jobs
from starloom.operators import quality
from starloom.plans import listening as plan
from starloom.plans import listening_hourly as hourly
from starloom.sources import manifest
from starloom.sources.manifest import Store
from starloom.suite import listening as queries
from tests.conftest import rows

# Hand-written rows for the edges: another page, one user at two levels, a repeated
# second, an empty user id, an unknown song, a duration that is off, ISO week 53.
LOG = [
    dict(artist="Band", song="Hit", length=200.5, page="NextSong", userId="1", level="free", ts=1609459199999, sessionId=1, itemInSession=0),
    dict(artist="Band", song="Hit", length=200.5, page="NextSong", userId="1", level="paid", ts=1609459200000, sessionId=1, itemInSession=1),
    dict(artist="Band", song="Hit", length=199.0, page="NextSong", userId="2", level="free", ts=1609459200500, sessionId=2, itemInSession=0),
    dict(artist="Nobody", song="Miss", length=1.0, page="NextSong", userId="2", level="free", ts=1541105830796, sessionId=3, itemInSession=0),
    dict(artist="Solo", song="Twin", length=100.0, page="NextSong", userId="3", level="paid", ts=1541203200000, sessionId=4, itemInSession=0),
    dict(artist=None, song=None, length=None, page="Home", userId="", level="free", ts=1541105830000, sessionId=5, itemInSession=0),
]
SONGS = [
    dict(song_id="S1", title="Hit", artist_id="A1", artist_name="Band", artist_location="X", duration=200.5, year=0),
    dict(song_id="S2", title="Twin", artist_id="A2", artist_name="Solo", artist_location="Y", duration=100.0, year=1999),
    dict(song_id="S3", title="Twin", artist_id="A2", artist_name="Solo", artist_location="Z", duration=100.0, year=2000),
    dict(song_id="S4", title="Hit", artist_id="A1", artist_name="Band", artist_location="X", duration=300.0, year=2001),
]


def full(record):
    base = dict(firstName=f"F{record['userId']}", lastName=f"L{record['userId']}", gender="F", location="here", userAgent="app")
    return {**base, **record}


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    root = tmp_path_factory.mktemp("listening")
    for i, record in enumerate(LOG):
        (root / f"log/2018/{i}").mkdir(parents=True)
        (root / f"log/2018/{i}/events.json").write_text(json.dumps(full(record)) + "\n")
    for i, record in enumerate(SONGS):
        (root / f"songs/A/{i}").mkdir(parents=True)
        (root / f"songs/A/{i}/song.json").write_text(json.dumps(record))
    return root


@pytest.fixture(scope="module")
def log(spark, folders):
    return plan.read_json(spark, str(folders / "log"), plan.LOG_SCHEMA)


@pytest.fixture(scope="module")
def catalog(spark, folders):
    return plan.read_json(spark, f"{folders}/songs/*/*/*.json", plan.SONG_SCHEMA)


@pytest.mark.parametrize("match, expected", [
    ("lookup", [("1", "S1"), ("1", "S1"), ("2", None), ("2", None), ("3", "S2")]),
    ("left", [("1", "S1"), ("1", "S1"), ("2", None), ("2", None), ("3", "S2"), ("3", "S3")]),
    ("inner", [("1", "S1"), ("1", "S1"), ("1", "S4"), ("1", "S4"), ("2", "S1"), ("2", "S4"), ("3", "S2"), ("3", "S3")]),
])
def test_fact_variants(log, catalog, match, expected):
    fact = plan.build_fact(log, catalog, match)
    assert rows(fact.select("user_id", "song_id")) == sorted(expected, key=repr)
    assert fact.select("play_id").distinct().count() == len(expected)
    sequence = plan.build_fact(log, catalog, match, row_id="sequence")
    assert sequence.select("play_id").distinct().count() == len(expected)


def test_unknown_options(log, catalog):
    with pytest.raises(ValueError):
        plan.build_fact(log, catalog, "outer")
    with pytest.raises(ValueError):
        plan.users(log, "any")


def test_users(log):
    assert rows(plan.users(log).select("user_id", "level")) == [("1", "paid"), ("2", "free"), ("3", "paid")]
    assert rows(plan.users(log, "distinct").select("user_id", "level")) == [("1", "free"), ("1", "paid"), ("2", "free"), ("3", "paid")]
    assert rows(plan.users(log, "one").select("user_id", "level")) == [("1", "free"), ("2", "free"), ("3", "paid")]


def test_catalog_dimensions(catalog):
    assert rows(plan.songs(catalog).select("song_id")) == [("S1",), ("S2",), ("S3",), ("S4",)]
    assert rows(plan.artists(catalog).select("artist_id", "location")) == [("A1", "X"), ("A2", "Y")]
    assert plan.artists(catalog, "distinct").count() == 3


def test_time_dimension(log):
    played = plan.plays(log)
    dim = plan.time_dimension(played, "start_time")
    assert rows(dim) == [
        (1541105830, 20, 1, 44, 11, 2018, 4), (1541203200, 0, 3, 44, 11, 2018, 6),
        (1609459199, 23, 31, 53, 12, 2020, 4), (1609459200, 0, 1, 53, 1, 2021, 5),
    ]
    assert plan.time_dimension(played, "start_time", distinct=False).count() == 5


def test_analysis(log, catalog):
    fact = plan.build_fact(log, catalog)
    time = plan.time_dimension(plan.plays(log), "start_time")
    assert rows(plan.top_songs(fact, plan.songs(catalog), 1)) == [("S1", "Hit", 2)]
    assert rows(plan.top_artists(fact, plan.artists(catalog), 5, ascending=True), "as is") == [("A2", "Solo", 1), ("A1", "Band", 2)]
    assert rows(plan.top_users(fact, plan.users(log), 1), "as is") == [("1", "F1", "L1", "paid", 2)]
    assert rows(plan.plays_on(fact, time, 2018, 11, 3)) == [(1,)]
    assert rows(plan.plays_on(fact, time, 1990, 1, 1)) == [(0,)]
    assert rows(plan.plays_by_weekday(fact, time), "as is") == [(4, 2), (5, 2), (6, 1)]
    assert rows(plan.plays_by_month(fact, time, 2018), "as is") == [(2018, 11, 2)]


def test_count_by_equals_join_then_count(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "z")], "pk int, name string")
    got = plan.count_by(fact, "k", dim, "pk", ["name"], "n")
    joined = fact.join(dim, fact.k == dim.pk).groupBy("name").count()
    assert rows(got) == rows(joined) == [("a", 3), ("b", 2)]


def test_query_table_later_row_wins(spark, tmp_path):
    data = spark.createDataFrame([(1, 0, "a", 1), (1, 0, "b", 2), (1, 1, "c", 1), (2, 0, "d", 1)], "s int, i int, song string, ts int")
    table = plan.query_table(data, ["s"], ["i"], ["song"], ["ts"])
    assert rows(table) == [(1, 0, "b"), (1, 1, "c"), (2, 0, "d")]
    plan.write_query_table(table, str(tmp_path / "t"), ["s"], ["i"])
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(table)


def test_load_and_check(spark, folders, tmp_path):
    out = str(tmp_path)
    for _ in range(2):
        plan.load(spark, str(folders / "log"), str(folders / "songs"), out)
    tables = {name: spark.read.parquet(f"{out}/{name}") for name in ("songs", "artists", "users", "time", "songplays")}
    assert {name: df.count() for name, df in tables.items()} == {"songs": 4, "artists": 2, "users": 3, "time": 4, "songplays": 5}
    report = quality.run_checks({
        "users": (tables["users"], [quality.not_empty(), quality.no_nulls("user_id"), quality.in_set("level", plan.LEVELS)]),
        "songs": (tables["songs"], [quality.unique("song_id"), quality.lowest("duration", lambda v: v > 0)]),
        "time": (tables["time"], [quality.in_range("week", 1, 53), quality.in_range("hour", 0, 23)]),
        "songplays": (tables["songplays"], [
            quality.unique("play_id"),
            quality.references("user_id", tables["users"], "user_id"),
            quality.references("song_id", tables["songs"], "song_id"),
            quality.references("start_time", tables["time"], "start_time"),
        ]),
    })
    quality.enforce(report)


def hourly_files(folders, tmp_path, hours):
    """The log's files dealt over hours, and all songs."""
    source = sorted(p for p in (folders / "log").rglob("*.json"))
    lines = [line for p in source for line in p.read_text().splitlines() if line.strip()]
    shutil.copytree(folders / "songs", tmp_path / "songs", dirs_exist_ok=True)
    return [lines[h::hours] for h in range(hours)]


def everything(spark, out):
    store = Store(spark, out)
    return {name: rows(hourly.table(store, name)) for name in ("songplays", "users", "songs", "artists", "time")}


@pytest.mark.parametrize("match", ["lookup", "left", "inner"])
def test_hours_equal_one_load(spark, folders, tmp_path, match):
    """Three hourly runs, a replay and a lost checkpoint give the tables of one full load."""
    (tmp_path / "log").mkdir()
    out, songs, log = str(tmp_path / "out"), str(tmp_path / "songs"), str(tmp_path / "log")
    for h, lines in enumerate(hourly_files(folders, tmp_path, 3)):
        (tmp_path / "log" / f"{h}.json").write_text("\n".join(lines))
        hourly.run(spark, log, songs, out, str(tmp_path / "progress"), match)
    version = Store(spark, out).commit().version
    hourly.run(spark, log, songs, out, str(tmp_path / "progress"), match)
    assert Store(spark, out).commit().version == version
    after = everything(spark, out)
    hourly.run(spark, log, songs, out, str(tmp_path / "lost"), match)
    assert everything(spark, out) == after
    plan.load(spark, log, songs, str(tmp_path / "full"), match)
    for name, got in after.items():
        full = spark.read.parquet(f"{tmp_path}/full/{name}")
        assert rows(hourly.table(Store(spark, out), name).select(*sorted(full.columns))) == rows(full.select(*sorted(full.columns))), name


def test_a_bad_level_stops_with_nothing_written(spark, folders, tmp_path):
    (tmp_path / "log").mkdir()
    out, args = str(tmp_path / "out"), [str(tmp_path / "log"), str(tmp_path / "songs"), str(tmp_path / "out"), str(tmp_path / "progress")]
    first, second = hourly_files(folders, tmp_path, 2)
    (tmp_path / "log" / "0.json").write_text("\n".join(first))
    hourly.run(spark, *args)
    before = everything(spark, out)
    bad = json.loads(next(x for x in second if "NextSong" in x)) | {"level": "trial", "userId": "77"}
    (tmp_path / "log" / "1.json").write_text("\n".join([*second, json.dumps(bad)]))
    for _ in range(2):
        with pytest.raises(quality.QualityError, match="in_set"):
            hourly.run(spark, *args)
        assert everything(spark, out) == before
    command = ["hourly", "--log", args[0], "--songs", args[1], "--out", out, "--progress", args[3]]
    assert jobs.main(command) == 1
    (tmp_path / "log" / "1.json").write_text("\n".join(second))
    assert jobs.main(command) == 0
    assert everything(spark, out)["songplays"] != before["songplays"]


def test_an_older_state_that_arrives_later(spark, folders, tmp_path):
    """The user keeps the newest state, whatever order it comes in; new plays of a stored second add no moment."""
    lines = [json.loads(x) for part in hourly_files(folders, tmp_path, 1) for x in part if "NextSong" in x]
    play = max(lines, key=lambda r: r["ts"])
    older = play | {"ts": play["ts"] - 5000, "level": "free", "itemInSession": 90}
    newer = play | {"ts": play["ts"], "level": "paid", "itemInSession": 91}
    for n, record in enumerate((newer, older, newer | {"itemInSession": 92})):
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(record))
        hourly.add_plays(spark, plan.read_json(spark, str(path), plan.LOG_SCHEMA), str(tmp_path / "out"))
    got = {n: hourly.table(Store(spark, str(tmp_path / "out")), n) for n in ("users", "time", "songplays")}
    assert [r.level for r in got["users"].collect()] == ["paid"]
    assert got["time"].count() == 2 and got["songplays"].count() == 3


def test_many_appends_are_joined(spark, tmp_path):
    change = Store(spark, str(tmp_path / "s")).begin()
    for n in range(3):
        change.append("t", spark.createDataFrame([(1, n), (2 + n, n)], "d int, v int"), ["d"])
    assert sorted(len(manifest.holders(v)) for v in change.units["t"].values()) == [1, 1, 1, 3]
    before = rows(change.read("t"))
    assert change.compact("t", ["d"], parts=3) == ["d=1"]
    assert rows(change.read("t")) == before and {len(manifest.holders(v)) for v in change.units["t"].values()} == {1}


def test_stored_plays_are_left_out_before_they_are_matched(spark, log, catalog, tmp_path, monkeypatch):
    """A replay by another stream matches no play; one new play among the stored ones is the only one matched."""
    out, matched, build = str(tmp_path / "out"), [], plan.build_fact

    def counting(rows, *args, **options):
        matched.append(rows.count())
        return build(rows, *args, **options)

    monkeypatch.setattr(plan, "build_fact", counting)
    hourly.add_songs(spark, catalog, out)
    new = spark.createDataFrame([full({**LOG[0], "sessionId": 9})], plan.LOG_SCHEMA)
    for step in (log, log, log.unionByName(new)):
        hourly.add_plays(spark, step, out)
    assert matched == [5, 0, 1]
    assert hourly.table(Store(spark, out), "songplays").count() == 6


def _play_tables(spark, tmp_path):
    day = datetime.datetime(2020, 1, 1)
    tables = {
        "lineitem": ([(i, i % 3, 1, "N", "F", 0.0, day) for i in range(9)], "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_discount double, l_shipdate timestamp"),
        "orders": ([(i, i % 4, "O", "1-URGENT") for i in range(9)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "part": ([(i, f"p{i}", "b", "t", 2, 10.0) for i in range(3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")


def test_raw_log_is_written_compressed(spark, tmp_path, monkeypatch):
    """The load's raw records, by far its largest output, lie compressed, and all of them are loaded."""
    _play_tables(spark, tmp_path)
    monkeypatch.setattr(queries, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    got = {r["table"]: (r["n"], r["n_matched"]) for r in queries.listening_load(spark, str(tmp_path)).collect()}
    assert got == {"songplays": (9, 9), "songs": (3, 3), "artists": (1, 1), "users": (4, 4), "time": (9, 9)}
    files = [p.name for kind in ("log", "songs") for p in (tmp_path / "listening" / kind).glob("part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)


def test_hourly_keeps_no_more_than_its_files_and_tables(spark, tmp_path, monkeypatch):
    """Raw files lie compressed; what a step stages, and the rows that the raw files are cut from, go when they have served."""
    _play_tables(spark, tmp_path)
    monkeypatch.setattr(queries, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(hourly, "scratch", lambda spark, name: f"{tmp_path}/staged/{name}")
    got = {r["table"]: r["n"] for r in queries.listening_hourly(spark, str(tmp_path)).collect() if r["year"] in (None, 2020)}
    assert got == {"songplays": 9, "songs": 3, "artists": 1, "users": 4, "time": 9}
    files = [p.name for kind in ("log", "songs") for p in (tmp_path / "hourly" / kind).rglob("part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert not list((tmp_path / "staged").rglob("part-*")) and not list((tmp_path / "hourly/steps").rglob("part-*"))


def test_a_step_that_fails_leaves_no_staged_rows(spark, log, catalog, tmp_path, monkeypatch):
    monkeypatch.setattr(hourly, "scratch", lambda spark, name: f"{tmp_path}/staged/{name}")
    with pytest.raises(quality.QualityError):
        hourly.add_plays(spark, log.replace("paid", "gold"), str(tmp_path / "out"))
    assert not list((tmp_path / "staged").rglob("part-*"))
