import pytest
from pyspark.sql import functions as F

from starloom import jobs
from starloom.plans import tables
from starloom.sources.snapshots import read_snapshot
from starloom.sources.writers import create_tables, drop_tables
from tests import test_arrivals, test_listening
from tests.conftest import rows

folders = test_listening.folders
raw = test_arrivals.raw


@pytest.fixture
def lookups(tmp_path):
    folder = tmp_path / "lookups"
    folder.mkdir()
    (folder / "country_ids.csv").write_text("country_id,country_name\n582,MEXICO  \n101,ALBANIA\n")
    (folder / "country_iso.csv").write_text("name,alpha-2,alpha-3,region\nMexico,MX,MEX,Americas\nAlbania,AL,ALB,Europe\n")
    (folder / "gdp.csv").write_text("Country Name,Country Code,Year,Value\nMexico,MEX,2016,100.5\n")
    (folder / "states.csv").write_text("state_code,state_name\nAL,ALABAMA\n")
    (folder / "ports.csv").write_text("port_id,port_name\nALC,ALCAN\n")
    return str(folder)


def test_listening_commands(spark, folders, tmp_path):
    out = str(tmp_path / "out")
    assert jobs.main(["listening", "--log", str(folders / "log"), "--songs", str(folders / "songs"), "--out", out]) == 0
    assert jobs.main(["check", "--domain", "listening", "--tables", out]) == 0
    spark.createDataFrame([("9", "F", None, "F", "trial")], tables.LISTENING_TABLES["users"]).write.mode("append").parquet(f"{out}/users")
    assert jobs.main(["check", "--domain", "listening", "--tables", out]) == 1


def test_arrivals_commands(spark, raw, lookups, tmp_path):
    source, out = str(tmp_path / "raw"), str(tmp_path / "out")
    raw.withColumn("cicid", F.col("cicid").cast("double")).write.parquet(source)
    assert jobs.main(["arrivals", "--raw", source, "--lookups", lookups, "--out", out]) == 0
    assert jobs.main(["check", "--domain", "arrivals", "--tables", out]) == 0
    assert jobs.main(["export", "--tables", out, "--out", str(tmp_path / "json")]) == 0
    assert rows(spark.read.json(str(tmp_path / "json" / "state"))) == [("AL", "ALABAMA")]
    for _ in range(2):
        assert jobs.main(["publish", "--tables", out, "--out", str(tmp_path / "kv")]) == 0
    assert rows(read_snapshot(spark, str(tmp_path / "kv" / "gdp")).select("country_code", "gdp_value")) == [("MEX", 100)]
    assert read_snapshot(spark, str(tmp_path / "kv" / "visa_type")).count() == 1
    model, features = str(tmp_path / "model"), str(tmp_path / "features")
    repeated = tables.read_tables(spark, out, ["ml_data"])["ml_data"].withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(60))))
    repeated.withColumn("is_overstay", F.col("id") % 3 == 0).drop("id").write.parquet(features)
    assert jobs.main(["train", "--features", features, "--model", model, "--folds", "2"]) == 0
    assert jobs.main(["score", "--features", features, "--model", model, "--out", str(tmp_path / "scored")]) == 0
    assert "probability_overstay" in spark.read.parquet(str(tmp_path / "scored")).columns


def test_declared_tables_can_be_created(spark, tmp_path):
    names = {f"starloom_{k}": v for k, v in {**tables.LISTENING_TABLES, **tables.ARRIVALS_TABLES}.items()}
    create_tables(spark, names, str(tmp_path))
    assert all(spark.table(n).count() == 0 for n in names)
    drop_tables(spark, list(names))
