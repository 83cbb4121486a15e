from starloom import session


def test_shuffles_grow_with_the_input_and_never_shrink(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert session.stored_bytes(spark, path) > 1000
    session.size_shuffles(spark, path)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    monkeypatch.setattr(session, "PARTITION_BYTES", 100)
    session.size_shuffles(spark, path)
    try:
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == -(-session.stored_bytes(spark, path) // 100)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_configure_keeps_foreign_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    session.configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
