import pytest

from starloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="6g",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as plain tuples, sorted for comparison."""
    got = [tuple(r) for r in df.collect()]
    return got if order == ("as is",) else sorted(got, key=repr)
