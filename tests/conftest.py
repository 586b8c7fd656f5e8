import pytest

from footfall.adapter import web_events
from footfall.session import build_session

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "8",
            # plan tests read whole scan descriptions
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark, tmp_path_factory):
    """The web events as a stored table; cached frames would show up in other plans."""
    path = str(tmp_path_factory.mktemp("events") / "table")
    web_events(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def make_events(spark):
    """Web events from dicts; missing columns are NULL."""
    from datetime import datetime

    from footfall.schema import EVENT_COLUMNS, EVENT_DDL

    def make(rows):
        def value(row, name):
            given = row.get(name)
            if name == "timestamp" and isinstance(given, str):
                return datetime.fromisoformat(given)
            return given

        return spark.createDataFrame([tuple(value(r, c) for c in EVENT_COLUMNS) for r in rows], EVENT_DDL)

    return make
