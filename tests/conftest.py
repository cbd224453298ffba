import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tradewatch.session import build_session  # noqa: E402
from tradewatch.sources.events import load_event_trades  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


@pytest.fixture(scope="session")
def small_trades(spark):
    return load_event_trades(spark, SMALL).cache()


@pytest.fixture(scope="session")
def medium_trades(spark):
    return load_event_trades(spark, MEDIUM).cache()
