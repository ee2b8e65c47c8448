import datetime as dt
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfcast.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_driver_memory="8g",
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def series(spark):
    """Builds (Store, Date, Sales, Open) rows from {store: [(day offset, sales), ...]}."""
    def build(stores):
        start = dt.date(2014, 12, 20)
        rows = [
            (store, start + dt.timedelta(days=offset), sales, 1)
            for store, days in stores.items() for offset, sales in days
        ]
        return spark.createDataFrame(rows, "Store bigint, Date date, Sales bigint, Open int")

    return build
