import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from candela.session import build_session

    s = build_session(
        app_name="candela-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def closes(spark):
    """Build (symbol, trade_date, close_price) rows on consecutive days."""
    import datetime as dt

    def make(prices, symbol="T"):
        d0 = dt.date(2024, 1, 1)
        rows = [(symbol, d0 + dt.timedelta(days=i), float(p)) for i, p in enumerate(prices)]
        return spark.createDataFrame(rows, "symbol string, trade_date date, close_price double")

    return make
