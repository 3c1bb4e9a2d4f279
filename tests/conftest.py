from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sparksignal.session import get_spark

    s = get_spark("sparksignal-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def sample_prices(spark):
    """Ten days of 2024-01: open 70+i, high 72+i, low 69+i, close 71+i, volume 1000*i."""
    rows = [(dt.date(2024, 1, i), 70.0 + i, 72.0 + i, 69.0 + i, 71.0 + i, 1000 * i)
            for i in range(1, 11)]
    return spark.createDataFrame(
        rows, "date date, open double, high double, low double, close double, volume bigint")
