from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wickline.schemas import CANDLE  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wickline.session import local_session

    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="wickline-test-")


def minute(h: int, m: int, day: int = 15) -> dt.datetime:
    return dt.datetime(2025, 1, day, h, m)


def candle_rows(spec, created_at=None):
    """(symbol, datetime, value) -> CANDLE tuples; every numeric column = value."""
    rows = []
    for symbol, t, v in spec:
        rows.append(
            (
                symbol, t, float(v), float(v), float(v), float(v), float(v),
                t + dt.timedelta(seconds=59, milliseconds=999),
                float(v), int(v), float(v), float(v), "0", created_at,
            )
        )
    return rows


def candles_df(spark, spec, created_at=None):
    return spark.createDataFrame(candle_rows(spec, created_at), CANDLE)
