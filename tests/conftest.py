from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from foretell.schemas import PREDICTION, WEATHER  # noqa: E402
from foretell.sources.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def predictions(spark):
    """Build predictions from partial dicts."""

    def build(*rows: dict):
        base = {
            "condition_id": "m1",
            "question": "Will it rain in London on May 20?",
            "location_name": "London",
            "market_type": "RAIN",
            "market_status": "open",
            "price": 0.65,
            "winner": None,
            "closed": False,
            "end_date": date(2026, 5, 20),
            "poll_ts": datetime(2026, 5, 19, 12),
            "volume": 100.0,
            "threshold": None,
        }
        return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], PREDICTION)

    return build


@pytest.fixture(scope="session")
def weather(spark):
    def build(*rows: dict):
        base = {
            "obs_id": 1,
            "location_name": "London",
            "weather_type": "current",
            "observation_date": date(2026, 5, 20),
            "poll_ts": datetime(2026, 5, 20, 9),
            "temp_c": 14.5,
            "temp_f": 58.1,
            "precip_mm": 2.5,
            "rain_mm": 2.5,
            "weather_code": 61,
            "wind_kmh": 18.0,
        }
        return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], WEATHER)

    return build


def column(df, expression):
    """One value of a one-row frame."""
    return df.select(expression.alias("x")).first()["x"]


@pytest.fixture(scope="session")
def one(spark):
    frame = spark.range(1)
    return lambda expression: column(frame, expression)
