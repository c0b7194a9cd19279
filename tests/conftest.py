import datetime
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from flowgauge.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def swipes(spark):
    """Swipes from (time, station, line, status) tuples; times as text of one day or full."""

    def make(rows):
        def time(value):
            if value is None:
                return None
            return datetime.datetime.fromisoformat(value if len(value) > 8 else f"2024-01-01 {value}")

        schema = "time timestamp_ntz, stationID bigint, lineID string, status int"
        return spark.createDataFrame([(time(t), s, line, st) for t, s, line, st in rows], schema)

    return make


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def at(text):
    return datetime.datetime.fromisoformat(text)


def day(text):
    return datetime.date.fromisoformat(text)
