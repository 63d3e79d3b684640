import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stridewise.config import CORE_SCHEMA, CleaningConfig  # noqa: E402
from stridewise.session import local_session  # noqa: E402

FIXTURES = os.path.join(ROOT, "tests", "fixtures")

DEFAULTS = {
    "date": datetime(2025, 8, 1, 7, 0),
    "activity_type": "Running",
    "distance_km": 5.0,
    "duration_sec": 1800.0,
    "calories": 400.0,
    "avg_heart_rate": 150.0,
    "max_heart_rate": 170.0,
    "source": "garmin",
    "export_date": datetime(2025, 8, 22),
}


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="stridewise-tests")
    yield s


@pytest.fixture(scope="session")
def garmin_glob():
    return os.path.join(FIXTURES, "garmin", "*", "Activities.csv")


@pytest.fixture(scope="session")
def apple_glob():
    return os.path.join(FIXTURES, "apple", "*", "Export.xml")


@pytest.fixture
def config():
    return CleaningConfig()


@pytest.fixture
def make_runs(spark):
    """Rows in the core schema: lists give per-row values, scalars repeat, defaults fill the rest."""

    def make(n: int | None = None, **cols):
        unknown = set(cols) - set(DEFAULTS)
        if unknown:
            raise KeyError(unknown)
        lengths = [len(v) for v in cols.values() if isinstance(v, list)]
        rows = n or (max(lengths) if lengths else 1)
        data = []
        for i in range(rows):
            row = []
            for c in DEFAULTS:
                v = cols.get(c, DEFAULTS[c])
                v = v[i] if isinstance(v, list) else v
                if isinstance(v, float) and v != v:
                    v = None
                row.append(v)
            data.append(tuple(row))
        return spark.createDataFrame(data, CORE_SCHEMA)

    return make
