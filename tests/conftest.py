import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cubes import WEATHER, WEATHER_AXES, cells_of, weather_arrays  # noqa: E402

from gridloom.session import local_session, ship  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = ship(local_session(4, shuffle_partitions=4, app="tests"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def weather(spark):
    return cells_of(spark, weather_arrays(), {v.name: v.axis for v in WEATHER}, WEATHER_AXES)
