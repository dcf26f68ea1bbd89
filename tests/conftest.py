from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from star_data import HAND_ROWS  # noqa: E402
from starmart.schema import TRIPS_COORD  # noqa: E402
from starmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="starmart-tests")
    yield s


@pytest.fixture(scope="session")
def hand(spark):
    return spark.createDataFrame(HAND_ROWS, TRIPS_COORD)
