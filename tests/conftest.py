import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for path in (str(ROOT), str(ROOT / "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)

from small_data import macro_values  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from lanecast.session import local_session, ship_package

    session = local_session(8, "lanecast-tests", shuffle_partitions=4)
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def annual_rows():
    """Two corridors: a complete one, and one with a null year."""
    complete = [100.0, 110.0, 120.0, 118.0, 131.0, 140.0, 139.0, 150.0]
    gappy = [10.0, None, 0.0, 5.0, 6.0, 7.0, 9.0, 8.0]
    rows = [(1, "A_to_B", 2017 + i, t, t * 2, t * 3, *macro_values(i)) for i, t in enumerate(complete)]
    return rows + [
        (2, "B_to_A", 2017 + i, t, None if t is None else t * 4, 1.0, *macro_values(i)) for i, t in enumerate(gappy)
    ]


@pytest.fixture(scope="session")
def annual(spark, annual_rows):
    from lanecast.schemas import ANNUAL_SCHEMA

    return spark.createDataFrame(annual_rows, ANNUAL_SCHEMA)


@pytest.fixture(scope="session")
def macro_rows(spark):
    from lanecast.schemas import MACRO_ANNUAL_SCHEMA

    rows = [(2017 + i, *macro_values(i)) for i in range(8)]
    return spark.createDataFrame(rows, MACRO_ANNUAL_SCHEMA)
