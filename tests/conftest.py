import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

from table_dirs import SF_SMALL


@pytest.fixture(scope="session")
def spark():
    from siltworks.session import build_session

    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    from siltworks.config import PrepConfig

    return PrepConfig()


@pytest.fixture(scope="session")
def small(spark):
    """The contact table of the smallest scale, as text."""
    from siltworks.plans.registry import contacts

    return contacts(spark, SF_SMALL)
