import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridelabel.params import MatchParams  # noqa: E402
from ridelabel.session import build_session  # noqa: E402
from ridelabel.sources.fixtures import fixture_master, fixture_waypoints  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ridelabel-tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def master(spark, sf_dir):
    """The derived timetable, kept in memory: many tests look it up."""
    return fixture_master(spark, sf_dir, MatchParams()).persisted()


@pytest.fixture(scope="session")
def waypoints(spark, sf_dir):
    return fixture_waypoints(spark, sf_dir).persist()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
