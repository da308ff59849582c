import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scoremill.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    session = build_session("tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("provided tables are missing")
    return DATA


@pytest.fixture
def values(spark):
    """Long values ``(feature, value)`` from plain numbers."""

    def make(numbers, feature="x"):
        rows = [(feature, None if n is None else float(n)) for n in numbers]
        return spark.createDataFrame(rows, "feature string, value double")

    return make
