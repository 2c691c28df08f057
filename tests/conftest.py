import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vdjlake.session import build_session, ship

    session = build_session("tests", 4, 4)
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A DataFrame of tuples, in three partitions."""

    def make(data, schema):
        return spark.createDataFrame(data, schema).repartition(3) if data else spark.createDataFrame([], schema)

    return make


@pytest.fixture
def folder():
    with tempfile.TemporaryDirectory() as path:
        yield path
