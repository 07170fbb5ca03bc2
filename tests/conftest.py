import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ratingloom.workspace import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """A DataFrame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def small_data():
    return "/root/testdata/sf0.001"


def rows_of(table, *order):
    """The rows as tuples, sorted."""
    rows = [tuple(r) for r in table.collect()]
    return sorted(rows, key=repr)
