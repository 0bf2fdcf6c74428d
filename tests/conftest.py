import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def frame(spark):
    """frame('a string, b double', (1, 2), ...) -> DataFrame"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def rows(df, *order):
    got = df.orderBy(*order).collect() if order else df.collect()
    return [tuple(r) for r in got]
