"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tallyloom import catalog
from tools import check


@pytest.fixture(scope="module")
def con(folder):
    return check.connect(folder)


@pytest.mark.parametrize("key", list(catalog.queries()))
def test_query_agrees_with_sql(spark, con, folder, key):
    assert check.differences(spark, con, folder, key) == []


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracles())


def test_entry_has_the_schema_of_the_report(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["feature_value", "brand"] and "Total Impressions" in df.columns
    assert df.count() > 0
