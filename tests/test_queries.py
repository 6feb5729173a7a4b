"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry
from rowsmith.queries import all_oracles, all_queries


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, small, con, name):
    assert differences(all_queries()[name](spark, small), con, all_oracles()[name]) == []


def test_entry_has_a_stable_schema(spark):
    df = entry(spark)
    assert df.count() == 3
    assert df.columns[0] == "dataset_name"
