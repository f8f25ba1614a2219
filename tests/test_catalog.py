import pytest

import __spark_entry__ as entry_module
from lodgeworks.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"year", "month", "n_bookings", "cancel_rate"}


def test_registry():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(QUERIES) > 120


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, small, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], small) is None
