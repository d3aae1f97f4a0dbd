"""Every query with checking SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tests.oracle import connect, differences

TEXTS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_query_matches_its_sql(spark, con, name):
    problem = differences(entry.queries()[name](spark, SF).toPandas(), con.execute(TEXTS[name]).df())
    assert problem is None, problem


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 1000
