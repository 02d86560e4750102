"""Every registered query against its SQL on the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from revtide.plans.queries import QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert difference(got, want) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
