import pytest
from compare import connect, difference

import __spark_entry__ as entry_module
from pigeonhole.plans.oracles import ORACLES
from pigeonhole.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Queries that find nothing in so few rows.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    found = difference(spark, con, name, SF_DIR)
    assert found is None or (name in MAY_BE_EMPTY and found == "no rows on either side"), found


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert sum(r["items"] for r in rows) == 1500
