"""Every registered query against its SQL."""

import pytest

from ledgerloom.queries import ORACLES, QUERIES
from tools.compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(ORACLES)
# Small data leave these without rows.
MAY_BE_EMPTY = {"agg6_income_sources"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problem = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert problem == "" or (name in MAY_BE_EMPTY and problem == "no rows")


def test_entry(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.count() > 0 and len(out.columns) == 49
    assert set(e.oracle_sql()) <= set(e.queries())
