"""Every query with a SQL check, on the sf0.01 tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check import compare, connect

SF = "/root/testdata/sf0.01"
# thousands of columns: run by tests.run_checks, too slow for every test run
SLOW = {"credit_final_table", "credit_cross_ratios", "credit_bureau_compat"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - SLOW))
def test_matches_sql(spark, duck, name):
    assert compare(queries()[name](spark, SF), duck, oracle_sql()[name]) == []


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 150
