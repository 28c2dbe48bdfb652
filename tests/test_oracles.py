"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as driver
from table_dirs import SF_SMALL
from oracle_compare import compare, connect
from siltworks.plans.oracles import ORACLES
from siltworks.plans.registry import QUERIES

ROWS_ONLY = {"source_inventory", "dir_bytes"}  # paths and sizes


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


def test_only_file_facts_and_the_report_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_SMALL), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 1500
