"""Every registered query against its SQL, at the scale named in TEST_SF."""

import os

import pytest

import oracle_check

SF = oracle_check.DATA / os.environ.get("TEST_SF", "sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_check.driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert oracle_check.compare(spark, con, name, SF) == []


@pytest.mark.parametrize("name", sorted(set(oracle_check.driver.queries()) - set(oracle_check.driver.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert oracle_check.driver.queries()[name](spark, str(SF)).collect()


def test_every_sql_belongs_to_a_query():
    assert set(oracle_check.driver.oracle_sql()) <= set(oracle_check.driver.queries())


def test_entry(spark):
    assert oracle_check.driver.entry(spark).count() > 0
