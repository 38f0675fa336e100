"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry
import compare
from kerbside.plans.catalogue import QUERIES as CATALOGUE

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(CATALOGUE) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(CATALOGUE))
def test_query(spark, duck, sf_dir, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
