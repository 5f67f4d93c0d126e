"""Every registered query against its SQL statement."""

import pytest

from __spark_entry__ import entry
from playstar.oracle import oracle_statements
from playstar.registry import QUERIES
from tests.compare import differences, open_tables

ORACLES = oracle_statements()


@pytest.fixture(scope="module")
def tables(sf_dir):
    with open_tables(sf_dir) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, tables, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, tables, ORACLES[name]) == ""


def test_entry(spark):
    rows = entry(spark).collect()
    assert {row.is_weekday for row in rows} == {"Weekday", "Weekend"}
