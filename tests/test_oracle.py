"""Every registered query against its DuckDB oracle (the driver's gate)."""

import pytest

import __spark_entry__ as entry
import oracle_compare as oc
from fieldload import oracle
from fieldload import queries as library

SF = "/root/testdata/sf0.001"
QUERIES = library.QUERIES
SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return oc.duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    n, problems = oc.compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(SQL))
def test_column_types_match(spark, con, name):
    assert oc.type_mismatches(spark, con, name, QUERIES[name], SQL[name], SF) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == QUERIES[entry.FLAGSHIP](spark, SF).columns
