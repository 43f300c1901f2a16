"""Every registered query against its SQL twin (DuckDB) on the small driver tables, the
same comparison the correctness gate makes: column names, row count, multiset of rows."""

import pytest

import __spark_entry__ as entry
from courtline.plans.registry import all_oracle_sql, all_queries
from oracle_check import compare, duck

QUERIES = all_queries()
ORACLE = all_oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_sql_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE.get(name), sf_dir, con)
    assert r["status"] == "MATCH", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns
