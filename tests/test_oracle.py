"""Every registered query equals its DuckDB twin (names, rows, values)."""

import pytest

from orderflow.plans.catalog import oracle_sql, spark_queries
from orderflow.plans.compare import compare

SQL = oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = spark_queries()[name](spark, sf_dir)
    r = compare(df, con, SQL[name])
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["values_match"], r


@pytest.mark.parametrize("name", sorted(set(spark_queries()) - set(SQL)))
def test_query_without_oracle_runs(spark, sf_dir, name):
    df = spark_queries()[name](spark, sf_dir)
    assert df.count() >= 0


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
