"""The derived order book is identical in Spark and in the DuckDB twin."""

import pytest

from orderflow.plans.compare import compare
from orderflow.plans.oracle_tables import TABLE_CTES, with_tables
from orderflow.sources.adapter import SCHEMA, OrderBook, build


@pytest.mark.parametrize("table", OrderBook.TABLES)
def test_table_matches_duckdb(spark, sf_dir, con, table):
    df = build(spark, sf_dir)[table]
    assert df.columns == SCHEMA[table]
    r = compare(df, con, with_tables(f"SELECT * FROM {TABLE_CTES[table]}"))
    assert r["values_match"], r


def test_stored_book_equals_derived(spark, sf_dir, book):
    derived = build(spark, sf_dir)
    for t in ("orders", "invoices", "raw_quote_register"):
        assert sorted(map(tuple, book[t].collect()), key=str) == \
            sorted(map(tuple, derived[t].collect()), key=str)


def test_line_numbers_are_unique(book):
    from pyspark.sql import functions as F
    dup = book.order_lines.groupBy("order_id", "line_no").count().filter(F.col("count") > 1)
    assert dup.count() == 0
