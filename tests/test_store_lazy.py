"""A query waits for the stages below its own tables only, and each is shuffled once."""

import os

from orderflow.operators import checks
from orderflow.params import DEFAULT
from orderflow.plans import catalog
from orderflow.sources import adapter, store


def _fresh(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "shared_dir", lambda s: str(tmp_path))
    monkeypatch.setattr(store, "_BUILT", {})
    return lambda: {d for _, ds, _ in os.walk(tmp_path) for d in ds if d in dict(store.STAGES)}


def test_a_query_writes_only_the_stages_it_needs(spark, sf_dir, tmp_path, monkeypatch):
    written = _fresh(spark, sf_dir, tmp_path, monkeypatch)
    catalog.spark_queries()["c10_job_numbers_unique_and_banded"](spark, sf_dir).collect()
    assert written() == {"_order_base", "customers"}
    catalog.spark_queries()["r_quote_no"](spark, sf_dir).collect()
    assert written() == {"_order_base", "customers", "_lines", "payment_terms", "raw_quote_register"}
    # another application reads what is there
    monkeypatch.setattr(store, "_BUILT", {})
    monkeypatch.setattr(store, "_write", None)
    assert catalog._tables(spark, sf_dir).orders.count() > 0


def test_lines_are_shuffled_once_and_a_bucket_is_one_file(spark, sf_dir, tmp_path, monkeypatch):
    _fresh(spark, sf_dir, tmp_path, monkeypatch)
    book = store.opened(spark, sf_dir)
    plan = adapter.OrderBook._lines.func(book)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "hashpartitioning(l_orderkey" in plan
    files = [f for f in book._lines.inputFiles() if f.endswith(".parquet")]
    assert len(files) <= book.buckets


def test_invoices_need_no_shuffle(spark, sf_dir):
    plan = catalog._tables(spark, sf_dir).invoices._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_ids_are_formatted_as_before(spark):
    from pyspark.sql import functions as F
    df = spark.sql("SELECT explode(array(null, -12, 0, 7, 999999, 1000000, 9999999, 10000000, 123456789012)) k")
    same = df.select(F.format_string("C%06d", "k") == adapter.customer_id(F.col("k")),
                     F.format_string("I%07d", "k") == adapter.item_id(F.col("k"))).collect()
    assert all(a and b for a, b in same)


def test_sources_declare_their_metrics(book):
    asked = {m for k in checks.checks(DEFAULT).values() for m in k.metrics}
    x = checks.Inputs(book, DEFAULT, asked)
    for source, names in checks._SOURCES:
        given = {"rows_line_*" if k.startswith("rows_line_") else k for k in source(x)[1]}
        assert given <= names(), source.__name__
