"""The checks leave little on disk: their sources run one by one and free their shuffles."""

import os
import time

from orderflow.operators import checks
from orderflow.params import DEFAULT
from orderflow.sources import store


def test_sources_run_one_by_one_and_free_their_shuffles(spark, book, monkeypatch):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffles():
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    for name, cluster in store.STAGES:  # written before, as far as they are asked for
        book.stage(name, cluster)
    before, seen, real = shuffles(), [], checks.staged

    def staged(df, name):
        out = real(df, name)
        for _ in range(100):
            left = shuffles() - before
            if not left:
                break
            time.sleep(0.1)
        seen.append((name, sorted(left)[:3]))
        return out

    monkeypatch.setattr(checks, "staged", staged)
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert checks.run_checks(book, DEFAULT).count() == len(checks.CHECK_NAMES)
    finally:
        spark.conf.set(key, was)
    assert [n for n, _ in seen].count("check-source") == len(checks._SOURCES)
    assert not [s for s in seen if s[1]]


def test_invoices_and_dispatches_are_dealt_once(spark, book):
    """By dispatch alone: the price of a line joins where it lies."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        x = checks.Inputs(book, DEFAULT, {"invoice_off", "invoice_other_day"})
        base, metrics = checks._invoice_dispatch(x)
        plan = base.agg(*[v.alias(k) for k, v in metrics.items()])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, was)
    assert plan.count("Exchange hashpartitioning(dispatch_id") == 2
    assert "hashpartitioning(order_id" not in plan


def test_stages_are_packed_tightly(book):
    assert all(f.endswith(".zstd.parquet") for f in book._lines.inputFiles() if f.endswith(".parquet"))
