"""The order book is built once per session into the session's checkpoint folder."""

import os
import shutil

from orderflow.params import DEFAULT
from orderflow.session import shared_dir
from orderflow.sources import store


def test_shared_dir_is_the_configured_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and shared_dir(spark) == configured.rstrip("/")


def test_build_once_and_reuse(spark, sf_dir):
    first = store.build(spark, sf_dir)
    assert store.build(spark, sf_dir) is first
    root = os.path.join(shared_dir(spark), "orderbook", store.fingerprint(spark, sf_dir, first.params))
    run = store.published(spark, root).removeprefix("file:")
    for name, _ in store.STAGES:
        assert os.path.isdir(os.path.join(run, name)), name
    # every public table is read back from its written files
    assert "orderbook" in first.invoices.inputFiles()[0]


def test_a_changed_file_in_a_subfolder_changes_the_fingerprint(spark, sf_dir, tmp_path):
    for name in store.SOURCES:
        part = tmp_path / f"{name}.parquet" / "day=1"
        part.mkdir(parents=True)
        shutil.copy(f"{sf_dir}/{name}.parquet", part / "a.parquet")
    before = store.fingerprint(spark, str(tmp_path), DEFAULT)
    assert store.fingerprint(spark, str(tmp_path), DEFAULT) == before
    shutil.copy(f"{sf_dir}/orders.parquet", tmp_path / "orders.parquet" / "day=1" / "b.parquet")
    assert store.fingerprint(spark, str(tmp_path), DEFAULT) != before


def test_an_unpublished_build_is_not_read(spark, tmp_path):
    (tmp_path / "run-a").mkdir()
    assert store.published(spark, str(tmp_path)) is None
    spark.range(1).selectExpr("cast(id as string) v").write.text(str(tmp_path / "run-b" / "_published"))
    assert store.published(spark, str(tmp_path)).endswith("run-b")


def test_joins_on_the_order_need_no_shuffle(spark, book, capsys):
    """Fact tables are bucketed by order: the view, shipments and their check join in place."""
    from orderflow.operators import checks, constraints, delivery
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        x = checks.Inputs(book, DEFAULT, {"over_shipped"})
        keys = ["order_id", "line_no"]
        for df in (delivery.otif(book), delivery.line_shipments(book), checks._shipped(x)[0],
                   constraints.with_parents(book, book.dispatches.select(*keys), [(["order_id"], "orders", ["order_id"]),
                                                                                 (keys, "order_lines", keys)])):
            capsys.readouterr()
            df.explain()
            plan = capsys.readouterr().out
            assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
            assert "hashpartitioning(order_id" not in plan and "hashpartitioning(_fk" not in plan, plan
    finally:
        spark.conf.set(key, was)


def test_bucket_count_follows_the_lines(spark, sf_dir, monkeypatch):
    assert store.bucket_count(spark, sf_dir) == store.LEAST_BUCKETS
    monkeypatch.setattr(store, "BUCKET_BYTES", 1000)
    n = store.bucket_count(spark, sf_dir)
    size = os.path.getsize(f"{sf_dir}/lineitem.parquet")
    assert n & (n - 1) == 0 and n * 1000 >= size > n * 500


def test_a_published_build_is_read_with_its_buckets(spark, sf_dir, tmp_path, monkeypatch):
    """Another application finds the files and makes their buckets known again."""
    monkeypatch.setattr(store, "shared_dir", lambda s: str(tmp_path))
    monkeypatch.setattr(store, "_BUILT", {})
    first = store.build(spark, sf_dir)
    lines = first.order_lines.count()
    for t in [t.name for t in spark.catalog.listTables() if t.name.startswith("orderbook_")]:
        if str(tmp_path) in spark.table(t).inputFiles()[0]:
            spark.sql(f"DROP TABLE {t}")
    monkeypatch.setattr(store, "_BUILT", {})
    again = store.build(spark, sf_dir)
    assert again is not first and again.order_lines.count() == lines
    assert f"{tmp_path}/orderbook" in again.order_lines.inputFiles()[0]
