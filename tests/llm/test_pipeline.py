"""The corpus pipeline's stages, each held against its own input."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from orderflow.llm import quality

from .test_duplicates import brute_classes
from .test_scans import base_personal


def test_stage_order_and_names():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "MinHash near-dedup", "PII",
                                        "mixing sources to target weights", "packing"]


def test_stages(spark, sf_dir, documents, tmp_path):
    docs, seen = documents, []
    for name, stage in P.STAGES:
        out = os.path.join(tmp_path, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(out)
        new = spark.read.parquet(out)
        seen.append((docs, new))
        if name != "packing":
            assert new.columns == documents.columns
        docs = new
    good = {r.doc_id for r in quality.classify(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            .where("predicted = 1").collect()}
    assert {r.doc_id for r in seen[0][1].collect()} == good
    rows = [(r.doc_id, r.text) for r in seen[1][0].collect()]
    assert seen[1][1].count() == sum(brute_classes(rows).values())
    assert not any(base_personal(r.text) for r in seen[2][1].collect())
    packed = seen[4][1]
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in seen[3][1].collect()}


def test_the_pipeline_is_registered():
    import __spark_entry__ as E
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()


def test_pipeline_of_nothing(spark, sf_dir, nothing):
    docs = nothing
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


@pytest.mark.parametrize("k", range(5))
def test_each_stage_takes_awkward_rows(spark, sf_dir, awkward, k):
    out = P.STAGES[k][1](spark, awkward, sf_dir)
    if k < 4:
        assert out.columns == awkward.columns
    assert out.count() > 0


def test_run_packs_what_the_stages_keep(spark, sf_dir, documents):
    """All stages in one go: sequences without gaps, of documents that the table holds."""
    pieces = P.run(spark, sf_dir).collect()
    assert {r.doc_id for r in pieces} <= {r.doc_id for r in documents.select("doc_id").collect()}
    ends = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0) and r.length > 0
        ends[r.sequence_id] = r.offset + r.length
    assert ends and max(ends.values()) <= 4096


def test_near_dedup_carries_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", "k", "x"), (2, "a b c d e f", "k", "y"), (3, "other words", "k", "z"), (None, None, "k", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __text_key string, key string").withColumn("id", F.lit(7))
    out = P.minhash_near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r["__text_key"], r.key) for r in out.collect()) == [(0, "k", "n"), (1, "k", "x"), (3, "k", "z")]
