"""Operators 1 and 3."""

import re
import zlib
from collections import Counter

import pytest

from orderflow.llm import quality, repetition

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    w = re.findall(WORD, text or "")
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cov = set()
    for i in range(len(w) - 2):
        if c[tuple(w[i:i + 3])] > 1:
            cov |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cov),
            len(w) < 50 or 100 * len(cov) > 50 * len(w))


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_repetition_measures_equal_brute_force(request, name):
    docs = request.getfixturevalue(name)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                   r.base_failed) for r in repetition.repetition_rules(docs).collect())
    assert got == Counter((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect())


def test_repetition_verdict(spark):
    from .conftest import prose
    clean, part = prose(11, 200), prose(12, 30)
    rows = [(1, clean), (2, clean + " " + (part + " ") * 12), (3, (prose(13, 12) + "\n") * 20),
            (4, clean + "\n" + prose(14, 10) + "\n" + prose(14, 10))]
    got = {r.doc_id: r.kept for r in repetition.repetition_rules(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}


def test_coverage_decides_past_the_base(spark):
    """Texts that pass the base rule fail by n-grams or lines; clean ones are kept."""
    from .conftest import prose
    clean, block = prose(21, 200), prose(22, 24)
    lines = "\n".join(prose(30 + k, 4).replace("\n", " ") for k in range(50))
    again = "\n".join([prose(90, 4)] * 18)
    rows = [(1, clean), (2, f"{clean} {block} {prose(23, 9)} {block}"), (3, f"{lines}\n{again}"),
            (4, f"{clean}\n{prose(24, 7)}\n{prose(25, 9)}\n{prose(24, 7)}")]
    got = {r.doc_id: r for r in repetition.repetition_rules(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(r.base_failed for r in got.values())
    assert 0.1 < got[2].dup_10gram_share < 0.4 and 0.2 < got[3].dup_line_share < 0.4
    assert {k: r.kept for k, r in got.items()} == {1: True, 2: False, 3: False, 4: True}


def test_repetition_empty(nothing):
    assert repetition.repetition_rules(nothing).count() == 0


def test_classifier_held_out_accuracy(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = {r.doc_id: r for r in quality.classify(documents, labels).collect()}
    assert len(got) == documents.count()
    right = []
    for r in labels.collect():
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5)
        if g.held_out:
            right.append(g.predicted == r.quality)
    assert sum(right) >= 0.9 * len(right)


def test_classifier_ignores_held_out_labels(spark, sf_dir, documents):
    from orderflow.llm.common import crc_mod
    from pyspark.sql import functions as F
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    other = labels.withColumn("quality", F.when(crc_mod("doc_id", 3) == 1, 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    a, b = (sorted(quality.classify(documents, x).select("doc_id", "score").collect()) for x in (labels, other))
    assert a == b


def test_classifier_awkward(spark, awkward, nothing, sf_dir):
    labels = spark.createDataFrame([(1, 1), (2, None), (6, 0), (6, 1), (None, 1), (8, 7), (777, 0)],
                                   "doc_id long, quality int")
    assert quality.classify(awkward, labels).count() == awkward.count()
    none = quality.classify(awkward, labels.where("false")).collect()
    assert all(r.score == 0.5 and r.predicted == 1 for r in none)
    assert quality.classify(nothing, labels).count() == 0
    assert quality.keep_good(awkward, labels.where("false")).columns == awkward.columns
