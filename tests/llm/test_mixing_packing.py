"""Operators 5 and 9."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderflow.llm import mixing, packing, queries
from orderflow.plans.compare import compare

WORD = r"[^\x20\x09-\x0D]+"


def resharing(sizes):
    """Targets by repeated resharing, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        share = sum(w[s] for s in names if s not in stopped)
        target = {s: 3.0 * sizes[s] if s in stopped else left * w[s] / share for s in names}
        over = {s for s in names if target[s] > 3 * sizes[s] and s not in stopped}
        if not over:
            return target
        stopped |= over


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_mixture(request, spark, tmp_path, name):
    request.getfixturevalue(name).write.parquet(str(tmp_path / "docs"))  # one table, one split: rows keep their numbers
    docs = spark.read.parquet(str(tmp_path / "docs")).coalesce(1)
    rows = mixing.takes(docs).collect()
    assert len(rows) == docs.count()
    size, source_of = defaultdict(int), {}
    for r in docs.select("source", "text", F.monotonically_increasing_id().alias("id")).collect():
        size[r.source] += len(re.findall(WORD, r.text or ""))
        source_of[r.id] = r.source
    target = resharing(dict(size))
    taken = defaultdict(int)
    for r in rows:
        s = source_of[r.row]
        assert 0 <= r.taken <= 3 * r.size and r.source_size == size[s]
        assert r.target == pytest.approx(target[s])
        taken[s] += r.taken
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    again = mixing.takes(docs).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_one_doc_id_on_most_rows(spark):
    """One doc_id, or none, on most rows of a source; equal sizes and others; the cut
    goes through such groups."""
    rows = [(None if k % 4 == 0 else 7 if k % 4 == 1 else k, "w " * (k % 3 + 2 * (k % 11 == 0)), "abc"[k % 7 % 3])
            for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.takes(docs).collect()
    size, taken, n = defaultdict(int), defaultdict(int), Counter()
    for d, t, s in rows:
        size[s] += len(t.split())
    target = resharing(dict(size))
    by_target = {round(t, 6): s for s, t in target.items()}
    for r in got:
        s = by_target[round(r.target, 6)]
        n[r.doc_id, r.size, s] += 1
        assert 0 <= r.taken <= 3 * r.size and r.source_size == size[s]
        taken[s] += r.taken
    assert n == Counter((d, len(t.split()), s) for d, t, s in rows)
    assert {s: int(t) for s, t in target.items()} == dict(taken)
    assert sum(len(r.text.split()) for r in mixing.mixed(docs).collect()) == sum(taken.values())


def test_mixture_equals_sql(spark, sf_dir, con):
    r = compare(queries.QUERIES["op5_source_mixing"](spark, sf_dir), con, mixing.ORACLE)
    assert r["columns_match"] and r["values_match"], r


def test_mixed_rows_hold_the_words_taken(documents):
    take = {r.doc_id: r.taken for r in mixing.takes(documents).collect()}
    got = defaultdict(int)
    out = mixing.mixed(documents)
    assert out.columns == documents.columns
    for r in out.collect():
        got[r.doc_id] += len(re.findall(WORD, r.text))
        assert r.n_chars == len(r.text)
    assert got == {d: n for d, n in take.items() if n}


def test_mixed_reads_rows_once(spark, documents, tmp_path, monkeypatch):
    """The second scan may be split in another way than the first: ids must not
    be given twice."""
    path = str(tmp_path / "docs")
    documents.where("doc_id < 300").repartition(6).write.parquet(path)
    docs = spark.read.parquet(path)
    take = {r.doc_id: r.taken for r in mixing.takes(docs).collect()}
    write, before = mixing.written, spark.conf.get("spark.sql.files.maxPartitionBytes")

    def splits_change(df, what):
        out = write(df, what)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        return out

    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    monkeypatch.setattr(mixing, "written", splits_change)
    got = defaultdict(int)
    try:
        for r in mixing.mixed(docs).collect():
            got[r.doc_id] += len(re.findall(WORD, r.text))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert got == {d: n for d, n in take.items() if n}


def test_mixing_empty(nothing, awkward):
    assert mixing.takes(nothing).count() == 0 and mixing.mixed(nothing).count() == 0
    assert mixing.mixed(awkward).columns == awkward.columns


@pytest.mark.parametrize("name", ["awkward", "documents"])
def test_packing_holds_every_token_once(request, name):
    docs = request.getfixturevalue(name)
    rows = packing.pack(docs).collect()
    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want[(r.doc_id, len(ids))] += 1
        for p in rows:
            if p.doc_id == r.doc_id and p.doc_tokens == len(ids):
                assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32
    total = Counter()
    for p in rows:
        total[(p.doc_id, p.doc_tokens)] += p.length
    assert total == {k: k[1] * n for k, n in want.items()}
    seq = defaultdict(list)
    for p in rows:
        seq[p.sequence_id].append((p.offset, p.length))
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW


def test_packing_wastes_little(documents):
    rows = packing.pack(documents).collect()
    used = sum(r.length for r in rows)
    assert used >= 0.95 * packing.WINDOW * (len({r.sequence_id for r in rows}) - 1)


def test_packing_empty(nothing):
    assert packing.pack(nothing).count() == 0


def test_packer_is_bounded():
    p = packing.Packer(window=100, most=3)
    for k in range(500):
        p.add(k, np.arange(1 + k * 37 % 95, dtype=np.uint32))
        assert len(p.open) <= 3
