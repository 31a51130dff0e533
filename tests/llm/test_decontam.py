"""Operator 11."""

import hashlib
import re

import pytest

from orderflow.llm import decontam, queries
from orderflow.plans.compare import compare
from .conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM = "Éa b2 c, D e-f g.h I J k l m"  # 13 words
BENCH = [(1, ITEM), (2, prose(11, 25)), (2, "Two words"), (10, prose(11, 25) + " and on"), (None, "Nº İx"),
         (4, None), (5, " .,;"), (6, prose(12, 10))]


def tokens(t):
    return WORD.findall((t or "").translate(UPPER))


def brute(text, bench):
    w, hit, items = tokens(text), set(), set()
    for item, t in bench:
        g = tokens(t)
        n = min(10, len(g))
        grams = {tuple(g[i:i + n]) for i in range(len(g) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                items.add("" if item is None else str(item))
    return len(w), hit, sorted(items)


TEXTS = [ITEM, "x " + ITEM.replace(",", " !!").upper().replace("É", "É") + " y", ITEM.replace("Éa", "éa"),
         "TWO words, two  words", "two two words words", prose(11, 40) + " tail", prose(12, 9), prose(12, 10),
         "(" + prose(11, 25) + ") mid " + ITEM + " nº İX end", None, "", "...", prose(13, 3000) + " two words"]


@pytest.fixture(scope="module")
def leaked(spark):
    rows = [(k, t, "z", k) for k, t in enumerate(TEXTS)] + [(99, TEXTS[0], "z", 1)] * 2 + [(None, TEXTS[3], "z", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, n_words int").repartition(4)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(a, b, "x") for a, b in BENCH], "item_id long, text string, gram string")


def text_of(doc_id):
    return TEXTS[0] if doc_id == 99 else TEXTS[3] if doc_id is None else TEXTS[doc_id]


@pytest.mark.parametrize("part_bytes", [64 << 20, 3000])
def test_equals_brute_force(leaked, bench, monkeypatch, part_bytes):
    monkeypatch.setattr(decontam, "PART_BYTES", part_bytes)  # small: several passes
    got = decontam.contamination(leaked, bench).collect()
    assert len(got) == leaked.count()
    for r in got:
        n, hit, items = brute(text_of(r.doc_id), BENCH)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(items), bool(hit)), r
        assert r.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()


def test_removes_documents_or_spans(leaked, bench):
    clean = decontam.decontaminated(leaked, bench, "documents")
    assert clean.columns == leaked.columns
    assert sorted(r.doc_id for r in clean.collect()) == [k for k, t in enumerate(TEXTS) if not brute(t, BENCH)[1]]
    cut = decontam.decontaminated(leaked, bench, "spans").collect()
    assert len(cut) == leaked.count()
    for r in cut:
        t = text_of(r.doc_id)
        _, hit, _ = brute(t, BENCH)
        if not hit:
            assert r.text == t
            continue
        assert tokens(r.text) == [w for k, w in enumerate(tokens(t)) if k not in hit], r
        assert r.row == "z"
    by_id = {r.doc_id: r.text for r in cut}
    assert by_id[1] == "x y" and by_id[0] == "" and by_id[8] == "(mid end"
    with pytest.raises(ValueError):
        decontam.decontaminated(leaked, bench, "lines")


def test_empty_tables(leaked, bench, nothing):
    assert decontam.contamination(nothing, bench).count() == 0
    got = decontam.contamination(leaked, bench.limit(0)).collect()
    assert len(got) == leaked.count() and not any(r.contaminated or r.n_items for r in got)
    assert decontam.decontaminated(leaked, bench.limit(0)).count() == leaked.count()


def test_awkward_rows(awkward, bench):
    got = decontam.contamination(awkward, bench).collect()
    assert len(got) == awkward.count() and not any(r.contaminated for r in got)
    assert decontam.decontaminated(awkward, bench).exceptAll(awkward).count() == 0


def test_equals_sql(spark, sf_dir, con):
    r = compare(queries.QUERIES["op11_decontamination"](spark, sf_dir), con, decontam.ORACLE)
    assert r["columns_match"] and r["values_match"], r
