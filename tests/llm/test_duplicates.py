"""Operators 6 and 7, and connected components."""

import re
from collections import Counter, defaultdict

import pytest

from orderflow.llm import near_dedup, passages
from orderflow.llm.graph import components

WORD = r"[^\x20\x09-\x0D]+"


def shingles(text):
    w = re.findall(WORD, text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = sum((sets[i] & sets[j]).values())
            either = sum((sets[i] | sets[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or (either and both >= 0.8 * either):
                root[find(i)] = find(j)
    out = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        out[find(i)].append(d)
    return Counter(tuple(sorted(v, key=str)) for v in out.values())


def got_classes(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.class_id].append(r.doc_id)
    return Counter(tuple(sorted(v, key=str)) for v in out.values())


@pytest.mark.parametrize("name", ["documents", "near_copies"])
def test_near_duplicates_equal_brute_force(request, name):
    docs = request.getfixturevalue(name)
    rows = near_dedup.near_duplicates(docs).collect()
    assert got_classes(rows) == brute_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(r.kept for r in rows) == len({r.class_id for r in rows})
    size = Counter(r.class_id for r in rows)
    assert all(r.class_size == size[r.class_id] for r in rows)


@pytest.fixture(scope="module")
def near_copies(spark):
    """A third of the rows copies of one text, chains of near copies, and a
    passage that many texts share."""
    from .conftest import prose
    base, rows = prose(100, 150), []
    common = prose(101, 60)
    for k in range(30):
        rows.append((k, base))
    words = base.split()
    for k in range(30, 50):  # every text has one more word changed: ends of the chain differ a lot
        words[(k - 30) * 7] = f"x{k}"
        rows.append((k, " ".join(words)))
    for k in range(50, 90):
        rows.append((k, prose(k, 100) + " " + common + " " + prose(k + 500, 80)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_keep_one(awkward, nothing, near_copies):
    kept = near_dedup.keep_one(awkward)
    assert kept.columns == awkward.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts))
    assert near_dedup.keep_one(nothing).count() == 0 and near_dedup.near_duplicates(nothing).count() == 0
    assert near_dedup.near_duplicates(awkward).count() == awkward.count()
    assert near_dedup.keep_one(near_copies).count() == sum(
        brute_classes([(r.doc_id, r.text) for r in near_copies.collect()]).values())


def test_signature_is_weighted_jaccard():
    import numpy as np
    import pyarrow as pa
    from orderflow.llm import textops as T
    a = [f"w{i}" for i in range(400)]
    b = a[:300] + [f"v{i}" for i in range(100)]
    (_, data, off), = T.pieces(pa.RecordBatch.from_pydict({"text": [" ".join(a), " ".join(b)]}), "text")
    unit, begin = near_dedup.units(data, off)
    sig = near_dedup.signatures(unit, begin)
    true = 296 / (2 * 396 - 296)
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / near_dedup.K)


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", ["documents", "near_copies"])
def test_passages_cover_all_exact_repeats(request, name):
    docs = request.getfixturevalue(name)
    rows = passages.repeated_passages(docs).collect()
    words = {r.doc_id: re.findall(WORD, r.text or "") for r in docs.collect()}
    windows = defaultdict(set)
    for d, w in words.items():
        for k in range(len(w) - 49):
            windows[tuple(w[k:k + 50])].add(d)
    root = {d: d for d in words}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    for r in rows:
        a, b = words[r.doc_id][r.start_word:r.end_word], words[r.with_doc_id][r.with_start:r.with_end]
        x, y = (Counter(tuple(t[i:i + 5]) for i in range(len(t) - 4)) for t in (a, b))
        assert min(len(a), len(b)) >= 50
        assert sum((x & y).values()) >= 0.8 * sum((x | y).values())
        root[max(find(r.doc_id), find(r.with_doc_id))] = min(find(r.doc_id), find(r.with_doc_id))
    for group in windows.values():
        assert len({find(d) for d in group}) == 1


def test_passages_awkward(awkward, nothing, spark):
    assert passages.repeated_passages(nothing).count() == 0
    got = {r.doc_id for r in passages.repeated_passages(awkward).collect()}
    assert {1, 2} <= got and not got & {3, 4, 5, 6, 8, 20}


def test_a_common_line_hides_no_passage(spark):
    from .conftest import prose
    line = prose(900, 20)
    rows = [(k, prose(k, 80) + " " + line + " " + prose(k + 300, 80)) for k in range(200)]
    long = prose(901, 16) + " " + line + " " + prose(902, 16)
    rows += [(1000 + k, prose(1000 + k, 60) + " " + long + " " + prose(2000 + k, 60)) for k in range(2)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {1000, 1001}
