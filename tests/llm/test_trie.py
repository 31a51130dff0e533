"""Operator 13."""

import hashlib
import random
import zlib

import pytest

from orderflow.llm import queries, trie
from orderflow.plans.compare import compare


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, role.encode(),
                                            hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(r[2].decode(), r[4]) for r in sorted(t)] for c, t in convs.items()}
    seqs = {}
    for c, t in own.items():
        base = c - int(abs(c) % 100) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = tuple(own.get(base, [])[:h] + t[h:])
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children, below = {}, {}
    for p in nodes:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in nodes.items():
        saves = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            n, s = below.get(p[:d], (0, 0))
            below[p[:d]] = (n + (p not in children), s + saves)
    out = []
    for p, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children.get(p, 0), *below[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                    r.ends_sha256) for r in df.collect()), key=str)


def talks():
    rng = random.Random(8)
    texts = ["hi", "Hällo \U0001f600", "", None, "same", "x" * 30]
    rows = []
    for c in [*range(0, 60), 100, 105, 107, 199, 250, 251, -3, -100, -150, 10**12 + 7, *range(300, 330)]:
        n = rng.choice([1, 2, 3, 4, 5, 6, 9, 17])
        style = rng.randrange(4)
        for t in range(n):
            text = rng.choice(texts) if style == 0 else texts[t % 6] if style == 1 else "same"
            rows.append((c, t * 3 - 4, ("user", "assistant", None)[t % 2 if style else rng.randrange(3)], text))
    rows += [(400, t, "user", f"turn {t // 7}") for t in range(150)] + [(401, t, "user", f"turn {t // 7}") for t in range(150)]
    rows += [(402, t, "user", "same") for t in range(40)] + [(403, t, "user", "same") for t in range(39)]
    rows += [(5, None, "user", "first"), (5, None, None, "first"), (7, 1, "user", "tie b"), (7, 1, "user", "tie a"),
             (7, 1, "user", "tie a"), (None, 1, "user", "nobody's"), (300, 2, "user", "same")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def spoken(spark):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in talks()],
                                 "conv_id long, turn long, role string, text string, depth int, x int, c int").repartition(6)


@pytest.mark.parametrize("block,chunk,ids", [(8, 4096, 1 << 16), (1, 4096, 2), (3, 2, 1), (4, 5, 3)])
def test_equals_brute_force(spoken, block, chunk, ids):
    """Also with small blocks, and keys that go on over many chunks of each kind."""
    assert rows_of(trie.prefix_trie(spoken, block, chunk, ids)) == brute(talks())


def test_turns_are_numbered_over_partitions(spark):
    rows = [(c, t, "u", str(t)) for c, n in ((1, 3), (2, 500), (3, 1)) for t in range(n)]
    random.Random(2).shuffle(rows)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
        got = sorted((r.c, r.pos) for r in trie.numbered(df).collect())
    finally:
        spark.conf.set(key, was)
    assert got == [(c, t + 1) for c, n in ((1, 3), (2, 500), (3, 1)) for t in range(n)]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(none).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x")], none.schema)
    assert trie.prefix_trie(nobody).count() == 0


def test_equals_sql(spark, sf_dir, con):
    r = compare(queries.QUERIES["op13_conversation_trie"](spark, sf_dir), con, trie.ORACLE)
    assert r["columns_match"] and r["values_match"], r
