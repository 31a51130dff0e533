"""What a Python worker holds at once is bounded by its piece, not by its batch or group."""

import tracemalloc

import numpy as np
import pyarrow as pa

from orderflow.llm import near_dedup, passages, quality
from orderflow.llm import textops as T


class Rows:
    """Stands for a table: the function is run on the batch at hand."""

    def __init__(self, batch):
        self.batch = batch

    def mapInArrow(self, run, _schema):
        tracemalloc.start()
        try:
            got = [r for out in run(iter([self.batch])) for r in out.to_pylist()]
            return got, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()


def words(rng, n):
    return " ".join(f"w{k:x}" for k in rng.integers(0, 2**40, n))


def test_pair_pieces_count_both_sides():
    a, b = ["x" * n for n in (10, 0, 3000, 5, 5, 5)], ["y" * 400, None, "", "y" * 600, "y" * 5, "é" * 5]
    batch = pa.RecordBatch.from_pydict({"a": a, "b": b}).slice(1)
    parts = list(T.pair_pieces(batch, ["a", "b"], 700))
    assert [p.num_rows for p in parts] == [1, 1, 3] and pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert not list(T.pair_pieces(batch.slice(0, 0), ["a", "b"]))


def test_short_texts_beside_a_long_leader():
    rng = np.random.default_rng(1)
    line, lead = words(rng, 70), words(rng, 6000)
    places = pa.list_(pa.struct([("sig", pa.int64()), ("place", pa.int64()), ("lead_place", pa.int64())]))
    rows = [{"a": b"a%d" % k, "b": b"b", "at": [{"sig": 1, "place": 0, "lead_place": 6000}], "ta": line,
             "tb": lead + " " + line} for k in range(200)]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema(
        [("a", pa.binary()), ("b", pa.binary()), ("at", places), ("ta", pa.string()), ("tb", pa.string())]))
    got, peak = passages._verify(Rows(batch))
    assert len(got) == 200 and {(r["start"], r["end"], r["b_start"]) for r in got} == {(0, 70, 6000)}
    assert peak < 32 << 20  # 55 MB: the leader's shingles once for every text of 2 MB


def test_similar_pairs_with_long_sides():
    rng = np.random.default_rng(2)
    long, short = words(rng, 6000), words(rng, 60)
    rows = [{"a": b"%d" % k, "b": b"z", "ta": short if k % 2 else long, "tb": long} for k in range(120)]
    got, peak = near_dedup._similar(Rows(pa.RecordBatch.from_pylist(rows)))
    assert [r["a"] for r in got] == [b"%d" % k for k in range(0, 120, 2)]
    assert peak < 32 << 20


def test_members_of_a_group_go_out_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, (6, 2), dtype=np.uint64)
    table = []
    for part in (keys[:4], keys[2:]):  # two texts stand in both blocks
        sig = np.sort(rng.integers(0, 40, 60).astype(np.uint64))
        text, place = rng.integers(0, 4, 60), rng.integers(0, 9, 60)
        table.append((sig, part, text, place, np.zeros(60, bool)))
    table[0][4][:] = table[0][0] == 7
    batches = [pa.RecordBatch.from_pydict({"g": pa.array([0], pa.int32()), "block": pa.array([passages._block(*t)])})
               for t in table]
    monkeypatch.setattr(passages, "ROWS_OUT", 16)
    out = list(passages._members(1)(iter(batches)))
    assert len(out) > 2 and max(b.num_rows for b in out) <= 16
    rows = [(int(s), bytes(part[t].tobytes()), int(p)) for sig, part, text, place, _ in table
            for s, t, p in zip(sig, text, place)]
    texts = {s: {k for q, k, _ in rows if q == s} for s, _, _ in rows}
    want = sorted(r for r in rows if len(texts[r[0]]) > 1 or r[0] == 7 and 7 in table[0][0])
    assert sorted((r["sig"], r["key"], r["place"]) for b in out for r in b.to_pylist()) == want


def test_features_of_a_full_batch():
    rng = np.random.default_rng(4)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "label": [1] * 400,
                                        "text": [words(rng, 400) for _ in range(400)]})
    tracemalloc.start()
    n = sum(b.num_rows for b in quality._vectors(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 400 and peak < 32 << 20
