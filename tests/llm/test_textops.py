import re

import numpy as np
import pyarrow as pa

from orderflow.llm import textops as T

TEXTS = ["", None, "a\n\nb", "\n", "x  y\tz", "é ü\x0b\x0cß", " q ", "w " * 400, "one"]


def batch(texts):
    return pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})


def test_words_and_lines_equal_python():
    for limit in (1, 7, 1 << 20):
        words, lines = [], []
        for _, data, off in T.pieces(batch(TEXTS), "text", limit):
            s, e, first = T.words(data, off)
            assert first[-1] == len(s)
            words += [bytes(data[a:b]).decode() for a, b in zip(s, e)]
            s, e, first = T.lines(data, off)
            lines += [bytes(data[a:b]).decode() for a, b in zip(s, e)]
        assert words == [w for t in TEXTS for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        assert lines == [x for t in TEXTS for x in (t or "").split("\n")]


def test_hashes_depend_on_the_bytes_alone():
    long = "x" * 300_000
    seen = {}
    for texts in (["ab cd", long + " ab"], ["zz " * 50_000 + "cd ab " + long]):
        for _, data, off in T.pieces(batch(texts), "text"):
            s, e, _ = T.words(data, off)
            for a, b, h in zip(s, e, T.hash_spans(data, s, e)):
                assert seen.setdefault(bytes(data[a:b]), h) == h
    assert len(set(seen.values())) == len(seen) == 4


def test_shingles_and_repeats():
    (_, data, off), = T.pieces(batch(["a b c d e f", "a b", "", "b c d e f"]), "text")
    s, e, first = T.words(data, off)
    sh, begin = T.shingles(T.hash_spans(data, s, e), first)
    assert begin.tolist() == [0, 2, 3, 3, 4] and sh[1] == sh[3] and len(set(sh.tolist())) == 3
    twice, later = T.repeated(np.array([3, 1, 3, 2, 3], np.uint64))
    assert twice.tolist() == [True, False, True, False, True]
    assert later.tolist() == [False, False, True, False, True]
