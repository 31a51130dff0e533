"""Quality rules by repetition coverage (operator 3).

For every whole text, rolling hashes of word n-grams of several lengths mark
the words that lie in an n-gram found twice or more in the same text; the share
of word characters they cover, and the share in repeated lines, decide. One
pass over the rows in numpy, no shuffle.

Defined results: null and empty texts have no words, so ``base_failed`` (fewer
than ``min_words``); every input row gives one output row, so repeated rows and
equal doc_ids are kept as they are; texts of any length are read whole, one at a
time; nothing is ranked, so ties do not arise; an empty table gives an empty result; other
columns are not read, so clashing names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textops as T
from .common import bounded_batches

#: n-gram length -> largest share of word characters inside repeated n-grams, of
#: the order of the published 0.15 to 0.10; a clean text of 220 words with one line
#: of 10 words written twice reaches 0.103 at 10-grams and is kept
LIMITS = {5: 0.15, 7: 0.13, 10: 0.11}
#: largest share of characters (of lines with a word) in lines equal to an earlier one
LINE_LIMIT = 0.20
MIN_WORDS, REPEAT_PERCENT = 50, 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, dup_line_share double, "
          + ", ".join(f"dup_{n}gram_share double" for n in LIMITS))


def _covered(h, first, text_of, n):
    """Words inside an n-gram that occurs twice or more in its text."""
    at = T.ngram_starts(first, n, len(h))
    if not len(at):
        return np.zeros(len(h), bool)
    key = T.ngrams(h, n)[at] ^ T.seeded(text_of[at].astype(np.uint64), 1)
    hit = at[T.repeated(key)[0]]
    edge = np.zeros(len(h) + 1, np.int32)
    edge[hit] += 1
    edge[hit + n] -= 1  # starts are distinct, so plain indexing adds once each
    return np.cumsum(edge[:-1]) > 0


def measure(rows: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of the texts of one piece."""
    starts, ends, first = T.words(data, off)
    h, text_of, n_words = T.hash_spans(data, starts, ends), T.owner(first), np.diff(first)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = points[ends] - points[starts]
    word_chars = T.per_text(chars, first)
    ls, le, lfirst = T.lines(data, off)
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, line_of = ls[has_word], le[has_word], T.owner(lfirst)[has_word]
    later = T.repeated(T.hash_spans(data, ls, le) ^ T.seeded(line_of.astype(np.uint64), 2))[1]
    m = len(off) - 1
    line_chars = points[le] - points[ls]
    all_lines = np.bincount(line_of, line_chars, m)
    dup_lines = np.bincount(line_of, line_chars * later, m)
    repeat = T.per_text(_covered(h, first, text_of, 3), first)
    out = {"n_words": n_words, "word_chars": word_chars,
           "n_symbols": T.per_text(_SYMBOL[data], off),
           "n_dup_lines": np.bincount(line_of, later, m).astype(np.int64),
           "n_repeat_words": repeat,
           "base_failed": (n_words < MIN_WORDS) | (100 * repeat > REPEAT_PERCENT * n_words),
           "dup_line_share": dup_lines / np.maximum(all_lines, 1)}
    kept = ~out["base_failed"] & (out["dup_line_share"] <= LINE_LIMIT)
    for n, limit in LIMITS.items():
        share = T.per_text(chars * _covered(h, first, text_of, n), first) / np.maximum(word_chars, 1)
        out[f"dup_{n}gram_share"] = share
        kept &= share <= limit
    return out | {"kept": kept}


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with measures and verdict."""
    bounded_batches(docs.sparkSession)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in T.pieces(batch, "text"):
                got = measure(rows, data, off) | {"doc_id": rows.column("doc_id").cast(pa.int64())}
                yield pa.RecordBatch.from_arrays([pa.array(got[n]) for n in names], names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
