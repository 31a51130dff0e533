"""Vectorised text work on Arrow batches (numpy inside tasks; Spark does the rest).

A batch's strings are one byte buffer plus offsets, so a whole batch is split
into words and hashed without making a Python string per word. A word is a run
of bytes other than space and 0x09-0x0D, which in UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+`` over code points. Memory is bounded by ``PIECE_BYTES``
(or by one text, when a text is longer) whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20
#: Text worked on at once where every word takes many numbers; what a worker has once
#: held it keeps, beside the executor's JVM. Of pairs, both sides together.
SMALL_PIECE, PAIR_BYTES = 512 << 10, 1 << 20
_SPAN = 1 << 17
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_M64 = (1 << 64) - 1
IS_SEP = np.zeros(256, bool)
IS_SEP[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, _SPAN + 1)
_INV = _powers(pow(_BASE, -1, 1 << 64), _SPAN + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _M64))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) with about ``limit`` bytes of text each; null is empty."""
    text = pc.fill_null(batch.column(column), "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string())
    off = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i, n = 0, len(text)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def pair_pieces(batch: pa.RecordBatch, columns: list[str], limit: int = PAIR_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``limit`` bytes in these text columns together."""
    size = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
               for c in columns)
    off = np.concatenate([[0], np.cumsum(size)])
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and where each text's words begin
    (length texts + 1). Words never cross from one text into the next."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = ~IS_SEP[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = off[1:] > off[:-1]
    b, e = off[:-1][filled], off[1:][filled] - 1
    first[b], last[e] = inside[b], inside[e]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all \\n-split lines, and each text's first line."""
    cut = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([off[:-1], cut + 1]))
    # an empty text still has one (empty) line; equal starts stay in text order
    at = np.searchsorted(cut, off)
    first = at + np.arange(len(off))
    ends = np.empty(len(starts), np.int64)
    is_last = np.zeros(len(starts), bool)
    is_last[first[1:] - 1] = True
    ends[is_last] = off[1:]
    ends[~is_last] = cut
    return starts, ends, first


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span (spans ascending, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        at = int(starts[i])
        j = int(np.searchsorted(ends, at + _SPAN, "right"))
        if j <= i:  # one span longer than a block: hash its blocks in turn
            h, end = 0, int(ends[i])
            for k in range(at, end, _SPAN):
                part = _BYTE[data[k:min(end, k + _SPAN)]]
                h = (h * 0x100000001B3 + int((part * _POW[:len(part)]).sum())) & _M64
            out[i] = h
            i += 1
            continue
        s, e = starts[i:j] - at, ends[i:j] - at
        part = _BYTE[data[at:at + int(e[-1])]]
        part *= _POW[:len(part)]
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum(part, out=total[1:])
        out[i:j] = (total[e] - total[s]) * _INV[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of an array's entries between each two offsets."""
    total = np.empty(len(flags) + 1, np.int64)
    total[0] = 0
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def owner(first: np.ndarray) -> np.ndarray:
    """Text number of every item, from where each text's items begin."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n consecutive items from each position on (len - n + 1)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m].copy()
    for k in range(1, n):
        out *= np.uint64(_BASE)
        out += h[k:k + m]
    return mix(out)


def ngram_starts(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Positions from which n items lie in one text."""
    m = total - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    end = np.repeat(first[1:], np.diff(first))[:m]
    return np.flatnonzero(np.arange(m) + n <= end)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per key: whether it occurs twice or more; whether it occurred earlier."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, later


def shingles(h: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """n-word shingle hashes of all texts, and where each text's begin. A text
    of 1 to n - 1 words has one shingle, the hash of all its words."""
    count = np.diff(first)
    at = ngram_starts(first, n, len(h))
    full = ngrams(h, n)[at] if len(at) else np.zeros(0, np.uint64)
    size = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    start = np.concatenate([[0], np.cumsum(size)])
    short = np.flatnonzero((count > 0) & (count < n))
    if not len(short):
        return full, start
    out = np.empty(start[-1], np.uint64)
    is_short = np.zeros(len(out), bool)
    is_short[start[short]] = True
    out[~is_short] = full
    for d in short:
        w = h[first[d]:first[d + 1]]
        out[start[d]] = ngrams(np.concatenate([w, np.full(1, len(w), np.uint64)]), len(w) + 1)[0]
    return out, start
