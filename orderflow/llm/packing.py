"""Packing into fixed-length sequences (operator 9): bounded-space online packing.

Each task tokenizes its rows and keeps at most ``OPEN`` windows open. A text's
full windows go out at once; its rest goes to the open window it fits best. If
it fits none and no more may be opened, the fullest is emitted (filled up from
the text first when more than ``MIN_CUT`` places are free). What is open at the
end is packed again, fullest first; windows still too empty are merged across
tasks, ``MERGE_TASKS`` tasks at a time. Only piece rows are shuffled, no tokens.

Tokens come from the tokenizer's file; words are tokenized once per worker and
kept by hash (at most ``CACHE_WORDS``), which equals tokenizing whole texts as
the tokenizer never joins across white space.

Defined results: null and empty texts are the end token alone; every input row
is packed (repeated rows and equal doc_ids each on their own); a text of any length
is cut into full windows; of windows that fit equally the first opened is taken; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import bounded_batches, written

WINDOW, END_ID = 4096, 2
OPEN, MIN_CUT, FULL_ENOUGH, MERGE_TASKS = 48, 64, 0.97, 256
CACHE_WORDS = 1_500_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_TOKENIZERS: dict[str, "WordTokens"] = {}


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """Token ids of words, kept by word hash."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        # entry 0 stands for the end of a text
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.start, self.count = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.ids = np.array([END_ID], np.uint32)

    def _add(self, keys: np.ndarray, words: list[str]) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        count = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((i for ids in got for i in ids), np.uint32, int(count.sum()))
        start = len(self.ids) + np.cumsum(count) - count
        entry = len(self.count) + np.arange(len(keys))
        self.ids = np.concatenate([self.ids, flat])
        self.start, self.count = np.append(self.start, start), np.append(self.count, count)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.entry = np.insert(self.keys, at, keys), np.insert(self.entry, at, entry)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a piece, each with the end id, and their offsets."""
        starts, ends, first = T.words(data, off)
        key, one, where = np.unique(T.hash_spans(data, starts, ends), return_index=True,
                                    return_inverse=True)
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        new = self.keys[at] != key if len(self.keys) else np.ones(len(key), bool)
        if new.any():
            raw = data.tobytes()
            self._add(key[new], [raw[starts[i]:ends[i]].decode() for i in one[new]])
        entry = self.entry[np.searchsorted(self.keys, key)] if len(key) else np.zeros(0, np.int64)
        item = np.insert(entry[where], first[1:], 0)
        item_first = first + np.arange(len(first))
        count = self.count[item]
        end = np.cumsum(count)
        ids = self.ids[np.repeat(self.start[item] - end + count, count) + np.arange(int(end[-1]))]
        return ids, np.concatenate([[0], end])[item_first]


def word_tokens(path: str) -> WordTokens:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokens(path)
    return _TOKENIZERS[path]


class Packer:
    """Open windows of one task. A piece is (doc_id, start, length, crc, doc_tokens)."""

    def __init__(self, window: int = WINDOW, most: int = OPEN):
        self.window, self.most, self.serial = window, most, 0
        self.open: list[tuple[int, int, list]] = []  # (free places, serial, pieces), ascending
        self.done: list[list] = []

    def _put(self, at: int, piece) -> None:
        free, serial, pieces = self.open.pop(at)
        pieces.append(piece)
        free -= piece[2]
        if free:
            bisect.insort(self.open, (free, serial, pieces))
        else:
            self.done.append(pieces)

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, at = len(ids), 0

        def piece(size):
            return doc_id, at, size, zlib.crc32(ids[at:at + size].tobytes()), n

        while n - at >= self.window:
            self.done.append([piece(self.window)])
            at += self.window
        while at < n:
            rest = n - at
            best = bisect.bisect_left(self.open, (rest,))
            if best < len(self.open):
                self._put(best, piece(rest))
                return
            if len(self.open) >= self.most:
                free = self.open[0][0]
                if free > MIN_CUT:
                    self._put(0, piece(free))
                    at += free
                    continue
                self.done.append(self.open.pop(0)[2])
            self.serial += 1
            bisect.insort(self.open, (self.window - rest, self.serial, [piece(rest)]))
            return

    def rest(self) -> list[list]:
        """The open windows' pieces packed again, largest first into the best fit."""
        pieces = [p for _, _, x in self.open for p in x]
        self.open = []
        return best_fit(pieces, self.window)


def best_fit(pieces: list[tuple], window: int) -> list[list]:
    """Largest first, each into the fullest window that has room."""
    open_: list[tuple[int, int, list]] = []
    for k, p in enumerate(sorted(pieces, key=lambda p: (-p[2], str(p[0]), p[1], p[3]))):
        at = bisect.bisect_left(open_, (p[2],))
        free, serial, held = open_.pop(at) if at < len(open_) else (window, k, [])
        held.append(p)
        bisect.insort(open_, (free - p[2], serial, held))
    return [held for _, _, held in open_]


def _rows(sequences: Iterator[tuple[int, list]]):
    for sequence_id, pieces in sequences:
        offset = 0
        for doc_id, start, length, crc, doc_tokens in pieces:
            yield doc_id, start, length, crc, doc_tokens, sequence_id, offset
            offset += length


def _table(rows: list[tuple], names: list[str]) -> dict[str, list]:
    return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """Piece rows of all rows of ``docs`` (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    path = path or tokenizer_path()
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, tokens, packer = TaskContext.get().partitionId(), word_tokens(path), Packer(window)
        made = 0

        def out(sequences, left):
            nonlocal made
            numbered = [((task << 36) + made + k, s) for k, s in enumerate(sequences)]
            made += len(numbered)
            t = _table(list(_rows(numbered)), names)
            return pa.RecordBatch.from_arrays(
                [pa.array(t[n], pa.int64()) for n in names]
                + [pa.array([left] * len(t["length"]), pa.bool_())], [*names, "left"])

        for batch in batches:
            for rows, data, off in T.pieces(batch, "text"):
                ids, at = tokens.encode(data, off)
                for k, doc_id in enumerate(rows.column("doc_id").to_pylist()):
                    packer.add(doc_id, ids[at[k]:at[k + 1]])
                if packer.done:
                    yield out(packer.done, False)
                    packer.done = []
        rest = packer.rest()
        full = [s for s in rest if sum(p[2] for p in s) >= FULL_ENOUGH * window]
        yield out(full, False)
        yield out([s for s in rest if sum(p[2] for p in s) < FULL_ENOUGH * window], True)

    packed = written(docs.select("doc_id", "text").mapInArrow(run, SCHEMA + ", left boolean"), "packed")

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # object columns keep a null doc_id apart from every number
        held = list(zip(*[rows[c].astype(object).where(rows[c].notna(), None) for c in names[:5]]))
        made = best_fit([(None if a is None else int(a), int(b), int(c), int(d), int(e))
                         for a, b, c, d, e in held], window)
        base = (1 << 62) + (int(key[0]) << 36)
        t = _table(list(_rows((base + k, s) for k, s in enumerate(made))), names)
        return pd.DataFrame({n: pd.array(t[n], "Int64") for n in names})

    group = F.shiftright("sequence_id", 36) / MERGE_TASKS
    merged = (packed.where("left").drop("left")
              .groupBy(F.floor(group).alias("g")).applyInPandas(merge, SCHEMA))
    return packed.where(~F.col("left")).drop("left").unionByName(merged)
