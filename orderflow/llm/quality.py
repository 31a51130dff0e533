"""Quality classifier (operator 1): hashed word n-gram logistic regression,
trained with follow-the-regularised-leader updates, scored as sparse dot products.

Features are relative frequencies of word n-grams (1 and 2 words) and of
n-grams (1 to 3) of the words' shapes (case, digits, symbols, length class,
whether a word repeats the one before), all hashed into ``DIM`` coordinates.

The fit uses a bounded sample of labelled rows: at most ``SAMPLE_PER_CLASS`` of
each class, those with the smallest hash of doc_id. It runs in one task over
that sample; class shares of all labelled rows correct the intercept. The
weights (``DIM`` floats, 1 MB) are the only thing the driver sees. Scoring is
one pass over all whole texts.

Defined results: null and empty texts have no features and score the intercept;
every input row gives one output row (repeated rows too); labels that are null
or neither 0 nor 1 are ignored, several labels of a doc_id are averaged (0.5 or
more is 1), and of several rows with one labelled doc_id one text is learned from;
a row without doc_id is not held out; ties of the sample's hash go by doc_id; texts
of any length are read whole; an empty table gives an empty result; without any
usable label every score is 0.5; other columns are not read, so clashing names do
not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import SMALL_BATCH, bounded_batches, crc_mod

DIM = 1 << 18
SAMPLE_PER_CLASS = 3000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.3, 1.0, 1e-3, 1e-3

_UPPER, _DIGIT, _SYMBOL, _POINT = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"?()-"]] = True
_POINT[list(b".,;:'\"?()-")] = True


def _share(flag: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """0: no byte of the word is flagged, 1: some, 2: half or more, 3: all."""
    total = np.concatenate([[0], np.cumsum(flag)])
    n, size = total[ends] - total[starts], ends - starts
    return (n > 0).astype(np.uint64) + (2 * n >= size) + (n == size)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coordinate, text, value) of every n-gram occurrence of one piece."""
    starts, ends, first = T.words(data, off)
    h, text_of, n = T.hash_spans(data, starts, ends), T.owner(first), np.diff(first)
    # letters outside ASCII carry case in their second byte (0xC3 0x80-0x9E)
    upper = _UPPER[data]
    if len(data) > 1:
        upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    shape = _share(upper | (data == 0xC3), starts, ends)
    for flag in (_DIGIT[data], _SYMBOL[data], _POINT[data]):
        shape = shape * np.uint64(4) + _share(flag, starts, ends)
    shape = shape * np.uint64(8) + np.minimum((ends - starts) // 4, 7).astype(np.uint64)
    same = np.zeros(len(h), np.uint64)
    same[1:] = (h[1:] == h[:-1]) & (text_of[1:] == text_of[:-1])
    shape = T.mix(shape * np.uint64(2) + same + np.uint64(1))
    found = []
    for seed, of, size in ((11, h, 1), (12, h, 2), (13, shape, 1), (14, shape, 2), (15, shape, 3)):
        at = T.ngram_starts(first, size, len(h))
        key = T.seeded(T.ngrams(of, size)[at], seed) if len(at) else np.zeros(0, np.uint64)
        doc = text_of[at]
        found.append(((key & np.uint64(DIM - 1)).astype(np.int32), doc,
                      (1.0 / np.maximum(n - size + 1, 1))[doc]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse vectors of labelled rows: coordinates ascending, values float32."""
    for batch in batches:
        for rows, data, off in T.pieces(batch, "text", T.SMALL_PIECE):
            index, doc, value = features(data, off)
            key, where = np.unique(doc.astype(np.int64) * DIM + index, return_inverse=True)
            total = np.bincount(where, value, len(key)).astype(np.float32)
            cut = np.searchsorted(key, np.arange(len(off)) * DIM)
            index = (key % DIM).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), rows.column("label").cast(pa.int32()),
                 pa.array([index[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                 pa.array([total[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                ["doc_id", "label", "index", "value"])


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], dim: int = DIM) -> np.ndarray:
    """Weights (the last one is the intercept) after FTRL-proximal updates."""
    z, s = np.zeros(dim + 1), np.zeros(dim + 1)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(s[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(examples)):
            i, x, y = examples[k]
            x = x.astype(float)
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            add = g * g
            z[i] += g - (np.sqrt(s[i] + add) - np.sqrt(s[i])) / ALPHA * w
            s[i] += add
    return weights(np.arange(dim + 1))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["doc_id"], r["index"]))  # the same order on every run
    ones, total, examples = sum(r["label"] for r in rows), len(rows), []
    for k, r in enumerate(rows):
        rows[k] = None  # a row's bytes go as its arrays come
        examples.append((np.append(np.frombuffer(r["index"], np.int32), np.int32(DIM)),
                         np.append(np.frombuffer(r["value"], np.float32), np.float32(1.0)), r["label"]))
    w = ftrl(examples).astype(np.float32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([w.tobytes()], pa.binary()),
         pa.array([ones], pa.int64()), pa.array([total], pa.int64())],
        ["weights", "ones", "total"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> np.ndarray:
    """Weights from labelled rows (doc_id, quality) joined to their whole texts."""
    bounded_batches(docs.sparkSession, SMALL_BATCH)
    usable = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")))
    count = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not count:
        return np.zeros(DIM + 1, np.float32)
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    parts = [usable.where(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * per_class rows
    # a doc_id that several rows carry gives one example, so the bound holds
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    texts = (docs.select("doc_id", "text").join(chosen, "doc_id").withColumn("nth", F.row_number().over(one))
             .where("nth <= 1").select("doc_id", "text", "label"))
    got = (texts.mapInArrow(_vectors, "doc_id long, label int, index binary, value binary")
           .repartition(1).mapInArrow(_fit, "weights binary, ones long, total long").collect())
    if not got or not got[0]["total"]:
        return np.zeros(DIM + 1, np.float32)
    w = np.frombuffer(got[0]["weights"], np.float32).copy()
    ones, zeros = got[0]["ones"], got[0]["total"] - got[0]["ones"]
    if ones and zeros:  # the sample is balanced; all labelled rows need not be
        w[DIM] += np.log(count[1] / count[0]) - np.log(ones / zeros)
    return w


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    bounded_batches(docs.sparkSession, SMALL_BATCH)
    model = docs.sparkSession.sparkContext.broadcast(weights)  # DIM + 1 floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            for rows, data, off in T.pieces(batch, "text", T.SMALL_PIECE):
                index, doc, value = features(data, off)
                dot = np.bincount(doc, w[index] * value, len(off) - 1) + w[DIM]
                p = 1.0 / (1.0 + np.exp(-np.clip(dot, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").cast(pa.int64()), pa.array(p)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs``; rows whose crc32(doc_id) mod 3 is 1 are held
    out: their labels are never learned from."""
    weights = train(docs, labels.where(crc_mod("doc_id", 3) != 1))
    return score(docs, weights).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns."""
    weights = train(docs, labels.where(crc_mod("doc_id", 3) != 1))
    model = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            for rows, data, off in T.pieces(batch, batch.schema.names[at], T.SMALL_PIECE):
                index, doc, value = features(data, off)
                dot = np.bincount(doc, w[index] * value, len(off) - 1) + w[DIM]
                good = rows.filter(pa.array(dot >= 0))
                if len(good):
                    yield good

    return docs.mapInArrow(run, docs.schema)
