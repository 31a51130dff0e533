"""Approximate nearest neighbours by collision counting (operator 2).

Query-aware hashing: ``PROJECTIONS`` Gaussian projections, each a sorted array
of (value, vector). A query opens a window around its own projection in every
array; a vector inside is a collision. Virtual rehashing widens all windows by
the factor ``GROWTH`` at a time; vectors that collide in ``THRESHOLD`` of the
arrays are verified by their distance on the original vectors, in double
precision. A query ends when its k-th verified distance is well within the current
radius (``SURE``), or when 10 k vectors and the share ``VERIFIED`` of the index are verified (the
method's stop; widening goes on until then, whatever the number of candidates).
``THRESHOLD`` is where a window tells distances apart best: a share of collisions of
0.85 is a window of 1.44 standard deviations of a neighbour's projections.

Vectors stay where they are read: a task indexes up to ``BLOCK_ROWS`` of them at a
time and searches them for all queries, which are sent to the tasks ``QUERY_PART`` at
a time (30 MB of 64 dimensions), one pass over the vectors a part. Only k rows a
query and index are shuffled. Every vector is in an index; nothing is fitted on a
sample.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, neither do null ids; repeated rows count once; an id with
several vectors stands for the nearest of them, as a query and as a candidate; rows
with the query's own id are no candidates; vectors of another length than the
query's are none either; equal distances go by smaller id; fewer candidates than
k give fewer rows; an empty table gives none; other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, written

PROJECTIONS, GROWTH, THRESHOLD, VERIFIED = 128, 1.05, 0.85, 0.08
#: Half a window of collision share THRESHOLD, in standard deviations of a projected distance.
WINDOW = 1.44
#: A radius beyond the k-th distance at which nearly all nearer vectors are over the threshold.
SURE = 1.15
BLOCK_ROWS, QUERY_PART, K = 16384, 60_000, 10
FIRST_RADIUS = 0.6  # in standard deviations of the projections


class SortedProjections:
    """The index of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, dim = vectors.shape
        self.lines = np.random.default_rng(dim).normal(size=(dim, PROJECTIONS))
        value = vectors @ self.lines
        self.order = np.argsort(value, axis=0, kind="stable").T.astype(np.int32, order="C")
        self.value = np.take_along_axis(value.T.copy(), self.order, 1)
        self.spread = float(np.sqrt(np.mean(np.var(value, axis=0))))

    def search(self, own_id: int, query: np.ndarray, k: int) -> tuple[list[tuple[int, float]], int]:
        """The k nearest found, and how many vectors were verified."""
        n = len(self.ids)
        at = query @ self.lines
        slack = 1e-9 * (1 + np.abs(at))  # equal vectors may differ in the last bits
        low = [int(v.searchsorted(x)) for v, x in zip(self.value, at)]
        high = list(low)
        hits, seen = np.zeros(n, np.int32), self.ids == own_id
        candidates = n - int(np.count_nonzero(seen))
        need = int(np.ceil(THRESHOLD * PROJECTIONS))
        distance = np.full(n, np.inf)
        radius, verified = max(self.spread, 1e-9) * FIRST_RADIUS, 0
        while verified < candidates:
            half = WINDOW * radius + slack
            new = []
            for p, (v, o, a, b) in enumerate(zip(self.value, self.order, at - half, at + half)):
                a, b = min(int(v.searchsorted(a)), low[p]), max(int(v.searchsorted(b, "right")), high[p])
                new += (o[a:low[p]], o[high[p]:b])
                low[p], high[p] = a, b
            hits += np.bincount(np.concatenate(new), minlength=n).astype(np.int32)
            take = np.flatnonzero((hits >= need) & ~seen)
            if len(take):
                seen[take] = True
                verified += len(take)
                distance[take] = np.sqrt(((self.vectors[take] - query) ** 2).sum(1))
            if verified >= 10 * k + VERIFIED * n or np.count_nonzero(distance <= radius / SURE) >= k:
                break
            radius *= GROWTH
        found = np.flatnonzero(np.isfinite(distance))
        order = np.lexsort((self.ids[found], distance[found]))[:k]
        return [(int(self.ids[i]), float(distance[i])) for i in found[order]], verified


def usable(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding")
    infinity = float("inf")
    fine = (F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0)
            & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity))
            & F.exists(e, lambda x: x != 0))
    return (vectors.select("vec_id", "embedding").where(fine).groupBy("vec_id", "embedding").agg(
        F.lit(1).alias("one")).select(F.col("vec_id").cast("long").alias("vec_id"),
                                      F.col("embedding").cast("array<double>").alias("embedding"),
                                      F.size("embedding").alias("dim")))


def _searched(queries, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The k nearest of every index a task builds, for all queries."""
        held: dict[int, list] = {}

        def out(dim: int) -> pd.DataFrame:
            part = pd.concat(held.pop(dim))
            index = SortedProjections(part["vec_id"].to_numpy(np.int64), np.stack(part["embedding"].to_numpy()))
            ids, asked = queries.value[dim]
            rows = [(q, i, d) for q, vector in zip(ids.tolist(), asked) for i, d in index.search(q, vector, k)[0]]
            return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})

        for batch in batches:
            for dim, part in batch.groupby("dim"):
                if dim in queries.value:
                    held.setdefault(dim, []).append(part)
                    if sum(map(len, held[dim])) >= BLOCK_ROWS:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)
    return run


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id,
    embedding) where ``is_query`` holds, against all rows."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = written(usable(vectors), "vectors")
    parts = max(1, -(-rows.where(is_query).count() // QUERY_PART))
    found = []
    for part in range(parts):
        asked: dict[int, tuple[list, list]] = {}
        mine = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(parts)) == part
        for r in rows.where(is_query & mine).select("dim", "vec_id", "embedding").toLocalIterator():
            ids, vecs = asked.setdefault(r["dim"], ([], []))
            ids.append(r["vec_id"])
            vecs.append(r["embedding"])
        queries = spark.sparkContext.broadcast(
            {d: (np.array(ids, np.int64), np.array(vecs)) for d, (ids, vecs) in asked.items()})
        found.append(rows.select("dim", "vec_id", "embedding").mapInPandas(
            _searched(queries, k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (reduce(DataFrame.unionByName, found).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest_of_hundredths(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("vec_id") % 100 == 0)
