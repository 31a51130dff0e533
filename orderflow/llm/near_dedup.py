"""MinHash near-duplicate removal (operator 7) with DartMinHash signatures.

A text is the weighted set of its five-word shingles (weight: how often). Darts
are a unit-rate Poisson process along the rank axis of every unit of weight,
drawn from the unit's hash, so equal units throw equal darts in every text.
Each dart falls on one of ``K`` coordinates; a coordinate keeps its earliest.
Darts are thrown up to the rank at which K (ln K + 2) are expected, twice as far
for texts with an empty coordinate, so a signature costs one hash per shingle.

``BANDS`` bands of ``K / BANDS`` coordinates are joined. Equal texts are one
node. First, in each band's bucket, every text is compared with one leader (the
one that meets most others), exactly: weighted Jaccard of the whole texts. Texts that
are left in buckets of several classes (they share a common passage, say) are then
put into buckets by their rarest units: two texts at least 0.8 alike share one of
the rarest 20 % (plus one) of each, while a passage that many texts share is not
among the rarest; where it stands in both says how much they can share. While such a bucket's members lie in several classes,
``LEADERS`` of them lead and are compared with all those outside their own class.
So every pair that shares a band ends in one class or is compared or cannot be 0.8
alike; a round's pairs stay in proportion to the rows, and large groups of copies,
being one class, are not expanded into their pairs.

Defined results: null text counts as empty; texts without words have no
shingles and are duplicates of equal texts only; repeated rows are copies, and
one of them is kept; ties of a rank go to the smaller key; texts of any length are
read whole; an empty table gives an empty result; other columns are not
read by ``near_duplicates`` and are kept as they are by ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import SMALL_BATCH, bounded_batches, written
from .graph import stars

SHINGLE, SIMILARITY = 5, 0.8
K, BANDS = 100, 20
#: leaders of a bucket in one round
LEADERS = 256
_DARTS = K * (np.log(K) + 2)


def units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all units of weight (shingle, occurrence), ascending within each
    text, and where each text's begin."""
    starts, ends, first = T.words(data, off)
    sh, begin = T.shingles(T.hash_spans(data, starts, ends), first, SHINGLE)
    doc = T.owner(begin)
    order = np.lexsort((sh, doc))
    sh = sh[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(sh))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    return T.seeded(sh + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 21), begin


def signatures(unit: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(texts, K) earliest darts; rows of texts without units are 0."""
    m = len(begin) - 1
    n = np.diff(begin)
    sig = np.zeros((m, K), np.uint64)
    todo, reach = np.flatnonzero(n), 1.0
    while len(todo):
        size = n[todo]
        at = np.repeat(begin[todo] - np.cumsum(size) + size, size) + np.arange(size.sum())
        x = unit[at]
        local = np.repeat(np.arange(len(todo)), size)
        limit = np.repeat(reach * _DARTS / size, size)
        rank = np.zeros(len(x))
        slot, when, dart = [], [], []
        throw = 0
        while len(x):
            h = T.seeded(x, 100 + throw)
            rank = rank - np.log(T.unit(h))
            hit = rank <= limit
            x, local, limit, rank, h = x[hit], local[hit], limit[hit], rank[hit], h[hit]
            slot.append(local * K + (T.mix(h) % np.uint64(K)).astype(np.int64))
            when.append(rank)
            dart.append(h)
            throw += 1
        slot, when, dart = (np.concatenate(v) for v in (slot, when, dart))
        order = np.lexsort((dart, when))[::-1]  # the earliest is written last
        got = np.zeros(len(todo) * K, np.uint64)
        got[slot[order]] = dart[order]
        got = got.reshape(len(todo), K)
        full = (got != 0).all(1)
        sig[todo[full]] = got[full]
        todo, reach = todo[~full], reach * 2
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(texts, BANDS) keys."""
    rows = K // BANDS
    out = np.empty((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(sig), b + 1, np.uint64)
        for r in range(rows):
            h = T.mix(h * np.uint64(0x100000001B3) + sig[:, b * rows + r])
        out[:, b] = h
    return out


def signed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, key, bands): one row per row; key identifies the text, bands
    is null for texts without words."""
    bounded_batches(docs.sparkSession, SMALL_BATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, data, off in T.pieces(batch, "text", T.SMALL_PIECE):
                unit, begin = units(data, off)
                bands = band_keys(signatures(unit, begin)).view(np.int64)
                m = len(rows)
                none = np.diff(begin) == 0
                raw = data.tobytes()
                at = np.append(np.arange(m) * BANDS, m * BANDS).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((task << 36) + done + np.arange(m)),
                     rows.column("doc_id").cast(pa.int64()),
                     pa.array([hashlib.md5(raw[a:b]).digest() for a, b in zip(off, off[1:])], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(at, mask=np.append(none, False)),
                                              pa.array(bands.ravel()))],
                    ["row", "doc_id", "key", "bands"])
                done += m

    return docs.select("doc_id", "text").mapInArrow(
        run, "row long, doc_id long, key binary, bands array<long>")


def _similar(pairs: DataFrame) -> DataFrame:
    """(a, b) of the rows (a, b, ta, tb) whose texts are at least SIMILARITY alike."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.pair_pieces(batch, ["ta", "tb"]):
                (rows, data, off), = T.pieces(part, "ta", 1 << 62)
                (_, data2, off2), = T.pieces(rows, "tb", 1 << 62)
                (x, bx), (y, by) = units(data, off), units(data2, off2)
                doc = np.concatenate([T.owner(bx), T.owner(by)])
                order = np.lexsort((np.concatenate([x, y]), doc))
                v, d = np.concatenate([x, y])[order], doc[order]
                both = np.bincount(d[1:][(v[1:] == v[:-1]) & (d[1:] == d[:-1])], minlength=len(off) - 1)
                either = np.diff(bx) + np.diff(by) - both
                out = rows.filter(pa.array(both >= SIMILARITY * np.maximum(either, 1)))
                yield out.select(["a", "b"])

    return pairs.mapInArrow(run, "a binary, b binary")


def text_key(column: str = "text"):
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))


def rare_units(texts: DataFrame) -> DataFrame:
    """(band, key, nth, n): the units among the n - ceil(0.8 n) + 1 rarest of a text
    of n, by the number of these texts they are in, that more than one text has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in T.pieces(batch, "text", T.SMALL_PIECE):
                unit, begin = units(data, off)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key").take(pa.array(T.owner(begin))), pa.array(unit.view(np.int64))],
                    ["key", "band"])

    unit = written(texts.select("key", "text").mapInArrow(run, "key binary, band long"), "units")
    common = unit.groupBy("band").agg(F.count("*").alias("df"))
    size = unit.groupBy("key").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("key").orderBy("df", "band"))
    return (unit.join(common, "band").withColumn("nth", nth).join(size, "key")
            .where((F.col("nth") <= F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1) & (F.col("df") > 1))
            .select("band", "key", "nth", "n"))


def near_duplicate_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): the signed rows, and (key, root) of texts in a class of
    more than one text; the root itself, the class's smallest key, has no row."""
    signs = written(signed(docs), "signs")
    texts = written(signs.groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("one"),
                                             F.first("bands").alias("bands")), "texts")
    # buckets with one text alone can give no pair: leave them out from the start
    member = texts.select(F.explode("bands").alias("band"), "key")
    shared = member.groupBy("band").agg(F.min("key").alias("x"), F.max("key").alias("y"),
                                        F.count("*").alias("n")).where("x <> y").select("band", "n")
    member = written(member.join(shared, "band"), "members")
    # the text that meets most others leads its buckets: a group's middle, not its edge
    met = member.groupBy("key").agg(F.sum("n").alias("met"))
    lead = (member.join(met, "key").groupBy("band").agg(F.max(F.struct("met", "key")).alias("s"))
            .select("band", F.col("s.key").alias("lead")))
    member = written(member.join(lead, "band").select("band", "key", "lead"), "members")
    pairs = written(member.where("key <> lead").select(F.least("key", "lead").alias("a"),
                                                       F.greatest("key", "lead").alias("b"))
                    .distinct(), "pairs")
    # the texts that any pair needs, once each, from the row the group was found by
    needed = member.select("key").distinct().join(texts.select("key", "one.doc_id"), "key")
    found = (docs.select(F.col("doc_id").alias("d"), "text", text_key().alias("key"))
             .join(needed.hint("shuffle_hash"), "key").where("d <=> doc_id").select("key", "text"))
    wanted = written(found.groupBy("key").agg(F.first("text").alias("text")), "wanted")

    def compare(p: DataFrame) -> DataFrame:
        side = [wanted.select(F.col("key").alias(c), F.col("text").alias("t" + c)) for c in "ab"]
        return _similar(p.join(side[0], "a").join(side[1], "b").select("a", "b", "ta", "tb"))

    def unresolved(rows: DataFrame, classes: DataFrame) -> DataFrame:
        """The rows, with their class, of the buckets that hold several classes."""
        rows = (rows.join(classes.withColumnRenamed("node", "key"), "key", "left")
                .withColumn("root", F.coalesce("root", "key")))
        several = rows.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")
                                           ).where("x <> y").select("band")
        return rows.join(several, "band")

    edges, tried, done = written(compare(pairs), "links"), pairs, None
    classes = stars(edges)
    # what a bucket still leaves apart is asked again by rare units
    open_ = written(unresolved(member, classes).select("key").distinct(), "open")
    member = written(rare_units(wanted.join(open_, "key")), "members")
    while True:
        left = member if done is None else member.join(done, ["band", "key"], "left_anti")
        left = written(unresolved(left, classes), "left")
        if left.isEmpty():
            return signs, classes.withColumnRenamed("node", "key")
        # members of a bucket's smallest classes lead next: fewest rounds
        share = left.groupBy("band", "root").agg(F.count("*").alias("members"))
        order = Window.partitionBy("band").orderBy("members", "root", "key")
        lead = written(left.join(share, ["band", "root"]).withColumn("place", F.row_number().over(order))
                       .where(F.col("place") <= LEADERS)
                       .select("band", F.col("key").alias("lead"), F.col("root").alias("lead_root"),
                               F.col("n").alias("lead_n"), F.col("nth").alias("lead_nth")), "lead")
        # by their first common unit, two texts of n and m units that are 0.8 alike
        # have 4/9 (n + m) units or more in common from there on
        rest = F.least(F.col("n") - F.col("nth"), F.col("lead_n") - F.col("lead_nth")) + 1
        meets = ((left["band"] == lead["band"]) & (F.col("root") != F.col("lead_root"))
                 & (rest * 9 >= (F.col("n") + F.col("lead_n")) * 4))
        pairs = (left.join(lead, meets)
                 .select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b"))
                 .distinct().join(tried, ["a", "b"], "left_anti"))
        pairs = written(pairs, "pairs")
        # the classes so far stand for all earlier links
        edges = written(classes.select(F.col("node").alias("a"), F.col("root").alias("b"))
                        .unionByName(compare(pairs)), "links")
        tried = written(tried.unionByName(pairs), "tried")
        now = lead.select("band", F.col("lead").alias("key"))
        done = written(now if done is None else done.unionByName(now), "leaders")
        classes = stars(edges)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the class's smallest doc_id), class_size (rows), kept
    (one row of each class) for every row."""
    signs, classes = near_duplicate_classes(docs)
    rows = signs.select("row", "doc_id", "key")
    text = rows.groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("one"), F.count("*").alias("n"))
    text = text.join(classes, "key", "left").withColumn("root", F.coalesce("root", "key"))
    whole = text.groupBy("root").agg(F.min("one").alias("one"), F.sum("n").alias("class_size"))
    text = text.select("key", "root").join(whole, "root").select("key", "one", "class_size")
    return rows.join(text, "key").select(
        "doc_id", F.col("one.doc_id").alias("class_id"), "class_size",
        (F.col("row") == F.col("one.row")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class, all columns."""
    signs, classes = near_duplicate_classes(docs)
    text = signs.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    text = text.join(classes, "key", "left")
    kept = text.groupBy(F.coalesce("root", "key").alias("root")).agg(
        F.min(F.struct("doc_id", "key")).alias("s")).select(
        F.col("s.doc_id").alias("__id"), F.col("s.key").alias("__key"))
    # the row stays whole in one column, whatever its columns are called
    found = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), text_key().alias("key")).join(
        kept.hint("shuffle_hash"), F.col("key") == F.col("__key"))
    return (found.where(F.col("id").eqNullSafe(F.col("__id"))).dropDuplicates(["key"])
            .select("doc.*"))
