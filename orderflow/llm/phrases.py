"""Phrase collocations from a vertically partitioned suffix tree (operator 12).

Words are numbered by a 64-bit digest of language and word. The suffixes of all
pieces, cut after ``LONGEST`` words, are parted by word prefixes: a prefix that has
more than ``LIGHT`` suffixes is lengthened by a word, until it is light or the whole
phrase; its own count is read off that step. Light prefixes are put into groups of
about ``GROUP / 2`` suffixes, and the subtree of each group is built on its own, in
one task, as a sorted array of its distinct suffixes; the count of a node is the
total of the leaves below it. Only nodes counted ``MIN_COUNT`` times or more leave a
task, and scores, cuts and containment are joins of those.

Tasks hold ``FLUSH`` words of text and send each group one compressed block of
distinct suffixes with counts, so a phrase in a third of all texts is one entry a
block. No dictionary is sent to tasks: only heavy prefixes are, at most
``HEAVY_ROWS`` of them (the limit rises where there are more). Two words with one
digest are seen by a second digest in the vocabulary; all is then counted again with
other digests, so counts are exact.

Defined results: null and empty texts have no words; a null lang is ``und``, also
beside rows that say ``und``; repeated rows and equal ids count each; ties of score
and count are ordered by the phrase's bytes; an empty table gives no rows. Texts of
any length are read whole. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops
from .common import bounded_batches, written

LONGEST = 4
MIN_COUNT = 30
#: A longer candidate that holds at least this share (percent) of a phrase's places replaces it.
INSIDE_PERCENT = 80
TOP = 2000
#: Suffixes that a group's subtree is meant to hold at most.
GROUP = 2_000_000
#: A prefix with more suffixes is lengthened.
LIGHT = GROUP // 4
#: Heavy prefixes of one length that may be sent to the tasks.
HEAVY_ROWS = 1 << 20
#: Words that a task holds before it writes them out.
FLUSH = 1_000_000
IDS = ["i1", "i2", "i3", "i4"]

# A-Z lower-cased; the marks that end a piece become line feeds, which end one too.
_PLAIN = textops.LOWER.copy()
_PLAIN[[ord(c) for c in ".,;:!?"]] = 0x0A
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[0x0A:0x0E] = True


def _lang_digests(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
                     for x in langs], np.uint64)


def _bytes_order(seed: int) -> np.ndarray:
    """Bytes exchanged before hashing: other digests for every seed but 0."""
    return (np.random.default_rng(seed).permutation(256) if seed else np.arange(256)).astype(np.uint8)


def _held(batches: Iterator[pa.RecordBatch], seed: int, flush: int):
    """About ``flush`` words at a time (more only for a longer text): their digests,
    the pieces they stand in, lang numbers, and (bytes, starts, ends, langs)."""
    order = _bytes_order(seed)
    known: dict[str, int] = {}
    held, size, at = [], 0, 0

    def out():
        ids, piece, lang, data, starts, ends = (np.concatenate(x) for x in zip(*held))
        return ids, piece, lang, (data, starts, ends, list(known))

    for batch in batches:
        for rows, data, off in textops.pieces(batch, "text"):
            data = _PLAIN[data]
            starts, ends, first = textops.words(data, off)
            if not len(starts):
                continue
            doc = textops.owner(first)
            codes = pc.dictionary_encode(rows.column("lang"))
            numbers = np.array([known.setdefault(x, len(known)) for x in codes.dictionary.to_pylist()])
            lang = numbers[codes.indices.to_numpy()][doc]
            ids = textops.mix(textops.hash_spans(order[data], starts, ends) ^ _lang_digests(list(known))[lang])
            ids[ids == 0] = 1  # 0 stands for no word
            cuts = np.concatenate([[0], np.cumsum(_ENDS_PIECE[data])])
            # bytes and texts before make places differ from those held so far
            held.append((ids, cuts[starts] + doc + 2 * at, lang, data, starts + at, ends + at))
            size += len(ids)
            at += len(data) + 1 + len(off)
            held[-1] = (*held[-1][:3], np.concatenate([data, np.zeros(1 + len(off), np.uint8)]), *held[-1][4:])
            if size >= flush:
                yield out()
                held, size, at = [], 0, 0
    if held:
        yield out()


def _vocabulary(seed: int, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct words with counts, of so many words at most."""
        for ids, _, lang, (data, starts, ends, langs) in _held(batches, seed, flush):
            _, at, n = np.unique(ids, return_index=True, return_counts=True)
            order = np.argsort(at)
            at, n = at[order], n[order]
            a, e, lang = starts[at], ends[at], lang[at]
            digest = _lang_digests(langs)[lang]
            check = textops.mix(textops.hash_spans(_bytes_order(seed + 1000)[data], a, e) + digest)
            size = e - a
            off = np.concatenate([[0], np.cumsum(size)])
            spelled = data[np.arange(off[-1]) + np.repeat(a - off[:-1], size)]
            words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(off), pa.py_buffer(spelled))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (ids[at], check, digest)] +
                [pa.array(langs, pa.string()).take(pa.array(lang)), words.cast(pa.string()), pa.array(n.astype(np.int64))],
                names=["id", "check", "lang_digest", "lang", "word", "n"])
    return run


_VOCABULARY = "id long, check long, lang_digest long, lang string, word string, n long"


def _suffixes(ids: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digests, places in them): distinct words, 0 (no word) first, and a (4, n) array
    of the words from every position on within its piece."""
    known, rank = np.unique(ids, return_inverse=True)
    rank = (rank + 1).astype(np.uint32)
    out = np.zeros((LONGEST, len(ids)), np.uint32)
    out[0] = rank
    for k in range(1, LONGEST):
        out[k, :-k] = np.where(piece[k:] == piece[:-k], rank[k:], 0)
    return np.concatenate([np.zeros(1, np.uint64), known]), out


def _folded(w: np.ndarray) -> np.ndarray:
    """One digest of the words of each column."""
    out = np.zeros(w.shape[1], np.uint64)
    for row in w:
        out = textops.mix(out * np.uint64(0x9E3779B97F4A7C15) + row)
    return out


class Heavy:
    """Heavy prefixes by length, as sorted rows of word digests."""

    def __init__(self) -> None:
        self.rows: list[np.ndarray] = []

    def add(self, prefixes: list[tuple]) -> None:
        """Rows of word digests, all of the next length."""
        w = np.array(prefixes, np.int64).view(np.uint64).reshape(len(prefixes), len(self.rows) + 1).T
        order = np.argsort(_folded(w), kind="stable")
        self.rows.append(w[:, order])

    def holds(self, w: np.ndarray, depth: int) -> np.ndarray:
        """Whether the first ``depth`` words of each column of w are a heavy prefix."""
        if depth > len(self.rows) or not self.rows[depth - 1].size:
            return np.zeros(w.shape[1], bool)
        known = self.rows[depth - 1]
        keys, asked = _folded(known), _folded(w[:depth])
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return (known[:, at] == w[:depth]).all(axis=0)

    def heavy_at(self, known: np.ndarray, rank: np.ndarray, depth: int) -> np.ndarray:
        """Columns of rank (places in ``known``) whose first ``depth`` words are heavy."""
        at = np.flatnonzero(self.holds(known[None], 1)[rank[0]])
        for d in range(2, depth + 1):
            at = at[self.holds(known[rank[:d, at]], d)]
        return at


def _packed(rank: np.ndarray) -> list[np.ndarray]:
    """Columns of 32-bit places as one or two 64-bit keys."""
    wide = rank.astype(np.uint64)
    return [(wide[k] << np.uint64(32)) | (wide[k + 1] if k + 1 < len(wide) else np.uint64(0))
            for k in range(0, len(wide), 2)]


def _combined(rank: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns, counts, groups) of the distinct columns, by group. Columns are sorted
    by a digest; two that share one may stay apart, which the counts do not mind."""
    keys = _packed(rank)
    bits = np.uint64(groups.bit_length())
    mixed = textops.mix(keys[0] * np.uint64(0x9E3779B97F4A7C15) + (keys[1] if len(keys) > 1 else np.uint64(0)))
    order = np.argsort((group.astype(np.uint64) << (np.uint64(64) - bits)) | (mixed >> bits))
    new = np.ones(len(order), bool)
    new[1:] = False
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    at = np.flatnonzero(new)
    return rank[:, order[at]], np.diff(np.append(at, len(order))), group[order[at]]


def _blocks(known: np.ndarray, rank: np.ndarray, n: np.ndarray, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each group of columns that are sorted by group."""
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    for a, b in zip(cut, np.append(cut[1:], len(group))):
        used, local = np.unique(rank[:, a:b], return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(group[a])], pa.int32()),
             pa.array([_block(known[used], local.reshape(len(rank), -1), n[a:b])], pa.binary())], names=["g", "block"])


def _longer(heavy: Heavy, depth: int, groups: int, seed: int, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each group, a block of prefixes of ``depth`` words that lengthen a heavy one."""
        for ids, piece, *_ in _held(batches, seed, flush):
            known, rank = _suffixes(ids, piece)
            rank = rank[:depth, heavy.heavy_at(known, rank, depth - 1)]
            rank = rank[:, rank[depth - 1] != 0]
            group = (_folded(known[rank]) % np.uint64(groups)).astype(np.uint32)
            yield from _blocks(known, *_combined(rank, group, groups))
    return run


def _heavier(light: int):
    def run(blocks: pa.Table) -> pa.Table:
        """Prefixes of a group counted more than ``light`` times."""
        known, leaf, n = _sorted_leaves(blocks)
        new = np.ones(len(n), bool)
        new[1:] = (leaf[:, 1:] != leaf[:, :-1]).any(axis=0)
        at = np.flatnonzero(new)
        total = np.add.reduceat(n, at)
        at, total = at[total > light], total[total > light]
        return pa.Table.from_arrays([pa.array(known[r].view(np.int64)) for r in leaf[:, at]] + [pa.array(total)],
                                    names=[*IDS[:len(leaf)], "n"])
    return run


def _routed(heavy: Heavy, groups: int, seed: int, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each group, a block of distinct suffixes with counts."""
        for ids, piece, *_ in _held(batches, seed, flush):
            known, rank = _suffixes(ids, piece)
            rank = rank[:, rank[1] != 0]
            group = (_folded(known[None]) % np.uint64(groups)).astype(np.uint32)[rank[0]]
            kept = np.ones(len(group), bool)
            for depth in range(2, LONGEST + 1):
                beyond = heavy.heavy_at(known, rank, depth - 1)
                group[beyond] = (_folded(known[rank[:depth, beyond]]) % np.uint64(groups)).astype(np.uint32)
                # a suffix that ends at a heavy prefix is counted with the prefix
                kept[beyond[rank[depth - 1, beyond] == 0]] = False
            yield from _blocks(known, *_combined(rank[:, kept], group[kept], groups))
    return run


def _block(known: np.ndarray, rank: np.ndarray, n: np.ndarray) -> bytes:
    """A block of suffixes: sizes, digests of its words, places in them, counts."""
    small = np.uint16 if len(known) < 1 << 16 else np.uint32
    counts = n.astype(np.uint8 if n.max() < 256 else np.int64)
    raw = b"".join([np.array([len(known), *rank.shape, small().itemsize, counts.itemsize], np.int64).tobytes(),
                    known.tobytes(), rank.astype(small).tobytes(), counts.tobytes()])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _opened(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests, (words, n) places in them, and counts."""
    raw = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    known, words, n, wide, deep = np.frombuffer(raw, np.int64, 5)
    at = 40 + 8 * known
    rank = np.frombuffer(raw, {2: np.uint16, 4: np.uint32}[int(wide)], words * n, at)
    counts = np.frombuffer(raw, {1: np.uint8, 8: np.int64}[int(deep)], n, at + words * n * wide)
    return np.frombuffer(raw, np.uint64, known, 40), rank.reshape(words, n), counts.astype(np.int64)


def _sorted_leaves(blocks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests, and the columns of all blocks in order (0, no word, first) with counts."""
    opened = [_opened(b) for b in blocks.column("block").to_pylist()]
    known = np.unique(np.concatenate([np.zeros(1, np.uint64), *[x[0] for x in opened]]))
    leaf = np.concatenate([np.searchsorted(known, x[0]).astype(np.uint32)[x[1]] for x in opened], axis=1)
    n = np.concatenate([x[2] for x in opened])
    del opened
    order = np.lexsort(_packed(leaf)[::-1])
    return known, leaf[:, order], n[order]


_NODE = ", ".join(f"{i} long" for i in IDS) + ", a long"


def _subtree(heavy: Heavy, least: int):
    def run(blocks: pa.Table) -> pa.Table:
        """Nodes of the group's subtree counted ``least`` times or more, deeper than one word."""
        known, leaf, n = _sorted_leaves(blocks)
        out = []
        new = np.zeros(len(n), bool)
        new[:1] = True
        new[1:] = leaf[0, 1:] != leaf[0, :-1]
        for depth in range(2, LONGEST + 1):
            new[1:] |= leaf[depth - 1, 1:] != leaf[depth - 1, :-1]
            at = np.flatnonzero(new)
            total = np.add.reduceat(n, at)
            # a leaf that ends before this depth is no node of it
            kept = (total >= least) & (leaf[depth - 1, at] != 0)
            at, total = at[kept], total[kept]
            node = np.zeros((LONGEST, len(at)), np.uint64)
            node[:depth] = known[leaf[:depth, at]]
            # a heavy prefix has suffixes in other groups: it is counted already
            kept = ~heavy.holds(node, depth) if depth < LONGEST else np.ones(len(total), bool)
            out.append((node[:, kept], total[kept]))
        node = np.concatenate([x[0] for x in out], axis=1)
        return pa.Table.from_arrays([pa.array(x.view(np.int64)) for x in node] +
                                    [pa.array(np.concatenate([x[1] for x in out]))], names=[*IDS, "a"])
    return run


def _counted(texts: DataFrame, seed: int, least: int, light: int, group: int,
             flush: int) -> tuple[DataFrame, ...] | None:
    """(vocabulary, words, phrases): words with digests per task, counts of words and
    of phrases (2 words or more) seen ``least`` times; None if two words share a digest."""
    vocabulary = written(texts.mapInArrow(_vocabulary(seed, flush), _VOCABULARY), "vocabulary")
    words = written(vocabulary.groupBy("id").agg(
        F.sum("n").alias("n"), F.min("lang_digest").alias("lang_digest"),
        (F.min("check") != F.max("check")).alias("clash")), "words")
    total = words.agg(F.sum("n").alias("n"), F.max("clash").alias("clash")).first()
    if total["clash"]:
        return None
    groups = max(1, -(-2 * (total["n"] or 0) // group))
    heavy, found = Heavy(), []
    def above(depth: int) -> DataFrame:
        if depth == 1:
            return words.where(F.col("n") > light).select(F.col("id").alias("i1"), "n")
        return (texts.mapInArrow(_longer(heavy, depth, groups, seed, flush), "g int, block binary").groupBy("g")
                .applyInArrow(_heavier(light), ", ".join(f"{i} long" for i in [*IDS[:depth], "n"])))

    for depth in range(1, LONGEST):
        rows = above(depth).limit(HEAVY_ROWS + 1).collect()
        while len(rows) > HEAVY_ROWS:
            light *= 2
            rows = above(depth).limit(HEAVY_ROWS + 1).collect()
        heavy.add([tuple(r)[:depth] for r in rows])
        if not rows:
            break
        if depth > 1:
            found += [(*tuple(r)[:depth], *[0] * (LONGEST - depth), r["n"]) for r in rows if r["n"] >= least]
    blocks = texts.mapInArrow(_routed(heavy, groups, seed, flush), "g int, block binary")
    nodes = blocks.groupBy("g").applyInArrow(_subtree(heavy, least), _NODE)
    if found:
        nodes = nodes.unionByName(texts.sparkSession.createDataFrame(found, _NODE))
    return vocabulary, words.where(F.col("n") >= least), written(nodes, "phrases")


def _scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases with lang_digest and their lowest-scoring cut (l, r, score)."""
    parts = ["p1", "p2", "p3"]
    nothing = F.lit(0).cast("long")
    known = words.select(F.col("id").alias("p1"), nothing.alias("p2"), nothing.alias("p3"), "n", "lang_digest")
    known = known.unionByName(phrases.where("i4 = 0").select(
        F.col("i1").alias("p1"), F.col("i2").alias("p2"), F.col("i3").alias("p3"), F.col("a").alias("n"),
        F.lit(None).cast("long").alias("lang_digest")))
    size = sum((F.col(i) != 0).cast("int") for i in IDS)
    cuts = (phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
            .withColumn("ids", F.array(*IDS, nothing, nothing))
            .withColumn("left", F.concat(F.slice("ids", F.lit(1), F.col("k")), F.array(nothing, nothing)))
            .withColumn("right", F.slice("ids", F.col("k") + 1, F.lit(3)))
            .select(*IDS, "a", "k", *[F.col("left")[j].alias(p) for j, p in enumerate(parts)],
                    *[F.col("right")[j].alias(f"r{p}") for j, p in enumerate(parts)]))
    cuts = (cuts.join(known.withColumnRenamed("n", "l"), parts)
            .drop(*parts).withColumnsRenamed({f"r{p}": p for p in parts})
            .join(known.select(*parts, F.col("n").alias("r")), parts))
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) "
                   "div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    return (cuts.select(*IDS, "a", "lang_digest", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
            .groupBy(*IDS, "a").agg(F.max("lang_digest").alias("lang_digest"), F.min("cut").alias("cut"))
            .select(*IDS, "a", "lang_digest", "cut.score", "cut.l", "cut.r"))


def _not_inside(scored: DataFrame, phrases: DataFrame) -> DataFrame:
    """Scored phrases that no longer one of ``phrases`` replaces."""
    spans = [(s, n) for n in (2, 3) for s in range(LONGEST - n + 1)]

    def sub(s: int, n: int):
        ids = [F.col(IDS[s + k]) for k in range(n)] + [F.lit(0).cast("long")] * (LONGEST - n)
        whole = F.col(IDS[s + n - 1]) != 0
        return F.when(whole if n == 2 else whole & (F.col("i4") != 0),
                      F.struct(*[x.alias(i) for x, i in zip(ids, IDS)]))

    inside = (phrases.where("i3 != 0").select("a", F.explode(F.array(*[sub(*x) for x in spans])).alias("s"))
              .where("s is not null").groupBy(*[F.col(f"s.{i}").alias(i) for i in IDS])
              .agg(F.max("a").alias("most")))
    wide = "decimal(22,0)"
    replaced = (F.lit(100).cast(wide) * F.col("most").cast("decimal(20,0)")
                >= F.lit(INSIDE_PERCENT).cast(wide) * F.col("a").cast("decimal(20,0)"))
    return (scored.join(inside, IDS, "left").where(F.col("most").isNull() | ~replaced)
            .select(scored.columns))


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, light: int = LIGHT,
                 group: int = GROUP, flush: int = FLUSH) -> DataFrame:
    """Each lang's first ``top`` phrases of ``docs`` (text, lang): lang, rank, phrase,
    a, l, r, n, score."""
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    seed, counted = 0, None
    while counted is None:
        counted = _counted(texts, seed, least, light, group, flush)
        seed += 1
    vocabulary, words, phrases = counted
    kept = _not_inside(_scored(words, phrases), phrases)
    best = Window.partitionBy("lang_digest").orderBy(F.desc("score"), F.desc("a"))
    first = written(kept.withColumn("place", F.rank().over(best)).where(F.col("place") <= top)
                    .drop("place"), "first")  # with all ties at the end
    langs = vocabulary.groupBy("lang_digest", "lang").agg(F.sum("n").alias("n"))
    spelled = first.select(*IDS, F.posexplode(F.array(*IDS)).alias("k", "id")).where("id != 0")
    named = (vocabulary.select("id", "word").join(spelled.select("id").distinct(), "id").distinct())
    phrase = (spelled.join(named, "id").groupBy(*IDS)
              .agg(F.sort_array(F.collect_list(F.struct("k", "word"))).alias("w"))
              .select(*IDS, F.array_join("w.word", " ").alias("phrase")))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (first.join(phrase, IDS).join(langs, "lang_digest")
            .withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE = r"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, d, array_to_string(w[i:i + d - 1], ' ') AS phrase FROM (
      SELECT lang, w, d, unnest(range(1, len(w) - d + 2)) AS i FROM p, range(1, 5) AS x(d) WHERE len(w) >= d)),
f AS (SELECT lang, d, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (SELECT lang, d, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE d >= 2),
k AS (SELECT c.lang, c.d, c.phrase, c.a, k, fl.a AS l, fr.a AS r,
      CAST(2000000::HUGEINT * c.a // (fl.a::HUGEINT + fr.a) AS BIGINT) AS score
      FROM (SELECT *, unnest(range(1, d)) AS k FROM c) c
      JOIN f fl ON fl.lang = c.lang AND fl.phrase = array_to_string(w[1:k], ' ')
      JOIN f fr ON fr.lang = c.lang AND fr.phrase = array_to_string(w[k + 1:], ' ')),
s AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most FROM (
      SELECT lang, w, a, m, unnest(range(1, d - m + 2)) AS i FROM c, range(2, 4) AS y(m) WHERE m < d) GROUP BY ALL),
e AS (SELECT s.* FROM s LEFT JOIN i USING (lang, phrase)
      WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM e JOIN n USING (lang) QUALIFY rank <= 2000"""
