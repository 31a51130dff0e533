"""Language-model scoring (operator 10): a log-bilinear neural model trained in
numpy with noise-contrastive estimation.

1. Counts: words of all training texts, counted per task and summed by Spark.
2. Vocabulary: the ``MODEL_WORDS`` commonest words and the end of a text are model
   words of their own; every other word, seen or not, belongs to one of ``SHAPES``
   groups by its last letters, so each word of the corpus is in the model as target
   and as context. A group's mass is the count of all its words, and a word's share
   of it is its own count, so what is gathered grows with the corpus.
3. Training: texts are encoded once and dealt by their content over ``ROUNDS``
   slices. In a round every task sums the gradients of its tokens of the slice at
   the same parameters and against the same noise words; Spark adds the sums, and one
   step (Adagrad) is taken. All training tokens are learned from, and the result
   does not depend on how the table is split.
4. Scoring: the score of word w after u, v is (c1*R[v] + c2*R[u]).T[w] + b[w],
   normalised over the whole model. exp of a sum is a product of exps, so one
   matrix product of the two contexts' tables gives the normalisers of all
   context pairs; it is made once and sent to the tasks (4 bytes a pair).
   The ``KNOWN_WORDS`` commonest counts go to the tasks (5 MB at most); counts
   of rarer words are joined by Spark, at most one row per text and word.

Words are kept as 64-bit hashes. Defined results: null and empty texts have the
end token alone; every input row gives one output row (repeated rows too); rows
without doc_id are learned from and not held out; words of equal count are taken in
order of their hash; an empty table gives an empty result, and without training rows
N and V are 0 and the model is uniform; texts of any length are read whole; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import bounded_batches, crc_mod, written

MODEL_WORDS, SHAPES, KNOWN_WORDS, DIM = 1024, 1024, 1 << 18, 16
NOISE, NOISE_DRAWN, ROUNDS, RATE, BATCH = 8, 96, 40, 0.15, 1 << 13
END_HASH = 0x1F3D5B79A2C4E680
#: Model indices: groups of words by shape, the end of a text, model words.
END = SHAPES
HELD_COUNTS = 1_000_000


_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"]] = True


def word_stream(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of all lower-cased words with one end per text, and the
    texts' starts. A shape is the last three bytes before closing marks."""
    data = T.LOWER[data]
    starts, ends, first = T.words(data, off)
    h = T.hash_spans(data, starts, ends)
    last = ends.copy()
    for _ in range(3):
        last -= (last - starts > 1) & _ENDS[data[last - 1]]
    code = np.zeros(len(h), np.uint64)
    for k in (1, 2, 3):
        at = np.maximum(last - k, starts)
        code = code * np.uint64(257) + np.where(last - k >= starts, data[at].astype(np.uint64) + np.uint64(1), np.uint64(0))
    shape = (T.mix(code) % np.uint64(SHAPES)).astype(np.int64)
    return (np.insert(h, first[1:], np.uint64(END_HASH)), np.insert(shape, first[1:], 0),
            first + np.arange(len(first)))


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, shape, c): every word's count, the end of a text among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            h, shape, c = (np.concatenate(x) for x in zip(*held))
            key, at, where = np.unique(h, return_index=True, return_inverse=True)
            return key, shape[at], np.bincount(where, c, len(key)).astype(np.int64)

        for batch in batches:
            for _, data, off in T.pieces(batch, "text"):
                h, shape, _ = word_stream(data, off)
                key, at, count = np.unique(h, return_index=True, return_counts=True)
                held.append((key, shape[at], count))
                size += len(key)
                if size > HELD_COUNTS:
                    held = [out()]
                    size = len(held[0][0])
                    if size > HELD_COUNTS // 2:
                        yield _count_batch(*held[0])
                        held, size = [], 0
        if held:
            yield _count_batch(*out())

    return (docs.select("text").mapInArrow(run, "h long, shape int, c long")
            .groupBy("h").agg(F.max("shape").alias("shape"), F.sum("c").alias("c")))


def _count_batch(key, shape, count):
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(shape.astype(np.int32)),
                                       pa.array(count, pa.int64())], ["h", "shape", "c"])


class Vocabulary:
    """The commonest words: hashes ascending, counts, and their model index; and the
    words and tokens of every shape (``shapes``: shape -> (tokens, words), all but the end)."""

    def __init__(self, top: list[tuple[int, int, int]], shapes: dict[int, tuple[int, int]], n: int, v: int,
                 end_count: int):
        self.n, self.v = n, v
        end = int(np.uint64(END_HASH).view(np.int64))
        words = [x for x in top if x[0] != end]
        model = words[:MODEL_WORDS - 1]
        pairs = [(end, 0, end_count), *words]
        h = np.array([p[0] for p in pairs], np.int64).view(np.uint64)
        index = np.array([END, *range(END + 1, END + 1 + len(model)), *[p[1] for p in words[len(model):]]], np.uint16)
        order = np.argsort(h)
        self.hash, self.index = h[order], index[order]
        self.count = np.array([p[2] for p in pairs], np.int64)[order]
        self.size = END + 1 + len(model)
        rest = np.zeros((2, SHAPES))
        for shape, both in shapes.items():
            rest[:, shape] = both
        for _, shape, c in model:
            rest[:, shape] -= (c, 1)
        # a group stands for its words and for one word not seen
        mass = rest[0] + 0.1 * (rest[1] + 1)
        self.log_mass = np.concatenate([np.log10(mass), np.zeros(self.size - SHAPES)])
        self.unigram = np.concatenate([mass, [end_count + 0.1], [c + 0.1 for _, _, c in model]])
        self.unigram /= self.unigram.sum()

    def find(self, h: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(model index, count, whether the count is known here)."""
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        known = self.hash[at] == h
        return np.where(known, self.index[at], shape).astype(np.int64), np.where(known, self.count[at], 0), known


def contexts(index: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before and the one before that; the end stands before a text."""
    one, two = np.roll(index, 1), np.roll(index, 2)
    one[first[:-1]] = END
    two[first[:-1]] = END
    second = first[:-1][np.diff(first) > 1] + 1
    two[second] = END
    return one, two


def initial(vocab: Vocabulary) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(3)
    shape = (vocab.size, DIM)
    return {"R": rng.normal(0, 0.3, shape).astype(np.float32),
            "T": rng.normal(0, 0.05, shape).astype(np.float32),
            "b": np.log(vocab.unigram).astype(np.float32),
            "c": np.ones((2, DIM), np.float32) * np.float32([[1.0], [0.6]])}


def _scatter(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(at.astype(np.uint16), kind="stable")
    key = at[order]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    to[key[cut]] += np.add.reduceat(rows[order], cut)


def _encoded(docs: DataFrame, shared) -> DataFrame:
    """(slice, ids): model indices of all texts, each with its end, by slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = shared.value
        for batch in batches:
            for rows, data, off in T.pieces(batch, "text"):
                h, shape, first = word_stream(data, off)
                index = voc.find(h, shape)[0].astype(np.uint16)
                ids = np.array([x or 0 for x in rows.column("doc_id").cast(pa.int64()).to_pylist()], np.int64)
                sums = np.add.reduceat(h, first[:-1]) if len(ids) else h
                part = (T.mix(T.mix(ids.view(np.uint64)) + sums) % np.uint64(ROUNDS)).astype(np.int64)
                of = part[T.owner(first)]
                order = np.argsort(of, kind="stable")
                cut = np.searchsorted(of[order], np.arange(ROUNDS + 1))
                used = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)),
                     pa.array([index[order[cut[k]:cut[k + 1]]].tobytes() for k in used], pa.binary())], ["slice", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "slice int, ids binary")


def gradients(p: dict[str, np.ndarray], log_noise: np.ndarray, drawn: np.ndarray, w, one, two) -> dict[str, np.ndarray]:
    """Sums of the noise-contrastive gradients of tokens w after one, two."""
    R, Tm, b, c = (p[k] for k in "RTbc")
    r1, r2, tw, tn = R[one], R[two], Tm[w], Tm[drawn]
    h = r1 * c[0] + r2 * c[1]
    real = np.einsum("ij,ij->i", h, tw) + b[w] - log_noise[w]
    fake = h @ tn.T
    fake += b[drawn] - log_noise[drawn]
    g = -1.0 / (1.0 + np.exp(np.clip(real, -30, 30)))
    np.clip(fake, -30, 30, out=fake)
    np.negative(fake, out=fake)
    np.exp(fake, out=fake)
    fake += 1
    gn = np.float32(NOISE / len(drawn)) / fake
    dh = g[:, None] * tw + gn @ tn
    grad = {k: np.zeros(v.shape, np.float32) for k, v in p.items()}
    _scatter(grad["T"], w, g[:, None] * h)
    np.add.at(grad["T"], drawn, gn.T @ h)
    grad["b"] += np.bincount(w, g, len(b)).astype(np.float32)
    np.add.at(grad["b"], drawn, gn.sum(0))
    _scatter(grad["R"], one, dh * c[0])
    _scatter(grad["R"], two, dh * c[1])
    grad["c"][0], grad["c"][1] = (dh * r1).sum(0), (dh * r2).sum(0)
    return grad


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in "RTbc"])


def _shaped(x: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in "RTbc":
        n = like[k].size
        out[k] = x[at:at + n].reshape(like[k].shape)
        at += n
    return out


def _added(blocks: pa.Table) -> pa.Table:
    """The sum of the vectors of a group, in order of their tasks."""
    rows = sorted(zip(blocks.column("task").to_pylist(), blocks.column("sum").to_pylist()))
    total = np.zeros(len(rows[0][1]) // 8)
    for _, x in rows:
        total += np.frombuffer(x)
    return pa.Table.from_arrays([pa.array([rows[0][0]], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                names=["task", "sum"])


def step(p: dict[str, np.ndarray], squares: dict[str, np.ndarray], grad: dict[str, np.ndarray]) -> None:
    """One step of all parameters (Adagrad)."""
    for k, g in grad.items():
        squares[k] += g * g
        p[k] = p[k] - np.float32(RATE) * g / np.sqrt(squares[k])


def train(docs: DataFrame, vocab: Vocabulary) -> dict[str, np.ndarray]:
    """Parameters after ``ROUNDS`` steps over all tokens of ``docs``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    table = sc.broadcast(vocab)  # KNOWN_WORDS and MODEL_WORDS bound it
    encoded = written(_encoded(docs, table), "lm-encoded")
    p = initial(vocab)
    squares = {k: np.full(v.shape, 1e-2, np.float32) for k, v in p.items()}
    log_noise = np.log(NOISE * vocab.unigram).astype(np.float32)
    cumulative, rng = np.cumsum(vocab.unigram), np.random.default_rng(11)
    kind = "task long, sum binary"

    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            params, noise, drawn = shared.value
            total, seen = np.zeros(sum(v.size for v in params.values())), 0
            for batch in batches:
                for raw in batch.column("ids").to_pylist():
                    index = np.frombuffer(raw, np.uint16).astype(np.int64)
                    first = np.concatenate([[0], np.flatnonzero(index == END) + 1])
                    one, two = contexts(index, first)
                    for k in range(0, len(index), BATCH):
                        cut = slice(k, k + BATCH)
                        total += _flat(gradients(params, noise, drawn, index[cut], one[cut], two[cut]))
                    seen += len(index)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int64()),
                     pa.array([np.append(total, seen).tobytes()], pa.binary())], ["task", "sum"])
        return run

    for r in range(ROUNDS):
        drawn = np.minimum(np.searchsorted(cumulative, rng.random(NOISE_DRAWN)), vocab.size - 1)
        shared = sc.broadcast((p, log_noise, drawn))
        sums = (encoded.where(F.col("slice") == r).select("ids").mapInArrow(run_with(shared), kind)
                .withColumn("g", F.col("task") % 256).groupBy("g").applyInArrow(_added, kind)
                .withColumn("g", F.col("task") * 0).groupBy("g").applyInArrow(_added, kind)
                .collect())  # 256 vectors in the last step, one row here
        if sums:
            total = np.frombuffer(sums[0]["sum"])
            step(p, squares, _shaped((total[:-1] / total[-1] ** 0.5).astype(np.float32), p))
        shared.unpersist()
    return p


def normalisers(p: dict[str, np.ndarray]) -> np.ndarray:
    """Log of the sum of exp(score) over the model, for all [word before, the one before]."""
    one, two = _tables(p)
    m1, m2 = one.max(1, keepdims=True), two.max(1, keepdims=True)
    total = np.exp(one - m1) @ np.exp(two - m2).T
    return (np.log(np.maximum(total, 1e-30)) + m1 + m2.T).astype(np.float32)


def _tables(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return (p["R"] * p["c"][0]) @ p["T"].T + p["b"], (p["R"] * p["c"][1]) @ p["T"].T


class Scorer:
    """Log-probabilities (log10) from the two contexts' tables and the normalisers."""

    def __init__(self, p: dict[str, np.ndarray], norm: np.ndarray):
        self.one, self.two = _tables(p)     # [word before, word], [the one before, word]
        self.norm = norm

    def log10(self, w, one, two) -> np.ndarray:
        return (self.one[one, w].astype(np.float64) + self.two[two, w]
                - self.norm[one, two]) / np.log(10.0)


def commonest(counts: DataFrame, most: int) -> DataFrame:
    """The words of at least the smallest count that at most ``most`` words reach."""
    by_count = counts.groupBy("c").agg(F.count("*").alias("n"))  # one row per count
    over = Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0)
    least = (by_count.withColumn("upto", F.sum("n").over(over)).where(F.col("upto") <= most)
             .agg(F.min("c").alias("c")).collect()[0]["c"])
    return counts.where(F.col("c") >= F.lit(least)) if least is not None else counts.limit(0)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The vocabulary of written counts (h, shape, c)."""
    end = int(np.uint64(END_HASH).view(np.int64))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                       F.coalesce(F.max(F.when(F.col("h") == end, F.col("c"))), F.lit(0)).alias("e")
                       ).collect()[0]
    top = commonest(counts, KNOWN_WORDS).toPandas().sort_values(["c", "h"], ascending=[False, True])
    shapes = {r["shape"]: (r["tokens"], r["words"]) for r in counts.where(F.col("h") != end).groupBy("shape").agg(
        F.sum("c").alias("tokens"), F.count("*").alias("words")).collect()}  # SHAPES rows
    return Vocabulary(list(zip(top["h"].tolist(), top["shape"].tolist(), top["c"].tolist())), shapes,
                      total["n"], total["v"], total["e"])


def score_texts(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    counts = written(word_counts(training), "lm-counts")
    vocab = vocabulary(counts)
    params = train(training, vocab)
    shared = spark.sparkContext.broadcast((vocab, params, normalisers(params)))
    lowest = float(np.log10(0.1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, p, norm = shared.value
        scorer, task, done = Scorer(p, norm), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, data, off in T.pieces(batch, "text"):
                h, shape, first = word_stream(data, off)
                index, count, known = voc.find(h, shape)
                one, two = contexts(index, first)
                logc = np.log10(count + 0.1)
                m = len(rows)
                row = (task << 36) + done + np.arange(m)
                done += m
                owner = T.owner(first)
                base = np.bincount(owner, np.where(known, logc, 0.0), m)
                # a group's probability is shared by count
                model = np.bincount(owner, scorer.log10(index, one, two) - voc.log_mass[index]
                                    + np.where((index < END) & known, logc, 0.0), m)
                rare = ~known
                pair, where = _pairs(owner[rare], h[rare])
                k = len(pair[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([row, row[pair[0]]])),
                     pa.array(np.concatenate([np.zeros(m, np.int64), pair[1].view(np.int64)]),
                              mask=np.arange(m + k) < m),
                     pa.concat_arrays([rows.column("doc_id").cast(pa.int64()), pa.nulls(k, pa.int64())]),
                     pa.array(np.concatenate([np.diff(first), np.zeros(k, np.int64)])),
                     pa.array(np.concatenate([np.bincount(owner, known & (count > 0), m).astype(np.int64),
                                              where])),
                     pa.array(np.concatenate([base, np.zeros(k)])),
                     pa.array(np.concatenate([model, np.zeros(k)]))],
                    ["row", "h", "doc_id", "n_tokens", "n", "base", "model"])

    parts = docs.select("doc_id", "text").mapInArrow(
        run, "row long, h long, doc_id long, n_tokens long, n long, base double, model double")
    parts = written(parts, "lm-parts")
    # rows of texts, and rows of rare words with their counts, meet in one sum by text
    rare = (parts.where("h is not null").select("row", "h", "n")
            .join(counts, "h", "left")
            .select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_tokens"),
                    F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"),
                    (F.col("n") * F.when(F.col("c") > 0, F.log10(F.col("c") + 0.1)).otherwise(lowest)
                     ).alias("base"))
            .withColumn("model", F.col("base")))
    texts = parts.where("h is null").select("row", "doc_id", "n_tokens", F.col("n").alias("n_known"),
                                            "base", "model")
    n, v = int(vocab.n), int(vocab.v)
    return (texts.unionByName(rare).groupBy("row")
            .agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
                 F.sum("n_known").alias("n_known"),
                 F.sum("base").alias("base"), F.sum("model").alias("model"))
            .select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("base") - F.col("n_tokens") * float(np.log10(n + 0.1 * (v + 1)))
                     ).alias("base_score"),
                    F.col("model").alias("score")))


def _pairs(owner: np.ndarray, h: np.ndarray):
    """Distinct (text, word) pairs and how often each occurs."""
    order = np.lexsort((h, owner))
    o, w = owner[order], h[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (w[1:] != w[:-1])
    at = np.flatnonzero(new)
    return (o[at], w[at]), np.diff(np.append(at, len(o))).astype(np.int64)


def score_documents(docs: DataFrame) -> DataFrame:
    """Score all rows, learning from those whose crc32(doc_id) mod 10 is not 0."""
    scored = score_texts(docs, docs.where(F.coalesce(crc_mod("doc_id", 10), F.lit(1)) != 0))
    held_out = F.coalesce(crc_mod("doc_id", 10) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens",
                         "n_known", "train_tokens", "base_score", "score")
