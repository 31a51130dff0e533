"""Conversation prefix trie by fixed-length block hashing (operator 13).

Conversations are numbered, rebuilt, and cut into blocks of ``BLOCK`` turns. A
turn's digest holds its place, role and text (128 bits), and a block's is the
exclusive-or of its turns', so a prefix's digest is a running exclusive-or.
Conversations are grouped by successive block digests first; a group goes on with
one representative and its member count. Turn boundaries are looked at only inside
blocks whose siblings (blocks after the same prefix) diverge; inside other blocks
the representative's turns are the nodes.

Nodes with one smallest member c lie on one path, so sums over a subtree are a
running sum along the path, plus, at each node, the totals of the paths that leave
the trie below it, which are sent to the prefixes of c above its path.

Nothing is gathered by conversation, node or group of copies: turns are numbered by
a range sort with one carry a partition, running values go by chunks of ``CHUNK``
rows, and the ids that end at a node are joined in chunks and hashed as a stream.

Defined results: rows without conv_id belong to no conversation; turns of equal
number are ordered by role, then by the MD5 of the text; repeated rows are repeated
turns; null role and text are empty; equal (role, text) sequences are one node
whatever their turn numbers; an empty table has no node, not even the root. Texts of
any length count whole, and only their digests are shuffled. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, written

#: Turns a block.
BLOCK = 8
#: Rows of one key that a running value is taken over at once.
CHUNK = 4096
#: Most original turns that a rebuilt conversation takes from another one, plus one.
SHARED = 6
#: Ids joined to one string at once.
IDS = 1 << 16
KEY = ["depth", "x", "y"]


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the sorted rows of each conversation within this partition, from 1."""
    last, count = None, 0
    for b in batches:
        c = b.column("c").to_numpy()
        n = len(c)
        if not n:
            continue
        first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n))) + 1
        if last is not None and c[0] == last:
            upto = first[1] if len(first) > 1 else n
            place[:upto] += count
        last, count = c[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays(
            [*[b.column(k) for k in ("part", "c")], pa.array(place, pa.int64()),
             *[b.column(k) for k in ("hx", "hy", "chars")]],
            names=["part", "c", "place", "hx", "hy", "chars"])


def numbered(conversations: DataFrame) -> DataFrame:
    """(c, pos, hx, hy, chars): every turn with its place in its conversation (from
    1), two digests of role and text, and its code points."""
    role, text = (F.coalesce(F.col(k), F.lit("")) for k in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"),
        F.unhex(F.md5(text.cast("binary"))).alias("tie"), F.xxhash64(role, text).alias("hx"),
        F.xxhash64(text, F.lit("turn"), role).alias("hy"), F.length(text).cast("long").alias("chars"))
    order = ["c", F.col("turn").asc_nulls_first(), "role", "tie"]
    local = written(turns.repartitionByRange(*order).sortWithinPartitions(*order)
                    .select(F.spark_partition_id().alias("part"), "c", "hx", "hy", "chars")
                    .mapInArrow(_places, "part int, c long, place long, hx long, hy long, chars long"), "turns")
    # a conversation may go on over several partitions: one carry for each partition's first
    ends = local.groupBy("part").agg(F.min("c").alias("first"), F.max(F.struct("c", "place")).alias("last"))
    seen = (ends.select("part", F.col("last.c").alias("c"), F.col("last.place").alias("n"))
            .unionByName(ends.where("first < last.c").select("part", F.col("first").alias("c"),
                                                             F.lit(0).cast("long").alias("n"))))
    upto = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = seen.select("part", "c", F.sum("n").over(upto).alias("before")).where("before > 0")
    return local.join(F.broadcast(carry), ["part", "c"], "left").select(
        "c", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "hx", "hy", "chars")


def _conversations(turns: DataFrame) -> DataFrame:
    """(c, h, base, m, length): what each rebuilt conversation is made of."""
    own = turns.groupBy("c").agg(F.max("pos").alias("n")).select(
        "c", "n", (F.crc32(F.col("c").cast("string")) % SHARED).alias("h"),
        (F.col("c") - F.col("c") % 100).alias("base"))
    of_base = own.where("c = base").select("base", F.col("n").alias("has"))
    m = F.least("h", F.coalesce("has", F.lit(0)))
    return own.join(of_base, "base", "left").select(
        "c", "h", "base", m.alias("m"), (m + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(c, d, kx, ky, chars, length): turns of the rebuilt conversations; the digests hold the place."""
    own = (turns.join(convs.select("c", "h", "m", "length"), "c").where("pos > h")
           .select("c", (F.col("pos") - F.col("h") + F.col("m")).alias("d"), "hx", "hy", "chars", "length"))
    first = turns.where((F.col("c") % 100 == 0) & (F.col("pos") < SHARED)).withColumnRenamed("c", "base")
    shared = (convs.where("m > 0").select("c", "base", "h", "length").join(first, "base").where("pos <= h")
              .select("c", F.col("pos").alias("d"), "hx", "hy", "chars", "length"))
    return own.unionByName(shared).select(
        "c", "d", F.xxhash64("d", "hx", "hy").alias("kx"), F.xxhash64("hy", "d", "hx").alias("ky"),
        "chars", "length")


def _before(df: DataFrame, key: str, order: Column, total, values: dict[str, str], chunk: int) -> DataFrame:
    """df with, for each column of ``values``, its total over the earlier rows of the
    key (null: none), under the name it maps to; by chunks of the order's values."""
    df = df.withColumn("__o", order).withColumn("__chunk", F.floor(F.col("__o") / chunk))
    inside = Window.partitionBy(key, "__chunk").orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = df.groupBy(key, "__chunk").agg(*[total(v).alias(f"__{v}") for v in values])
    ahead = (chunks.select(key, "__chunk", *[total(f"__{v}").over(across).alias(f"__{v}") for v in values])
             .where(" or ".join(f"__{v} is not null" for v in values)))
    both = (df.select("*", *[total(v).over(inside).alias(name) for v, name in values.items()])
            .join(ahead, [key, "__chunk"], "left"))
    zero = F.lit(0).cast("long")
    mix = (lambda a, b: a.bitwiseXOR(b)) if total is F.bit_xor else (lambda a, b: a + b)
    return both.withColumns({name: mix(F.coalesce(name, zero), F.coalesce(f"__{v}", zero))
                             for v, name in values.items()}).drop("__o", "__chunk", *[f"__{v}" for v in values])


def _blocks(turns: DataFrame, block: int, chunk: int) -> DataFrame:
    """(c, b, length, bx, by, turns, px, py): blocks of at most ``block`` turns, with
    the digest of all before them."""
    cut = turns.groupBy("c", F.floor((F.col("d") - 1) / block).alias("b")).agg(
        F.any_value("length").alias("length"), F.bit_xor("kx").alias("bx"), F.bit_xor("ky").alias("by"),
        F.sort_array(F.collect_list(F.struct("d", "kx", "ky", "chars"))).alias("turns"))
    return _before(cut, "c", F.col("b"), F.bit_xor, {"bx": "px", "by": "py"}, chunk)


def _steps() -> Column:
    """The prefixes that end inside a block: depth, digest, its parent's digest, last text's size."""
    def digest(n: Column, start: str, k: str) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), n), F.col(start), lambda a, t: a.bitwiseXOR(t[k]))
    return F.transform("turns", lambda t, i: F.struct(
        t["d"].alias("depth"), digest(i + 1, "px", "kx").alias("x"), digest(i + 1, "py", "ky").alias("y"),
        digest(i, "px", "kx").alias("ux"), digest(i, "py", "ky").alias("uy"), t["chars"].alias("chars")))


def _nodes(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, x, y, ux, uy, chars, n_convs, conv_id), the root included."""
    first = blocks.groupBy("b", "px", "py", "bx", "by", F.size("turns").alias("n")).agg(
        F.count("*").alias("n_convs"), F.min("c").alias("conv_id"), F.first("turns").alias("turns"))
    classes = written(first, "block-classes")
    # every first block has the root as its parent; others are asked for their siblings
    diverging = (classes.where("b > 0").groupBy("b", "px", "py").agg(F.count("*").alias("k"))
                 .where("k > 1").drop("k").withColumn("apart", F.lit(True)))
    marked = (classes.where("b > 0").join(diverging, ["b", "px", "py"], "left")
              .unionByName(classes.where("b = 0").withColumn("apart", F.lit(True)))
              .select(F.col("apart").isNotNull().alias("apart"), "n_convs", "conv_id",
                      F.explode(_steps()).alias("s")).select("apart", "n_convs", "conv_id", "s.*"))
    refined = marked.where("apart").groupBy(*KEY).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("ux").alias("ux"),
        F.first("uy").alias("uy"), F.first("chars").alias("chars"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("c").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("x"), zero.alias("y"), zero.alias("ux"), zero.alias("uy"),
        zero.alias("chars"), "n_convs", "conv_id")
    return refined.unionByName(marked.where("not apart").drop("apart")).unionByName(root)


def _id_lists(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Join the ids of sorted (key, c) rows, ``most`` at once."""
        for b in batches:
            cols = [b.column(k).to_numpy() for k in (*KEY, "c")]
            if not len(cols[0]):
                continue
            new = np.zeros(len(cols[0]), bool)
            for k in cols[:3]:
                new[1:] |= k[1:] != k[:-1]
            new[0] = True
            starts = np.flatnonzero(new)
            bounds = [(s, min(s + most, e)) for a, e in zip(starts, np.append(starts[1:], len(new)))
                      for s in range(a, e, most)]
            at = np.array([a for a, _ in bounds])
            ids = cols[3].astype(str)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(k[at]) for k in cols],
                 pa.array([",".join(ids[a:e]) for a, e in bounds], pa.string())], names=[*KEY, "c", "ids"])
    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of each key, read as a stream of sorted (key, c, ids)."""
    now, state = None, None
    for b in batches:
        done = []
        for key, ids in zip(zip(*[b.column(k).to_pylist() for k in KEY]), b.column("ids").to_pylist()):
            if key != now:
                if state:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield _digests(done)
    if state:
        yield _digests([(*now, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    d, x, y, sha = zip(*rows)
    return pa.RecordBatch.from_arrays([*[pa.array(v, pa.int64()) for v in (d, x, y)], pa.array(sha, pa.string())],
                                      names=[*KEY, "ends_sha256"])


def _ends(blocks: DataFrame, convs: DataFrame, block: int, ids: int) -> DataFrame:
    """(depth, x, y, ends_sha256) of the nodes at which conversations end."""
    zero = F.lit(0).cast("long")
    at = (blocks.where(F.col("b") == F.floor((F.col("length") - 1) / block))
          .select(F.col("length").alias("depth"), F.col("px").bitwiseXOR(F.col("bx")).alias("x"),
                  F.col("py").bitwiseXOR(F.col("by")).alias("y"), "c")
          .unionByName(convs.where("length = 0").select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "c")))
    lists = at.repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c").mapInArrow(
        _id_lists(ids), "depth long, x long, y long, c long, ids string")
    return lists.repartition(*KEY).sortWithinPartitions(*KEY, "c").mapInArrow(
        _hashed, "depth long, x long, y long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK, chunk: int = CHUNK, ids: int = IDS) -> DataFrame:
    """One row per node of the trie of rebuilt ``conversations`` (conv_id, turn,
    role, text); see the module's text."""
    bounded_batches(conversations.sparkSession)
    turns = numbered(conversations)
    convs = written(_conversations(turns), "conversations")
    blocks = written(_blocks(rebuilt(turns, convs), block, chunk), "blocks")
    nodes = written(_nodes(blocks, convs), "nodes")

    parent = [(F.col("depth") - 1).alias("depth"), F.col("ux").alias("x"), F.col("uy").alias("y")]
    children = (nodes.where("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children")))
    valued = written(nodes.join(children, KEY, "left").select(
        *KEY, "ux", "uy", "n_convs", "conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saves")), "valued")

    # along each path from below; then the totals of the paths to the prefixes above them
    along = _before(valued, "conv_id", -F.col("depth"), F.sum, {"leaf": "leaves", "saves": "saved"}, chunk)
    paths = (valued.groupBy("conv_id").agg(F.min("depth").alias("top"), F.sum("leaf").alias("leaf"),
                                           F.sum("saves").alias("saves")).where("top > 0"))
    zero = F.lit(0).cast("long")
    steps = (blocks.join(paths.where("top > 1").withColumnRenamed("conv_id", "c"), "c")
             .where(F.col("b") * block + 1 < F.col("top"))
             .select("top", "leaf", "saves", F.explode(_steps()).alias("s")).where("s.depth < top")
             .select("s.depth", "s.x", "s.y", "leaf", "saves"))
    above = (steps.unionByName(paths.select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "leaf", "saves"))
             .groupBy(*KEY).agg(F.sum("leaf").alias("more_leaves"), F.sum("saves").alias("more_saved")))

    parents = nodes.select(*[F.col(k).alias(f"u{k}") for k in KEY], F.col("conv_id").alias("parent_conv_id"))
    up = [(F.col("depth") - 1 == F.col("udepth")), F.col("ux") == F.col("px"), F.col("uy") == F.col("py")]
    parents = parents.withColumnRenamed("ux", "px").withColumnRenamed("uy", "py")
    rest = (along.join(above, KEY, "left").join(_ends(blocks, convs, block, ids), KEY, "left"))
    # the root's children may be most of all nodes: its one row goes to every task
    placed = (rest.where("depth > 1").join(parents.where("udepth > 0"), up, "left")
              .unionByName(rest.where("depth <= 1").join(F.broadcast(parents.where("udepth = 0")), up, "left")))
    return placed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf") + F.col("leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saves") + F.col("saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


ORACLE = """
WITH o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      coalesce(role, ''), md5(coalesce(text, ''))) AS pos, coalesce(role, '') AS role,
      coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, count(*) AS n, c - c % 100 AS b, xor(list_reduce(list_concat([4294967295::UBIGINT],
      flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda z: [ord(z)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, z: xor(xor(a, z) >> 1, 3988292384::UBIGINT * (xor(a, z) & 1::UBIGINT))),
      4294967295::UBIGINT)::BIGINT % 6 AS h FROM o GROUP BY c),
l AS (SELECT s.*, least(h, coalesce(z.n, 0)) AS m FROM s LEFT JOIN (SELECT c AS b, n FROM s) z USING (b)),
t AS (SELECT l.c, pos AS d, role, text FROM l JOIN o ON o.c = l.b AND pos <= h
      UNION ALL SELECT l.c, pos - h + m, role, text FROM l JOIN o USING (c) WHERE pos > h),
p AS (SELECT c, d, length(text) AS chars, md5(string_agg(md5(role) || md5(text), '') OVER (
      PARTITION BY c ORDER BY d)) AS k FROM t UNION ALL SELECT c, 0, 0, '' FROM l),
q AS (SELECT c, d, chars, k, lag(k) OVER (PARTITION BY c ORDER BY d) AS u,
      d = max(d) OVER (PARTITION BY c) AS is_end FROM p),
n AS (SELECT d, k, any_value(u) AS u, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
      sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
      FROM q GROUP BY d, k),
ch AS (SELECT d - 1 AS d, u AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (d, k)),
below AS (SELECT q.d, q.k, CAST(sum((v.n_children = 0)::INT) AS BIGINT) AS n_leaves,
      CAST(sum((v.n_convs - 1) * v.chars) AS BIGINT) AS saved_tokens
      FROM v JOIN q ON q.c = v.conv_id AND q.d <= v.d GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves,
       saved_tokens, v.ends_sha256
FROM v JOIN below USING (d, k) LEFT JOIN n up ON up.d = v.d - 1 AND up.k = v.u"""
