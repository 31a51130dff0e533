"""Benchmark decontamination by a broadcast hash set of windows (operator 11),
DataFrame functions only.

Texts are lower-cased (A-Z) and cut into words. The windows of the benchmark
items (10 consecutive words; all words of a shorter item) are a hash set that
every task holds; a scan of the documents' windows looks each up by a hash of some
of its words, verifies a hit by all of them, and only hits are shuffled. The hash set
is broadcast in parts of at most ``PART_BYTES``: a benchmark beyond that is
scanned for in as many passes as it has parts, so nothing is dropped.

Which items a document holds is found per distinct set of windows, not per
document: windows that lie in the same items are one class, documents with the
same classes share one list, so copies and common windows are not multiplied.

Defined results: null and empty texts have no words; an item without words has no
window; rows of ``benchmark`` with one item_id are one item, and a null item_id
counts as the empty string; every document row gives one result row (repeated
rows and equal or null doc_ids too); a window that lies in several items counts
for all of them, and overlapping hits count each word once, so ties do not arise;
an empty ``documents`` gives an empty result, an empty ``benchmark`` no hits.
Texts of any length are scanned whole, in one row. Other columns are not read, and
``decontaminated`` carries them along unchanged, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written, written_small

WORDS = 10
#: Bytes of windows that one broadcast may hold.
PART_BYTES = 64 << 20
#: Bytes a window takes beside its own text in a broadcast hash set.
ROW_BYTES = 120
#: Item lists are joined by broadcast up to this many (100 bytes each).
SMALL_ROWS = 100_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_OTHER_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def words(text: str) -> Column:
    """The words of a text, A-Z lower-cased."""
    whole = F.coalesce(F.col(text), F.lit(""))
    ascii_only = F.length(whole) == F.octet_length(whole)
    low = F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(low, _OTHER + "+"), "")


def _windows(w: Column, n: int, made) -> Column:
    """``made(place from 1, probe)`` of every n consecutive of the words w (null: fewer
    words). The probe is the hash a window is looked up by: of its first and last
    word and two between, so that the scan hashes four words a window instead of ten;
    windows that share a probe are told apart by all their words."""
    at = sorted({0, n // 3, 2 * n // 3, n - 1})
    return F.when(F.size(w) >= n, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))),
        lambda i: made(i, F.xxhash64(*[F.get(w, i - 1 + k) for k in at]))))


def _gram(w: Column, i: Column, n: Column | int) -> Column:
    return F.array_join(F.slice(w, i, n), " ")


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(windows, classes): distinct windows (n, hash, gram, class), where windows of
    the same items have the same class, and (class, item) pairs."""
    def of_item(w):
        n = F.least(F.size(w), F.lit(WORDS))
        return F.coalesce(*[F.when(n == k, _windows(w, k, lambda i, h, k=k: F.struct(
            F.lit(k).alias("n"), h.alias("hash"), _gram(w, i, k).alias("gram")))) for k in range(1, WORDS + 1)])

    pairs = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                              F.explode(_let(words("text"), of_item)).alias("x"))
             .select("item", "x.*").distinct())
    # order-free digests of a window's items: no window's items are ever collected
    windows = written_small(pairs.groupBy("n", "hash", "gram").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("item")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit("second"), "item")).alias("b"))
        .select("n", "hash", "gram", F.concat_ws(":", "c", "a", "b").alias("class")), "windows")
    one = windows.groupBy("class").agg(F.min(F.struct("gram", "n", "hash")).alias("w")).select("class", "w.*")
    return windows, pairs.join(one, ["n", "hash", "gram"]).select("class", "item")


def _parts(windows: DataFrame) -> tuple[int, list[int]]:
    """Into how many broadcasts the windows go, and the window lengths there are (10 at most)."""
    got = windows.agg(F.sum(F.octet_length("gram") + F.octet_length("class") + ROW_BYTES).alias("bytes"),
                      F.sort_array(F.collect_set("n")).alias("lengths")).first()
    return max(1, -(-(got["bytes"] or 0) // PART_BYTES)), got["lengths"]


def _hits(rows: DataFrame, windows: DataFrame, parts: int, lengths: list[int]) -> DataFrame:
    """(row, id, n_words, i, n, class) of every place with a window, from rows (row,
    id, text), plus one line per row with i null."""
    none = F.struct(F.lit(None).cast("int").alias("i"), F.lit(None).cast("int").alias("n"),
                    F.lit(None).cast("long").alias("h"))

    def places(w: Column) -> Column:
        def one(n: int):
            return _windows(w, n, lambda i, h: F.struct(i.alias("i"), F.lit(n).alias("n"), h.alias("h")))
        return F.concat(F.array(none), *[F.coalesce(one(n), F.array()) for n in lengths])

    named = rows.select("row", "id", words("text").alias("w"))
    scanned = (named.select("row", "id", "w", F.explode_outer(_let(F.col("w"), places)).alias("x"))
               .select("row", "id", "w", F.size("w").cast("long").alias("n_words"), "x.*"))
    out = []
    for k in range(parts):
        part = F.broadcast(windows.where(F.pmod("hash", F.lit(parts)) == k)
                           .select(F.col("n").alias("wn"), "hash", "gram", "class"))
        # looked up by the hash alone; what shares it is compared after, so that words
        # are joined to a text only where a window is found
        real = ((F.col("n") == F.col("wn")) & (_gram(F.col("w"), F.col("i"), F.col("n")) == F.col("gram")))
        kept = (F.col("hash").isNotNull() & real) | (F.col("i").isNull() if k == 0 else F.lit(False))
        out.append(scanned.join(part, F.col("h") == F.col("hash"), "left").where(kept)
                   .select("row", "id", "n_words", "i", "n", "class"))
    return reduce(DataFrame.unionByName, out)


def _marked(rows: DataFrame, windows: DataFrame, spans: bool = False) -> DataFrame:
    """Per row: id, n_words, n_hit, its window classes (sorted) and, where asked
    for, its hit spans (first word from 1, last word) without overlaps."""
    parts, lengths = _parts(windows)
    if parts > 1:  # every pass must see the same row numbers
        rows = written(rows, "rows")
    before = Window.partitionBy("row").orderBy(F.col("i").asc_nulls_first(), "n")
    end = F.col("i") + F.col("n") - 1
    hits = (_hits(rows, windows, parts, lengths)
            .withColumn("upto", F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("new", F.greatest(F.lit(0), end - F.greatest(F.col("i") - 1, F.coalesce("upto", F.lit(0))))))
    if spans:
        hits = hits.withColumn("span", F.sum(F.when(F.col("upto").isNull() | (F.col("i") > F.col("upto") + 1), 1)
                                             .otherwise(0)).over(before))
        hits = (hits.groupBy("row", "span").agg(
            F.any_value("id").alias("id"), F.any_value("n_words").alias("n_words"),
            F.sum("new").alias("new"), F.collect_set("class").alias("classes"),
            F.min("i").alias("first"), F.max(end).alias("last")))
        return hits.groupBy("row").agg(
            F.any_value("id").alias("id"), F.any_value("n_words").alias("n_words"),
            F.coalesce(F.sum("new"), F.lit(0)).alias("n_hit"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("classes"),
            F.sort_array(F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", "last")))).alias("spans"))
    return hits.groupBy("row").agg(
        F.any_value("id").alias("id"), F.any_value("n_words").alias("n_words"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("n_hit"), F.sort_array(F.collect_set("class")).alias("classes"))


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), "text")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items_sha256 and
    contaminated."""
    ship(docs.sparkSession)
    windows, classes = benchmark_windows(benchmark)
    marked = written_small(_marked(_numbered(docs), windows).withColumn(
        "set", F.when(F.size("classes") > 0, F.sha2(F.array_join("classes", ",").cast("binary"), 256))), "marked")
    hit = marked.where("set is not null")
    sets = hit.groupBy("set").agg(F.any_value("classes").alias("classes"))
    items = (sets.select("set", F.explode("classes").alias("class")).join(classes, "class").groupBy("set")
             .agg(F.sort_array(F.collect_set("item")).alias("items"))
             .select("set", F.size("items").cast("long").alias("n_items"),
                     F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")))
    head = [F.col("id").alias("doc_id"), "n_words", "n_hit"]
    clean = marked.where("set is null").select(
        *head, F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit("").cast("binary"), 256).alias("items_sha256"))
    if items.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        items = F.broadcast(items)
    return (hit.join(items, "set").select(*head, "n_items", "items_sha256").unionByName(clean)
            .withColumn("contaminated", F.col("n_hit") > 0))


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "spans") -> DataFrame:
    """``docs`` without its contaminated rows (``remove="documents"``), or with hit
    words and what separates each from the next word cut out of their texts
    (``"spans"``); other rows and all other columns stay as they are."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    ship(docs.sparkSession)
    windows, _ = benchmark_windows(benchmark)
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "docs")
    marked = (_marked(rows.select("row", F.lit(None).cast("int").alias("id"), F.col("doc.text").alias("text")),
                      windows, spans=True).where("n_hit > 0").select("row", "spans"))
    if remove == "documents":
        return rows.join(marked, "row", "left_anti").select("doc.*")

    def without(x: Column) -> Column:
        # x: lead (before the first word), token array (word and what follows it)
        gaps = F.transform(F.sequence(F.lit(0), F.size("spans")), lambda k: F.struct(
            F.when(k == 0, 1).otherwise(F.col("spans")[k - 1]["last"] + 1).alias("from"),
            F.when(k == F.size("spans"), F.size(x["tokens"]) + 1).otherwise(
                F.col("spans")[F.least(k, F.size("spans") - 1)]["first"]).alias("to")))
        kept = F.flatten(F.transform(gaps, lambda g: F.slice(
            x["tokens"], g["from"].cast("int"), F.greatest(g["to"] - g["from"], F.lit(0)).cast("int"))))
        return F.concat(x["lead"], F.array_join(kept, ""))

    text = F.col("doc.text")
    # cut before every word that follows another character: lead or word + separators
    bits = F.split(text, f"(?<={_OTHER_ANY_CASE})(?!{_OTHER_ANY_CASE})(?=[\\s\\S])")
    shaped = _let(bits, lambda b: F.when(b[0].rlike(f"^{_OTHER_ANY_CASE}"), F.struct(
        b[0].alias("lead"), F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0))).alias("tokens"))).otherwise(
        F.struct(F.lit("").alias("lead"), b.alias("tokens"))))
    cut = F.when(F.col("spans").isNull(), text).otherwise(_let(shaped, without))
    return rows.join(marked, "row", "left").select(
        *[(cut if c == "text" else F.col("doc")[c]).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (
      SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
      FROM b WHERE len(w) > 0)),
h AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (
      SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
      FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
m AS (SELECT rid, i, n, item FROM h JOIN g USING (n, gram)),
p AS (SELECT rid, count(*) AS c FROM (
      SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
t AS (SELECT rid, count(*) AS c, string_agg(item, ',' ORDER BY item) AS s
      FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(p.c, 0) AS n_hit, coalesce(t.c, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(p.c, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid)"""
