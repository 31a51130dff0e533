"""Mixing sources to target weights (operator 5), in DataFrame functions.

Sources, by code point with null last, weigh 1, 2, 3 in turn and share the size
of the whole table (words); a source's target stops at ``MOST`` times its size
and the excess goes to the others by weight. That is the level L at which
sum(min(MOST * size, L * weight)) is the whole size: sources sorted by
size / weight reach their stop in that order, so one pass over the (one row per
source) totals gives it.

Every row has a hash-random key. Rows of a source with equal doc_id and size are one
group (mostly of one row). Within a source, keys are cut into equal ranges of about
``RANGE_ROWS`` rows (hash keys are even, so ranges need no sample and a hot source is
many ranges); prefix sums are taken over the groups of a range, and over the ranges'
totals. Whole repeats of a source are taken first, then groups in key order up to the
source's exact budget, the last row in part; only in the group that this cut goes
through are rows numbered, by the tasks that wrote them, so that one doc_id on a
third of all rows fills no task.

Defined results: null text has size 0, an empty or very long one its whole number of
words; a null source is a source of its own; rows with equal doc_id and size are
interchangeable, each keeps its own take (so do repeated rows, and ties of the key);
a table without words takes nothing; an empty table gives an empty result; other
columns are not read, and ``mixed`` carries them along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written

MOST, WEIGHTS, RANGE_ROWS = 3, 3, 4096
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """(s, n, source_size, target) of every source; s stands for it without null."""
    total = sizes.groupBy("s").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    # one row per source from here on
    by_name = Window.orderBy(F.col("s") == "", "s")
    total = total.withColumn("w", (F.row_number().over(by_name) - 1) % WEIGHTS + 1)
    big = "decimal(38,0)"
    by_stop = Window.orderBy(F.col("source_size") / F.col("w"), "s")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    total = (total.withColumn("all", F.sum("source_size").over(every))
             .withColumn("stopped", F.coalesce(F.sum(F.col("source_size") * MOST).over(before), F.lit(0)))
             .withColumn("weights", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
             .withColumn("stops", (F.col("all") - F.col("stopped")).cast(big) * F.col("w")
                         >= F.col("source_size").cast(big) * MOST * F.col("weights")))
    left = F.col("all") - F.sum(F.when(F.col("stops"), F.col("source_size") * MOST).otherwise(0)).over(every)
    share = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("w"))).over(every)
    return total.select("s", "n", "source_size", F.when(
        F.col("stops"), (F.col("source_size") * MOST).cast("double")).otherwise(
        left.cast("double") * F.col("w") / share).alias("target"))


def with_size_columns():
    return [F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("s"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.monotonically_increasing_id().alias("row")]


def with_size(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", *with_size_columns())


def takes(docs: DataFrame) -> DataFrame:
    """(row, doc_id, size, source_size, target, taken) of every row."""
    ship(docs.sparkSession)
    return _takes(written(with_size(docs), "sizes"))


def _takes(sizes: DataFrame) -> DataFrame:
    """The takes of a written table (doc_id, s, size, row)."""
    target = written(source_targets(sizes), "targets")
    # rows with equal (source, doc_id, size) are one group: ranges hold groups, so
    # one doc_id on very many rows fills no range
    same = ["s", "doc_id", "size"]
    groups = sizes.groupBy(*same).agg(F.count("*").alias("c")).join(target, "s")
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                             1, 15), 16, 10).cast("long")
    groups = (groups.withColumn("key", key)
              .withColumn("range", F.floor(F.col("key") / float(1 << 60)
                                           * F.ceil(F.col("n") / RANGE_ROWS)).cast("long")))
    inside = Window.partitionBy("s", "range").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("c")
    ranges = groups.groupBy("s", "range").agg(F.sum(words).alias("z"))
    over = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("s", "range", F.coalesce(F.sum("z").over(over), F.lit(0)).alias("ahead"))
    whole = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    rest = F.floor("target").cast("long") - F.col("whole") * F.col("source_size")
    left = F.greatest(F.lit(0), F.col("rest") - F.col("ahead") - F.col("before"))
    groups = (groups.withColumn("before", F.coalesce(F.sum(words).over(inside), F.lit(0)))
              .join(ranges, ["s", "range"]).withColumn("whole", whole.cast("long"))
              .withColumn("rest", rest).withColumn("left", left)
              .withColumn("full", F.when(F.col("size") > 0, F.least(F.col("c"), F.expr("left div size")))
                          .otherwise(F.col("c"))))
    groups = groups.select(*same, "c", "source_size", "target", "whole", "full",
                           (F.col("left") - F.col("full") * F.col("size")).alias("part"))
    # rows are told apart only in a group that the cut goes through (one a source)
    cut = groups.where("c > 1 and full < c and full + part > 0").select(*same)
    rows = _same_join(sizes, groups, "inner")
    nth = _numbers(_same_join(sizes, cut, "leftsemi"), same)
    rows = rows.join(nth, "row", "left").withColumn("nth", F.coalesce("nth", F.lit(1)))
    taken = (F.when(F.col("nth") <= F.col("full"), F.col("size"))
             .when(F.col("nth") == F.col("full") + 1, F.least(F.col("size"), F.col("part"))).otherwise(0))
    taken = F.when(F.col("full") == F.col("c"), F.col("size")).otherwise(taken)
    return rows.select("row", "doc_id", "size", "source_size", "target",
                       (F.col("whole") * F.col("size") + taken).cast("long").alias("taken"))


def _same_join(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    """rows with the group of equal (s, doc_id, size), a null doc_id too."""
    g = groups.withColumnsRenamed({k: f"__{k}" for k in ("s", "doc_id", "size")})
    same = (F.col("s") == F.col("__s")) & F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (
        F.col("size") == F.col("__size"))
    return rows.join(g, same, how).drop("__s", "__doc_id", "__size")


def _numbers(rows: DataFrame, same: list[str]) -> DataFrame:
    """(row, nth): 1, 2, ... over the rows of each group, by the task that wrote a row
    (the row number's high bits) and within it."""
    rows = rows.withColumn("task", F.shiftright("row", 33))
    inside = Window.partitionBy(*same, "task").orderBy("row")
    before = Window.partitionBy(*same).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (rows.groupBy(*same, "task").agg(F.count("*").alias("z"))
             .withColumn("ahead", F.coalesce(F.sum("z").over(before), F.lit(0))).drop("z"))
    placed = rows.withColumn("i", F.row_number().over(inside)).withColumnRenamed("task", "own")
    both = _same_join(placed, ahead, "inner").where("own = task")
    return both.select("row", (F.col("ahead") + F.col("i")).alias("nth"))


def mixture(docs: DataFrame) -> DataFrame:
    return takes(docs).drop("row")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken whole, and once
    more with their first words where they are taken in part. Ids, sizes and texts
    are written together once, so a row keeps its id whatever executors come or go.
    A column n_chars, where there is one, follows the text."""
    ship(docs.sparkSession)
    rows = written(docs.select(F.struct(*docs.columns).alias("doc"), *with_size_columns()), "rows")
    take = (_takes(rows.select(F.col("doc.doc_id").alias("doc_id"), "s", "size", "row")).where("taken > 0")
            .select("row", "size", "taken"))
    times = F.concat(F.array_repeat(F.col("size"), F.expr("cast(taken div size as int)")),
                     F.when(F.col("taken") % F.col("size") > 0, F.array(F.col("taken") % F.col("size")))
                     .otherwise(F.array().cast("array<long>")))
    rows = rows.select("row", "doc").join(take, "row").withColumn("words", F.explode(times))
    cut, text = F.col("words") < F.col("size"), F.col("doc.text")
    text = F.when(cut, F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), 0), 1,
                                            F.col("words").cast("int")), " ")).otherwise(text)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("doc.n_chars"))
    return rows.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS s,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
t AS (SELECT s, CAST(sum(size) AS BIGINT) AS z, CAST(sum(sum(size)) OVER () AS HUGEINT) AS everything,
             (row_number() OVER (ORDER BY s = '', s) - 1) % 3 + 1 AS w FROM d GROUP BY s),
u AS (SELECT *, coalesce(sum(z * 3) OVER b, 0) AS gone, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS ws
      FROM t WINDOW b AS (ORDER BY z / CAST(w AS DOUBLE), s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, (everything - gone) * w >= CAST(z AS HUGEINT) * 3 * ws AS stops FROM u),
x AS (SELECT s, z, CASE WHEN stops THEN CAST(z * 3 AS DOUBLE)
       ELSE CAST(everything - (SELECT coalesce(sum(z * 3), 0) FROM v WHERE stops) AS DOUBLE) * w
            / CAST((SELECT sum(w) FROM v WHERE NOT stops) AS DOUBLE) END AS target FROM v),
p AS (SELECT d.doc_id, d.size, x.z AS source_size, x.target, CAST(floor(x.target) AS BIGINT) AS budget,
             CAST(sum(d.size) OVER (PARTITION BY d.s ORDER BY CAST('0x' || substr(md5(coalesce(
               CAST(d.doc_id AS VARCHAR), '')), 1, 15) AS BIGINT), d.doc_id, d.size
               ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS ahead
      FROM d JOIN x USING (s)),
q AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM p)
SELECT doc_id, size, source_size, target,
       whole * size + greatest(0, least(size, budget - whole * source_size - ahead)) AS taken
FROM q"""
