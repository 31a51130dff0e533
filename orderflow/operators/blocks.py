"""Building blocks shared by the business queries.

Nearest-rank statistics are computed from a value histogram
(``groupBy(group, value).count()``) instead of numbering every row: the
histogram has one row per distinct value, so a group with a third of all rows
still becomes a few hundred histogram rows and no task has to sort it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import idiv, round_ratio
from ..sources.staged import staged


def nearest_rank_stats(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """B1/B2: per group n, median (mean of the middle one/two values, rounded
    to a whole number) and p90 (value at rank round(0.9 n)), plus min / max.

    Output columns: *group, n, median_value, p90_value, min_value, max_value.
    """
    group = list(group)
    hist = (df.filter(F.col(value).isNotNull())
            .groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c")))
    upto = (Window.partitionBy(*group).orderBy(value)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = Window.partitionBy(*group)
    hist = (hist.withColumn("_cum", F.sum("_c").over(upto))
            .withColumn("n", F.sum("_c").over(whole)))
    n = F.col("n")
    lo, hi = idiv(n + 1, 2), idiv(n + 2, 2)
    r90 = idiv(n * 9 + 5, 10)

    def at(rank: Column) -> Column:
        inside = (F.col("_cum") - F.col("_c") < rank) & (rank <= F.col("_cum"))
        return F.max(F.when(inside, F.col(value)))

    stats = hist.groupBy(*group, "n").agg(
        at(lo).alias("_lo"), at(hi).alias("_hi"), at(r90).alias("p90_value"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"))
    return stats.select(*group, "n",
                        round_ratio(F.col("_lo") + F.col("_hi"), F.lit(2), 0).alias("median_value"),
                        "p90_value", "min_value", "max_value")


def bucket(value: Column, bounds: Sequence[int], labels: Sequence[str]) -> Column:
    """First label whose upper bound (inclusive) holds value; last label otherwise."""
    expr = None
    for b, label in zip(bounds, labels):
        expr = (F.when(value <= b, label) if expr is None else expr.when(value <= b, label))
    return expr.otherwise(labels[len(bounds)])


def fiscal_year_start(d: Column) -> Column:
    """Financial year (April start) that a date falls in."""
    return F.year(d) - F.when(F.month(d) < 4, 1).otherwise(0)


def fiscal_quarter(d: Column) -> Column:
    """Quarter of the April-start financial year (Apr-Jun = 1)."""
    return idiv(F.pmod(F.month(d) + 8, F.lit(12)), 3) + 1


def share_of_total(amount: Column, partition: Sequence[str] = ()) -> Column:
    """Amount / total over a partition (used after aggregation only)."""
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return amount / F.sum(amount).over(w)


def running(amount: Column, order: Sequence, partition: Sequence[str] = ()) -> Column:
    """Running total (ROWS UNBOUNDED PRECEDING .. CURRENT ROW)."""
    w = (Window.partitionBy(*partition) if partition else Window.partitionBy())
    w = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(amount).over(w)


def top_k_per_group(df: DataFrame, partition: Sequence[str], order: Sequence,
                    k: int, rank_col: str = "rnk") -> DataFrame:
    """First k rows per group by row_number. The filter on a rank-only
    window lets Spark insert a partial group limit before the shuffle."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def ntile_from_rank(rank: Column, population: Column, buckets: int) -> Column:
    """NTILE(buckets) of the row at 1-based ``rank`` in a ranking of ``population``
    rows, without a window over the population: the first (population mod
    buckets) tiles hold one row more than the others."""
    r, n = rank.cast("long"), population.cast("long")
    size, rem = idiv(n, buckets), F.pmod(n, F.lit(buckets))
    big = rem * (size + 1)
    return F.when(r <= big, idiv(r - 1, size + 1) + 1).otherwise(
        rem + idiv(r - 1 - big, F.greatest(size, F.lit(1))) + 1)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence, into: str) -> DataFrame:
    """``into``: 1, 2, ... over the rows of equal (non-null) keys in the given order,
    rows equal in it in any order. A key's rows need not be in one task: the table is
    sorted by ranges of (keys, order), so a hot key lies in several neighbouring
    partitions, and a row's number is its place in its partition plus the key's rows
    in the partitions before (one row per partition and key)."""
    by = [*[F.col(k) for k in keys], *order, F.col("_tie")]
    placed = staged(df.withColumn("_tie", F.monotonically_increasing_id())
                    .repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
                    .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}),
                    "numbered")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (placed.groupBy("_part", *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
             .select("_part", *keys, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead")))
    number = F.col("_at") - F.col("_first") + F.col("_ahead") + 1
    return placed.join(first, ["_part", *keys]).select(*df.columns, number.alias(into))
