"""Statistics of a register (the profile its parameters describe).

All are grouped aggregates over the cleaned register; quantiles use a histogram of
value ranges and count only inside the ranges asked for, concentration uses a
rank-limited top-k plus a separate total, so no group is sorted whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import iso_text
from ..functions.numeric import idiv, pct
from ..sources.staged import staged
from .register import RAW_COLUMNS

QUANTILES = [10, 25, 50, 75, 90, 95, 99]
TOP_K = [1, 5, 10]


def f1_funnel(clean: DataFrame) -> DataFrame:
    """Per product line: quoted x won 2x2 counts and the two derived shares."""
    q, w = F.col("quote_no_is_real"), F.col("became_order")
    g = clean.groupBy("product_line").agg(
        F.count(F.lit(1)).alias("rows_n"),
        F.count_if(q).alias("has_quote_no"),
        F.count_if(w).alias("won"),
        F.count_if(q & w).alias("won_and_quoted"),
        F.count_if(~q & w).alias("won_without_quote_no"),
        F.count_if(q & ~w).alias("quoted_not_won"),
        F.count_if(~q & ~w).alias("neither"))
    return g.select(
        "product_line", *[F.col(c).cast("long").alias(c) for c in
                          ("rows_n", "has_quote_no", "won", "won_and_quoted",
                           "won_without_quote_no", "quoted_not_won", "neither")],
        pct(F.col("won_without_quote_no"), F.col("won"), 1).alias("no_quote_share_of_won_pct"),
        pct(F.col("won_and_quoted"), F.col("has_quote_no"), 1).alias("conversion_of_quoted_pct"))


def quantiles(df: DataFrame, group: list[str], value: str, qs=QUANTILES) -> DataFrame:
    """Value at nearest rank max(1, round(q% of n)) per group, with n, max and the
    count of negatives. A histogram of value ranges (a few thousand, whatever the
    rows) brackets every rank; a second pass counts the values inside the brackets,
    so no group is sorted whole."""
    d = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias(value))
    # ranges by the amount's power of 2 ^ (1/64)
    fold = F.floor(F.log2(F.greatest(F.abs(F.col(value)), F.lit(1e-3))) * 64).cast("int")
    d = d.withColumn("_range", F.when(F.col(value) < 0, -fold - 1_000_000).otherwise(fold + 1_000_000))
    by = Window.partitionBy(*group)
    upto = by.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = staged(d.groupBy(*group, "_range").agg(
        F.count(F.lit(1)).alias("_c"), F.max(value).alias("_max"),
        F.count_if(F.col(value) < 0).alias("_neg")), "value-ranges")
    counted = ranges.withColumn("_cum", F.sum("_c").over(upto)).withColumn("_n", F.sum("_c").over(by))
    ranks = F.array(*[F.struct(F.lit(q).alias("q"),
                               F.greatest(idiv(F.col("_n") * q + 50, 100), F.lit(1)).alias("rank")) for q in qs])
    asked = counted.select("*", F.explode(ranks).alias("a")).where(
        (F.col("_cum") - F.col("_c") < F.col("a.rank")) & (F.col("a.rank") <= F.col("_cum")))
    nth = [F.max(F.when(F.col("a.q") == q, F.col("a.rank") - F.col("_cum") + F.col("_c"))).alias(f"_p{q}") for q in qs]
    asked = asked.groupBy(*group, "_range").agg(*nth)  # one row a bracket: counts are not multiplied
    steps = d.join(asked, [*group, "_range"]).groupBy(*group, "_range", value).agg(
        F.count(F.lit(1)).alias("_c"), *[F.first(f"_p{q}").alias(f"_p{q}") for q in qs])
    run = Window.partitionBy(*group, "_range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    steps = steps.withColumn("_cum", F.sum("_c").over(run))
    at = [F.max(F.when((F.col("_cum") - F.col("_c") < F.col(f"_p{q}")) & (F.col(f"_p{q}") <= F.col("_cum")),
                       F.col(value))).alias(f"p{q}") for q in qs]
    whole = ranges.groupBy(*group).agg(F.sum("_c").alias("n"), F.max("_max").alias("max"),
                                       F.sum("_neg").alias("negatives"))
    return whole.join(steps.groupBy(*group).agg(*at), group).select(
        *group, "n", *[f"p{q}" for q in qs], "max", "negatives")


def f2_lead_time_quantiles(clean: DataFrame) -> DataFrame:
    """Quantiles per product line of four measures: days from quote to PO, days
    from PO to the promised date, order values and item quantities. The register is
    read once; its measures are written as (product_line, measure, value)."""
    measures = [("quote_to_po_days", F.datediff("po_date", "quote_date")),
                ("po_to_dp_days", F.datediff("dp_date", "po_date")),
                ("order_value_inr", F.when(F.col("became_order"), F.col("value_inr"))),
                ("item_qty", F.col("item_qty"))]
    long = staged(clean.select("product_line", F.inline(F.array(*[
        F.struct(F.lit(name).alias("measure"), value.cast("double").alias("value")) for name, value in measures])))
        .where("value is not null"), "measures")
    r = quantiles(long, ["measure", "product_line"], "value")
    return r.select("measure", "product_line", F.col("n").cast("long").alias("n"),
                    *[f"p{q}" for q in QUANTILES], "max", F.col("negatives").cast("long").alias("negatives"))


def f3_concentration(clean: DataFrame) -> DataFrame:
    """Share of a line's register value held by its top 1 / 5 / 10 customers."""
    per = (clean.filter(F.col("value_inr").isNotNull()).groupBy("product_line", "customer_id")
           .agg(F.sum("value_inr").alias("v")))
    kmax = max(TOP_K)
    w = Window.partitionBy("product_line").orderBy(F.col("v").desc(), F.col("customer_id"))
    top = per.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= kmax)
    tops = top.groupBy("product_line").agg(
        *[F.sum(F.when(F.col("_r") <= k, F.col("v")).otherwise(0)).alias(f"_t{k}")
          for k in TOP_K])
    total = per.groupBy("product_line").agg(F.sum("v").alias("_all"),
                                            F.count(F.lit(1)).alias("customers"))

    def whole(c):  # cents, so that the share is an exact ratio
        return F.round(F.col(c) * 100).cast("decimal(28,0)")
    return tops.join(total, "product_line").select(
        "product_line", F.col("customers").cast("long"),
        *[pct(whole(f"_t{k}"), whole("_all"), 1).alias(f"top{k}_value_pct") for k in TOP_K])


def f4_fill_rates(raw: DataFrame) -> DataFrame:
    """Filled share of every register column among the rows that became orders
    (a job or PO number), one pass, unpivoted."""
    won = raw.filter((F.col("job_no") != "") | (F.col("po_no") != ""))
    one = won.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count(F.when(F.col(c) != "", F.col(c))).alias(c) for c in RAW_COLUMNS])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled"))
                    for c in RAW_COLUMNS])
    return one.select("_rows", F.inline(arr)).select(
        "column_name", F.col("filled").cast("long"), pct(F.col("filled"), F.col("_rows"), 1)
        .alias("fill_pct"))


def f5_vocabulary(raw: DataFrame) -> DataFrame:
    """Wordings as typed: status, vertical by line, free-text delivery promises."""
    status = (raw.filter(F.col("status").isNotNull()).groupBy("status").count()
              .select(F.lit("status").alias("block"), F.col("status").alias("wording"),
                      F.lit(None).cast("string").alias("product_line"), "count"))
    vertical = (raw.filter(F.col("vertical").isNotNull()).groupBy("vertical", "item").count()
                .select(F.lit("vertical").alias("block"), F.col("vertical").alias("wording"),
                        F.col("item").alias("product_line"), "count"))
    free = (raw.filter(F.col("dp_date").isNotNull() & iso_text(F.col("dp_date")).isNull())
            .groupBy("dp_date").count()
            .select(F.lit("dp_free_text").alias("block"), F.col("dp_date").alias("wording"),
                    F.lit(None).cast("string").alias("product_line"), "count"))
    return reduce(DataFrame.unionByName, [status, vertical, free]).select(
        "block", "wording", "product_line", F.col("count").cast("long").alias("rows_n"))


def f6_job_bands(clean: DataFrame) -> DataFrame:
    return (clean.filter(F.col("job_band").isNotNull()).groupBy("job_band")
            .agg(F.count(F.lit(1)).cast("long").alias("rows_n")))
