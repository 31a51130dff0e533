"""Q1-Q12, Q4b and Appendix A: the recurring business questions.

Each function takes the order-book tables (``tables.<name>`` DataFrames) and
``Params`` and returns a DataFrame; nothing is collected. Conventions:
  * orders are never inner-joined to quotations except in Q2 (lead time only
    exists for quoted orders);
  * order-level questions read the product line from line 1;
  * money is summed as exact DECIMAL and rounded once, shares of money are
    DOUBLE ratios of the exact sums, and shares / means of counts and days use
    exact integer rounding;
  * every window runs on already-aggregated rows (months, quarters, reasons,
    buckets, per-line top-k) except the rank-only top-k, which Spark limits
    per partition before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.numeric import money, pct, round_ratio, tenths
from ..params import DEFAULT, Params
from ..sources.staged import staged
from . import blocks as B
from .delivery import otif


def _first_line_product(tables) -> DataFrame:
    """(order_id, item_id, product_line) of line 1."""
    return (tables.order_lines.filter(F.col("line_no") == 1).select("order_id", "item_id")
            .join(tables.items.select("item_id", "product_line", "vessel_diameter_mm"),
                  "item_id"))


def _order_value(tables) -> DataFrame:
    """Order value from its lines (qty x unit price, no FX), pre-aggregated."""
    return (tables.order_lines.groupBy("order_id")
            .agg(F.sum(F.col("ordered_qty") * F.col("unit_price")).alias("order_value")))


def _money_share(part, whole, digits=1):
    return F.round(F.lit(100.0) * part.cast("double") / whole.cast("double"), digits)


# --------------------------------------------------------------------------- Q1
def q1_funnel(tables, params: Params = DEFAULT) -> DataFrame:
    cust = tables.customers.select("customer_id", "market_type")
    won_ids = (tables.orders.filter(F.col("quote_id").isNotNull())
               .select(F.col("quote_id").alias("_won_id")).distinct())
    first_q = (tables.quotation_lines.filter(F.col("line_no") == 1).select("quote_id", "item_id")
               .join(tables.items.select("item_id", "product_line"), "item_id"))
    q = (tables.quotations.select("quote_id", "customer_id")
         .join(cust, "customer_id").join(first_q, "quote_id")
         .join(won_ids, F.col("quote_id") == F.col("_won_id"), "left"))
    qa = q.groupBy("product_line", "market_type").agg(
        F.count(F.lit(1)).alias("issued"),
        F.sum(F.col("_won_id").isNotNull().cast("long")).alias("won"))
    o = (tables.orders.select("order_id", "customer_id", "quote_id")
         .join(cust, "customer_id").join(_first_line_product(tables), "order_id"))
    oa = o.groupBy("product_line", "market_type").agg(
        F.count(F.lit(1)).alias("orders_total"),
        F.sum(F.col("quote_id").isNull().cast("long")).alias("no_quote"))
    d = qa.join(oa, ["product_line", "market_type"], "full")
    return d.select(
        "product_line", "market_type",
        F.coalesce("issued", F.lit(0)).cast("long").alias("quotes_issued"),
        F.coalesce("won", F.lit(0)).cast("long").alias("quotes_won"),
        pct(F.col("won"), F.col("issued"), 1).alias("conversion_pct"),
        F.coalesce("orders_total", F.lit(0)).cast("long").alias("orders_total"),
        F.coalesce("no_quote", F.lit(0)).cast("long").alias("orders_with_no_quote"),
        pct(F.col("no_quote"), F.col("orders_total"), 1).alias("no_quote_share_pct"),
    )


# --------------------------------------------------------------------------- Q2
def q2_quote_to_po(tables, params: Params = DEFAULT) -> DataFrame:
    o = tables.orders.filter(F.col("quote_id").isNotNull()).select("order_id", "quote_id",
                                                                   "po_date")
    lead = (o.join(tables.quotations.select("quote_id", "quote_date"), "quote_id")
            .join(_first_line_product(tables), "order_id")
            .select("product_line",
                    F.datediff("po_date", "quote_date").cast("long").alias("days")))
    stats = B.nearest_rank_stats(lead, ["product_line"], "days")
    negatives = lead.groupBy("product_line").agg(
        F.sum((F.col("days") < 0).cast("long")).alias("po_before_quote"))
    return (stats.filter(F.col("n") >= params.min_lead_time_orders)
            .join(negatives, "product_line")
            .select("product_line",
                    F.col("n").cast("long").alias("orders_measurable"),
                    F.col("min_value").cast("long").alias("fastest"),
                    F.col("median_value").alias("median_days"),
                    F.col("p90_value").cast("long").alias("p90_days"),
                    F.col("max_value").cast("long").alias("slowest"),
                    F.col("po_before_quote").cast("long").alias("po_before_quote")))


# --------------------------------------------------------------------------- Q3
def q3_otif_trend(tables, params: Params = DEFAULT, view: DataFrame | None = None) -> DataFrame:
    v = view if view is not None else otif(tables, params)
    agg = (v.select("product_line",
                    B.fiscal_year_start(F.col("promised")).alias("fy_start"),
                    B.fiscal_quarter(F.col("promised")).alias("fy_q"),
                    "otif", "on_time", "in_full")
           .groupBy("product_line", "fy_start", "fy_q")
           .agg(F.count(F.lit(1)).alias("orders_due"), F.sum("otif").alias("otif_n"),
                F.sum("on_time").alias("on_time_n"), F.sum("in_full").alias("in_full_n"))
           .filter(F.col("orders_due") >= params.min_orders_due_per_quarter))
    otif_t = tenths(F.col("otif_n"), F.col("orders_due"))
    w = Window.partitionBy("product_line").orderBy("fy_start", "fy_q")
    fy = F.col("fy_start").cast("string")
    fy_next = (F.col("fy_start") + 1).cast("string")
    label = F.concat(F.lit("FY"), F.substring(fy, 3, 2), F.lit("-"), F.substring(fy_next, 3, 2),
                     F.lit(" Q"), F.col("fy_q").cast("string"))
    return agg.select(
        "product_line", label.alias("quarter_label"),
        F.col("orders_due").cast("long").alias("orders_due"),
        (otif_t.cast("double") / 10.0).alias("otif_pct"),
        pct(F.col("on_time_n"), F.col("orders_due"), 1).alias("on_time_pct"),
        pct(F.col("in_full_n"), F.col("orders_due"), 1).alias("in_full_pct"),
        ((otif_t - F.lag(otif_t).over(w)).cast("double") / 10.0).alias("vs_prev_quarter"),
    )


# --------------------------------------------------------------------------- Q4
def _vessel_orders(tables) -> DataFrame:
    first = _first_line_product(tables).filter(F.col("product_line") == "Pressure Vessel")
    o = (tables.orders.filter(F.col("cancellation_date").isNull()
                              & F.col("promised_delivery_date").isNotNull())
         .select("order_id", "po_date", "promised_delivery_date"))
    return (o.join(first, "order_id")
            .select("order_id", "po_date",
                    F.col("vessel_diameter_mm").alias("dia_mm"),
                    F.datediff("promised_delivery_date", "po_date").cast("long")
                    .alias("promised_days")))


def q4_vessel_lead_time(tables, params: Params = DEFAULT) -> DataFrame:
    last = tables.dispatches.groupBy("order_id").agg(F.max("dispatch_date").alias("_last"))
    bounds = [b for b, _ in params.size_bands[:-1]]
    labels = [label for _, label in params.size_bands]
    v = (_vessel_orders(tables).join(last, "order_id", "left")
         .select(B.bucket(F.col("dia_mm"), bounds, labels).alias("size_band"), "promised_days",
                 F.datediff("_last", "po_date").cast("long").alias("actual_days")))
    med = B.nearest_rank_stats(v, ["size_band"], "promised_days").select(
        "size_band", "n", "median_value")
    means = v.groupBy("size_band").agg(
        F.sum("promised_days").alias("_sp"), F.count("promised_days").alias("_np"),
        F.sum("actual_days").alias("_sa"), F.count("actual_days").alias("_na"))
    s = med.join(means, "size_band").select(
        "size_band", "n", "median_value",
        round_ratio(F.col("_sp"), F.col("_np"), 0).cast("long").alias("_mean_p"),
        round_ratio(F.col("_sa"), F.col("_na"), 0).alias("mean_actual"))
    base = F.max(F.when(F.col("size_band") == params.base_size_band, F.col("_mean_p"))) \
        .over(Window.partitionBy())
    return s.select(
        F.col("size_band").alias("grouping"),
        F.col("n").cast("long").alias("orders"),
        F.col("median_value").alias("median_promised"),
        F.col("_mean_p").cast("double").alias("mean_promised"),
        "mean_actual",
        round_ratio(F.col("_mean_p"), base, 2).alias("factor_vs_medium"),
    )


def q4b_vessel_sizes(tables, params: Params = DEFAULT) -> DataFrame:
    v = _vessel_orders(tables)
    return v.groupBy("dia_mm").agg(
        F.count(F.lit(1)).cast("long").alias("orders"),
        round_ratio(F.sum("promised_days"), F.count("promised_days"), 0).alias("mean_promised"),
        F.min("promised_days").cast("long").alias("fastest"),
        F.max("promised_days").cast("long").alias("slowest"),
    ).select(F.col("dia_mm").cast("long").alias("dia_mm"), "orders", "mean_promised",
             "fastest", "slowest", F.lit("n too small to rank sizes individually").alias("caveat"))


# --------------------------------------------------------------------------- Q5
def q5_delay_reasons(tables, params: Params = DEFAULT, view: DataFrame | None = None) -> DataFrame:
    v = view if view is not None else otif(tables, params)
    late = v.filter(F.col("on_time") == 0).select("order_id", "days_late")
    reasons = (tables.dispatches.filter(F.col("delay_reason").isNotNull())
               .select("order_id", "delay_reason").distinct())
    per = late.join(reasons, "order_id")
    agg = (per.groupBy("delay_reason")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("days_late").alias("s"),
                F.max("days_late").alias("worst"))
           .filter(F.col("n") >= params.min_late_orders_per_reason))
    by_freq = Window.partitionBy().orderBy(F.col("n").desc())
    by_sev = Window.partitionBy().orderBy((F.col("s").cast("double") / F.col("n")).desc())
    return agg.select(
        "delay_reason",
        F.col("n").cast("long").alias("late_orders"),
        round_ratio(F.col("s"), F.col("n"), 1).alias("avg_days_late"),
        F.col("worst").cast("long").alias("worst_days_late"),
        F.col("s").cast("long").alias("total_days_lost"),
        F.rank().over(by_freq).cast("long").alias("rank_by_frequency"),
        F.rank().over(by_sev).cast("long").alias("rank_by_severity"),
    )


# --------------------------------------------------------------------------- Q6
def _paid_per_invoice(tables) -> DataFrame:
    """Payments folded per invoice once: total paid and settlement date."""
    return tables.payments.groupBy("invoice_id").agg(
        F.sum("amount").alias("paid"),
        F.max(F.when(F.col("payment_type").isin("Full", "Final"), F.col("payment_date")))
        .alias("settled_on"))


def q6_receivables_ageing(tables, params: Params = DEFAULT) -> DataFrame:
    inv = tables.invoices.join(_paid_per_invoice(tables), "invoice_id", "left")
    billed = (F.col("taxable_value") + F.col("gst_amount")) * F.col("fx_rate_to_inr")
    paid = F.coalesce(F.col("paid"), F.lit(0).cast("decimal(18,2)")) * F.col("fx_rate_to_inr")
    aged = (inv.select("invoice_id", "customer_id", (billed - paid).alias("outstanding"),
                       F.datediff(F.lit(params.as_of), "due_date").alias("days_overdue"))
            .filter(F.col("outstanding") > params.outstanding_floor_inr))
    labels = ["0 not yet due", "1 to 30 days", "31 to 60 days", "61 to 90 days", "90 plus days"]
    g = (aged.select(B.bucket(F.col("days_overdue"), list(params.ageing_bounds), labels)
                     .alias("ageing_bucket"), "customer_id", "outstanding")
         .groupBy("ageing_bucket")
         .agg(F.count(F.lit(1)).alias("invoices"),
              F.countDistinct("customer_id").alias("customers"),
              F.sum("outstanding").alias("outstanding")))
    total = F.sum("outstanding").over(Window.partitionBy())
    return g.select("ageing_bucket", F.col("invoices").cast("long").alias("invoices"),
                    F.col("customers").cast("long").alias("customers"),
                    money(F.col("outstanding")).alias("outstanding_inr"),
                    _money_share(F.col("outstanding"), total).alias("pct_of_total"))


# --------------------------------------------------------------------------- Q7
def q7_payment_behaviour(tables, params: Params = DEFAULT) -> DataFrame:
    inv = tables.invoices.join(_paid_per_invoice(tables), "invoice_id", "left")
    billed = F.col("taxable_value") + F.col("gst_amount")
    paid = F.coalesce(F.col("paid"), F.lit(0).cast("decimal(18,2)"))
    vs_due = F.datediff("settled_on", "due_date")
    per_cust = (inv.join(tables.customers.select("customer_id", "market_type", "region"),
                         "customer_id")
                .groupBy("customer_id", "market_type", "region")
                .agg(F.count(F.lit(1)).alias("invoices"),
                     F.sum((paid >= billed - params.settle_tolerance).cast("long")).alias("_full"),
                     F.sum(vs_due).alias("_sd"), F.count(vs_due).alias("_nd"),
                     F.sum((F.col("settled_on") > F.col("due_date")).cast("long")).alias("_late"),
                     F.sum(billed - paid).alias("_out"))
                .filter(F.col("invoices") >= params.min_invoices_per_customer)
                .select("customer_id", "market_type", "region", "invoices", "_full", "_late",
                        round_ratio(F.col("_sd"), F.col("_nd"), 1).alias("avg_days_vs_due"),
                        "_out"))
    # NTILE(4) over the whole ranking needs only the population size and each
    # reported row's rank: the top-k is a distributed TakeOrderedAndProject and
    # the size a one-row global aggregate; the size is carried to the k rows by a
    # window over those k + 1 rows (no join, no task ever holds all customers).
    order = [F.col("avg_days_vs_due").desc_nulls_last(), F.col("customer_id").asc()]
    top = per_cust.orderBy(*order).limit(params.top_customers_reported) \
        .withColumn("_pop", F.lit(None).cast("long"))
    size = per_cust.agg(F.count(F.lit(1)).alias("_pop"))
    both = top.unionByName(size, allowMissingColumns=True)
    everything = Window.partitionBy()
    top = (both.withColumn("_pop", F.max("_pop").over(everything))
           .filter(F.col("customer_id").isNotNull())
           .withColumn("_r", F.row_number().over(everything.orderBy(*order))))
    quartile = B.ntile_from_rank(F.col("_r"), F.col("_pop"), 4)
    return top.select(
        "customer_id", "market_type", "region", F.col("invoices").cast("long").alias("invoices"),
        pct(F.col("_full"), F.col("invoices"), 0).alias("settled_in_full_pct"),
        pct(F.col("_late"), F.col("invoices"), 0).alias("paid_late_pct"),
        "avg_days_vs_due",
        money(F.col("_out")).alias("still_outstanding"),
        quartile.cast("long").alias("worst_quartile"),
    )


# --------------------------------------------------------------------------- Q8
def q8_monthly_billing(tables, params: Params = DEFAULT) -> DataFrame:
    inv = tables.invoices
    amount = (F.col("taxable_value") + F.col("gst_amount")) * F.col("fx_rate_to_inr")
    m = (inv.groupBy(F.date_format("invoice_date", "yyyy-MM").alias("month_key"))
         .agg(F.count(F.lit(1)).alias("invoices"), F.round(F.sum(amount), 0).alias("inr")))
    w = Window.partitionBy().orderBy("month_key")
    prev = F.lag("inr").over(w)
    change = F.col("inr") - prev
    return m.select(
        "month_key", F.col("invoices").cast("long").alias("invoices"),
        F.col("inr").cast("double").alias("invoiced_inr"),
        B.running(F.col("inr"), ["month_key"]).cast("double").alias("running_total_inr"),
        change.cast("double").alias("vs_prev_month"),
        round_ratio(change.cast("long") * 100, prev.cast("long"), 1).alias("pct_change"),
    )


# --------------------------------------------------------------------------- Q9
def q9_customer_pareto(tables, params: Params = DEFAULT) -> DataFrame:
    amount = (F.col("taxable_value") + F.col("gst_amount")) * F.col("fx_rate_to_inr")
    lines = (tables.order_lines.select("order_id", "line_no", "item_id")
             .join(tables.items.select("item_id", "product_line"), "item_id"))
    # one row per (line, customer), written once: the totals and the top read that
    rev = staged(tables.invoices.select("dispatch_id", "customer_id", amount.alias("amt"))
                 .join(tables.dispatches.select("dispatch_id", "order_id", "line_no"), "dispatch_id")
                 .join(lines, ["order_id", "line_no"])
                 .groupBy("product_line", "customer_id").agg(F.sum("amt").alias("revenue")), "line-revenue")
    totals = rev.groupBy("product_line").agg(F.sum("revenue").alias("line_total"))
    order = [F.col("revenue").desc(), F.col("customer_id").asc()]
    top = B.top_k_per_group(rev, ["product_line"], order, params.pareto_top_k)
    cum = B.running(F.col("revenue"), order, ["product_line"])
    return (top.join(totals, "product_line")
            .select("product_line", F.col("rnk").cast("long").alias("rnk"), "customer_id",
                    money(F.col("revenue")).alias("revenue_inr"),
                    _money_share(F.col("revenue"), F.col("line_total")).alias("share_pct"),
                    _money_share(cum, F.col("line_total")).alias("cumulative_pct")))


# -------------------------------------------------------------------------- Q10
def q10_open_order_book(tables, params: Params = DEFAULT) -> DataFrame:
    shipped = tables.dispatches.select("order_id")
    o = (tables.orders.filter(F.col("cancellation_date").isNull())
         .select("order_id", "customer_id", "po_date", "promised_delivery_date")
         .join(shipped, "order_id", "left_anti")
         .join(_first_line_product(tables).select("order_id", "product_line"), "order_id")
         .join(tables.customers.select("customer_id"), "customer_id")
         .join(_order_value(tables), "order_id", "left"))
    age = F.datediff(F.lit(params.as_of), "po_date")
    labels = ["0 to 30 days", "31 to 60 days", "61 to 90 days", "90 plus days"]
    return (o.select("product_line", B.bucket(age, list(params.open_book_bounds), labels)
                     .alias("age_bucket"), age.alias("age_days"), "order_value",
                     F.when(F.col("promised_delivery_date") < F.lit(params.as_of), 1).otherwise(0)
                     .alias("_overdue"))
            .groupBy("product_line", "age_bucket")
            .agg(F.count(F.lit(1)).cast("long").alias("open_orders"),
                 money(F.sum("order_value")).alias("open_value_inr"),
                 F.sum("_overdue").cast("long").alias("already_overdue"),
                 F.max("age_days").cast("long").alias("oldest_days")))


# -------------------------------------------------------------------------- Q11
def q11_lost_business(clean: DataFrame, params: Params = DEFAULT) -> DataFrame:
    r = clean.filter(F.col("status_clean").isin(*V.LOST_OUTCOMES))
    g = r.groupBy("product_line", F.col("status_clean").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.count("value_inr").alias("nv"),
        F.sum("value_inr").alias("sv"),
        F.sum((F.col("value_inr") * 100).cast("long")).alias("sv_cents"))
    line_rows = F.sum("n").over(Window.partitionBy("product_line"))
    return g.select(
        "product_line", "outcome", F.col("n").cast("long").alias("rows_n"),
        F.col("nv").cast("long").alias("rows_with_a_value"),
        money(F.col("sv")).alias("value_inr"),
        round_ratio(F.col("sv_cents"), F.col("nv") * 100, 0).alias("avg_value_inr"),
        pct(F.col("n"), line_rows, 1).alias("pct_of_line_rows"),
    )


# -------------------------------------------------------------------------- Q12
def q12_ld_exposure(tables, params: Params = DEFAULT, view: DataFrame | None = None) -> DataFrame:
    v = view if view is not None else otif(tables, params)
    late = (v.filter(F.col("on_time") == 0).select("order_id", "product_line", "days_late")
            .join(tables.orders.select("order_id", "ld_clause"), "order_id")
            .join(_order_value(tables), "order_id", "left"))
    ld = F.col("ld_clause")
    status = (F.when(ld.isNull(), "4 nothing recorded")
              .when(F.instr(ld, "%") > 0, "1 genuine clause")
              .when(ld.isin(*V.LD_NONE_WORDS), "2 explicitly none")
              .otherwise("3 wrong kind of value in the field"))
    g = (late.select("product_line", status.alias("ld_status"), "days_late", "order_value")
         .groupBy("product_line", "ld_status")
         .agg(F.count(F.lit(1)).alias("n"), F.sum("days_late").alias("sd"),
              F.sum("order_value").alias("val")))
    return g.select(
        "product_line", "ld_status", F.col("n").cast("long").alias("late_orders"),
        round_ratio(F.col("sd"), F.col("n"), 1).alias("avg_days_late"),
        money(F.col("val")).alias("value_at_risk_inr"),
        pct(F.col("n"), F.sum("n").over(Window.partitionBy("product_line")), 1)
        .alias("pct_of_late"),
    )


# --------------------------------------------------------------------------- QA
def qa_status_mapping(clean: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Wordings of a state are sorted over all tasks and joined range by range; only
    the last step holds a state's whole list, as one text."""
    g = staged(clean.groupBy(F.col("status_clean").alias("mapped_to"), "status_raw").agg(
        F.count(F.lit(1)).alias("n")), "wordings")
    counts = g.groupBy("mapped_to").agg(F.sum("n").alias("rows_n"), F.count("status_raw").alias("wordings"))
    by = ["mapped_to", "status_raw"]
    runs = (g.where(F.col("status_raw").isNotNull()).select(*by).repartitionByRange(*by)
            .groupBy("mapped_to", F.spark_partition_id().alias("part"))
            .agg(F.array_join(F.array_sort(F.collect_list("status_raw")), ",").alias("run")))
    lists = runs.groupBy(F.col("mapped_to").alias("state")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("part", "run"))), lambda r: r["run"]), ",")
        .alias("as_typed_in_the_source"))
    return counts.join(lists, F.col("mapped_to").eqNullSafe(F.col("state")), "left").select(
        "mapped_to", F.col("rows_n").cast("long").alias("rows_n"),
        F.col("wordings").cast("long").alias("wordings"), "as_typed_in_the_source")
