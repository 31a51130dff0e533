"""Validation checks, one row each: (check_name, expected, actual, verdict).

verdict is PASS, FAIL or EXPECTED (a planted data fault was found, as it
should be). A check is a formula over metrics, and a metric belongs to a source:
one distributed aggregate over a table or a join, that gives all of its metrics in
one pass. The sources that the asked checks need, with the metrics they need, are
run as one job; their metrics are written as a single row, and all checks are read
off that row. Thresholds are ``Params`` because they are facts about the dataset.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.numeric import idiv, pct
from ..params import DEFAULT, Params
from ..sources.staged import staged
from .audit_log import log_rows, order_metrics, register_metrics, with_any_date
from .constraints import orphaned, with_parents
from .delivery import otif
from .register import clean_register, clean_rows


CHECK_NAMES = [
    "01 row counts", "02 rows per product line", "03 orphaned foreign keys",
    "04 dispatch on or after PO date", "05 invoice date = dispatch date",
    "06a quote <= PO (modelled tables)", "06b quote <= PO (raw register)",
    "07 invoice value = dispatched qty x price", "08 GST by market", "09 FX rate by currency",
    "10 job numbers unique and banded", "11 payments do not exceed the invoice",
    "12 payment timing", "13 dispatched quantities sane", "14 cancelled orders never ship",
    "15 OTIF in range", "16 orders without a quotation", "17 register still carries its faults",
    "18 no invented vocabulary", "18b identity columns within allowlist",
    "19 status mapping is complete", "20 cleaning log written",
]


def check_key(name: str) -> str:
    """'06a quote <= PO (modelled tables)' -> 'c06a_quote_po_modelled_tables'."""
    return "c" + re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


class Inputs:
    """What a source is built from."""

    def __init__(self, tables, params: Params, asked: set[str]):
        self.t, self.p, self.asked = tables, params, asked

    def wants(self, *metrics: str) -> bool:
        return bool(self.asked & set(metrics))


#: In the order they run in: those that shuffle most come first, while few stages of the
#: order book are on disk beside their shuffle files.
_SOURCES = []


def _source(*names: str, more=dict):
    """A function Inputs -> (base, {metric: aggregate}) for the metrics named (those of
    ``more`` are known once a session runs). The base may look at which are asked for,
    and is not built, nor its tables asked for, where none is. Metrics are numbers, or
    texts where the name ends in _txt."""
    def deco(fn):
        _SOURCES.append((fn, lambda: {*names, *more()}))
        return fn
    return deco


@_source("invoice_other_day", "invoice_off")
def _invoice_dispatch(x: Inputs):
    c = F.col
    shipped, billed = ["dispatch_id", "dispatch_date"], ["dispatch_id", "invoice_date"]
    sent = x.t.dispatches.select("dispatch_id", "dispatch_date", "order_id", "line_no", "dispatched_qty")
    out = {"invoice_other_day": F.count_if(c("invoice_date") != c("dispatch_date"))}
    if x.wants("invoice_off"):
        # the price first, where lines and dispatches lie side by side: each is dealt by dispatch once
        sent = sent.join(x.t.order_lines.select("order_id", "line_no", "unit_price"), ["order_id", "line_no"], "left")
        off = F.abs(c("taxable_value") * c("fx_rate_to_inr") - c("dispatched_qty") * c("unit_price"))
        out["invoice_off"] = F.count_if(off > x.p.invoice_tolerance_inr)
        shipped, billed = [*shipped, "dispatched_qty", "unit_price"], [*billed, "taxable_value", "fx_rate_to_inr"]
    return x.t.invoices.select(*billed).join(sent.select(*shipped), "dispatch_id"), out


@_source("rows_invoices", "wrong_fx", "orphan_invoice")
def _invoices(x: Inputs):
    c, (lo, hi) = F.col, x.p.fx_usd_range
    base, out = x.t.invoices, {
        "rows_invoices": F.count(F.lit(1)),
        "wrong_fx": F.count_if(((c("currency") == "INR") & (c("fx_rate_to_inr") != 1))
                               | ((c("currency") == "USD") & ~c("fx_rate_to_inr").between(lo, hi)))}
    if x.wants("orphan_invoice"):
        base = with_parents(x.t, base, [(["dispatch_id"], "dispatches", ["dispatch_id"])])
        out["orphan_invoice"] = F.count_if(orphaned(["dispatch_id"], 0))
    return base, out


@_source("overpaid")
def _paid(x: Inputs):
    c = F.col
    paid = x.t.payments.groupBy("invoice_id").agg(F.sum("amount").alias("paid"))
    return (paid.join(x.t.invoices.select("invoice_id", "taxable_value", "gst_amount"), "invoice_id"),
            {"overpaid": F.count_if(c("paid") > c("taxable_value") + c("gst_amount") + x.p.settle_tolerance)})


@_source("rows_payments", "orphan_payment")
def _payments(x: Inputs):
    base, out = x.t.payments, {"rows_payments": F.count(F.lit(1))}
    if x.wants("orphan_payment"):
        base = with_parents(x.t, base, [(["invoice_id"], "invoices", ["invoice_id"])])
        out["orphan_payment"] = F.count_if(orphaned(["invoice_id"], 0))
    return base, out


@_source("paid_early")
def _payment_invoice(x: Inputs):
    c = F.col
    both = (x.t.payments.select("invoice_id", "payment_date", "payment_type")
            .join(x.t.invoices.select("invoice_id", "invoice_date"), "invoice_id"))
    return both, {"paid_early": F.count_if((c("payment_date") < c("invoice_date")) & (c("payment_type") != "Advance"))}


@_source("rows_register", "quote_after_po", "unmapped",
         "rows_line_*", "rows_other_line", "forbidden_0", "forbidden_1", "forbidden_ld", more=register_metrics)
def _register(x: Inputs):
    """The cleaned register: faults, wordings, and the cleaning log's counts."""
    c, cells = F.col, x.t.raw_quote_register
    frag = f"%{V.FORBIDDEN_LD_FRAGMENT}%"
    ld = (F.coalesce(c("ld"), F.lit("")).ilike(frag) | F.coalesce(c("ld_clause"), F.lit("")).ilike(frag))
    raw, extra = with_any_date(cells).withColumn("_ld_forbidden", ld), ("_any_date", "_ld_forbidden")
    market = x.wants("export_mislabelled")
    clean = clean_register(raw, x.t.customers, x.p, extra) if market else clean_rows(raw, x.p, extra)
    lines = sorted(x.p.expected_rows_per_line or V.PRODUCT_LINES)
    return clean, {
        **register_metrics(market), "rows_register": F.count(F.lit(1)),
        "quote_after_po": F.count_if(c("quote_date") > c("po_date")),
        "unmapped": F.count_if(c("status_clean") == V.UNMAPPED),
        **{f"rows_line_{k}": F.count_if(c("product_line") == v) for k, v in enumerate(lines)},
        "rows_other_line": F.count_if(~F.coalesce(c("product_line").isin(*lines), F.lit(False))),
        "forbidden_0": F.count_if(c("status_raw") == V.FORBIDDEN_STATUS[0]),
        "forbidden_1": F.count_if(c("status_raw") == V.FORBIDDEN_STATUS[1]),
        "forbidden_ld": F.count_if(c("_ld_forbidden"))}


@_source("rows_orders", "no_quote", "quoted", "orphan_customer", "orphan_quote", "orphan_terms",
         "cancelled_shipped", more=order_metrics)
def _orders(x: Inputs):
    c = F.col
    fks = [(["customer_id"], "customers", ["customer_id"]), (["quote_id"], "quotations", ["quote_id"]),
           (["terms_code"], "payment_terms", ["terms_code"]), (["order_id"], "dispatches", ["order_id"])]
    asked = [k for k, m in enumerate(("orphan_customer", "orphan_quote", "orphan_terms", "cancelled_shipped"))
             if x.wants(m)]
    base = with_parents(x.t, x.t.orders, [fks[k] for k in asked])
    flag = {k: at for at, k in enumerate(asked)}
    out = {"rows_orders": F.count(F.lit(1)), "no_quote": F.count_if(c("quote_id").isNull()),
           "quoted": F.count("quote_id"),
           **order_metrics()}
    for k, m in enumerate(("orphan_customer", "orphan_quote", "orphan_terms")):
        if k in flag:
            out[m] = F.count_if(orphaned(fks[k][0], flag[k]))
    if 3 in flag:
        out["cancelled_shipped"] = F.count_if(c("cancellation_date").isNotNull() & c(f"_fk{flag[3]}"))
    return base, out


@_source("orphan_line_order", "orphan_line_item")
def _order_lines(x: Inputs):
    fks = [(["order_id"], "orders", ["order_id"]), (["item_id"], "items", ["item_id"])]
    return (with_parents(x.t, x.t.order_lines.select("order_id", "item_id"), fks),
            {"orphan_line_order": F.count_if(orphaned(["order_id"], 0)),
             "orphan_line_item": F.count_if(orphaned(["item_id"], 1))})


@_source("rows_dispatches", "dispatched_nonpos", "orphan_dispatch")
def _dispatches(x: Inputs):
    base, out = x.t.dispatches, {"rows_dispatches": F.count(F.lit(1)),
                                 "dispatched_nonpos": F.count_if(F.col("dispatched_qty") <= 0)}
    if x.wants("orphan_dispatch"):
        keys = ["order_id", "line_no"]
        base = with_parents(x.t, base, [(keys, "order_lines", keys)])
        out["orphan_dispatch"] = F.count_if(orphaned(keys, 0))
    return base, out


@_source("orphan_quotation_line")
def _quotation_lines(x: Inputs):
    return (with_parents(x.t, x.t.quotation_lines.select("quote_id"), [(["quote_id"], "quotations", ["quote_id"])]),
            {"orphan_quotation_line": F.count_if(orphaned(["quote_id"], 0))})


@_source("rows_quotations")
def _counts(x: Inputs):
    return x.t.quotations, {"rows_quotations": F.count(F.lit(1))}


@_source("rows_customers")
def _customer_counts(x: Inputs):
    return x.t.customers, {"rows_customers": F.count(F.lit(1))}


@_source("rows_items")
def _item_counts(x: Inputs):
    return x.t["items"], {"rows_items": F.count(F.lit(1))}


@_source("dispatched_before_po")
def _dispatch_order(x: Inputs):
    both = x.t.dispatches.select("order_id", "dispatch_date").join(x.t.orders.select("order_id", "po_date"), "order_id")
    return both, {"dispatched_before_po": F.count_if(F.col("dispatch_date") < F.col("po_date"))}


@_source("po_before_quote")
def _order_quotation(x: Inputs):
    both = (x.t.orders.select("quote_id", "po_date").where("quote_id is not null")
            .join(x.t.quotations.select("quote_id", "quote_date"), "quote_id"))
    return both, {"po_before_quote": F.count_if(F.col("po_date") < F.col("quote_date"))}


@_source("gst_txt", "gst_bad")
def _gst(x: Inputs):
    """One row per market and currency (a few), then one text of them."""
    c, rate = F.col, x.p.gst_rate_pct
    bad = (F.when((c("market_type") == "Export") & ((c("currency") != "USD") | (c("gst_amount") != 0)), 1)
           .when(c("market_type").isin("Domestic", "Deemed Export")
                 & ((c("currency") != "INR") | (F.abs(c("gst_amount") * 100 - c("taxable_value") * rate) > 100)), 1)
           .otherwise(0))
    by = ["market_type", "currency"]
    groups = (x.t.invoices.join(x.t.customers.select("customer_id", "market_type"), "customer_id").groupBy(*by)
              .agg(F.sum((c("gst_amount") * 100).cast("long")).alias("g"),
                   F.sum((c("taxable_value") * 100).cast("long")).alias("tx"), F.sum(bad).alias("bad"))
              .select(*by, "bad", F.concat(c("market_type"), F.lit(" "), c("currency"), F.lit(" "),
                                           pct(c("g"), c("tx"), 1).cast("string"), F.lit("%")).alias("txt")))
    return groups, {"gst_txt": F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*by, "txt"))),
                                                        lambda s: s["txt"]), ", "), "gst_bad": F.sum("bad")}


@_source("jobs", "jobs_distinct", "job_bands", "jobs_band1")
def _jobs(x: Inputs):
    """One row per job number."""
    band = idiv(F.col("job_no"), x.p.job_band_width)
    per = (x.t.orders.where("job_no is not null").groupBy("job_no").agg(F.count(F.lit(1)).alias("n"))
           .withColumn("band", band))
    return per, {"jobs": F.coalesce(F.sum("n"), F.lit(0)), "jobs_distinct": F.count(F.lit(1)),
                 "job_bands": F.countDistinct("band"),
                 "jobs_band1": F.coalesce(F.sum(F.when(F.col("band") == 1, F.col("n"))), F.lit(0))}


@_source("over_shipped")
def _shipped(x: Inputs):
    keys = ["order_id", "line_no"]
    shipped = x.t.dispatches.groupBy(*keys).agg(F.sum("dispatched_qty").alias("shipped"))
    return (shipped.join(x.t.order_lines.select(*keys, "ordered_qty"), keys),
            {"over_shipped": F.count_if(F.col("shipped") > F.col("ordered_qty")
                                        * F.lit(x.p.overship_factor).cast("decimal(6,3)"))})


@_source("due", "otif", "on_time", "in_full")
def _otif(x: Inputs):
    return otif(x.t, x.p), {"due": F.count(F.lit(1)), "otif": F.sum("otif"), "on_time": F.sum("on_time"),
                            "in_full": F.sum("in_full")}


@_source("outside_allowlist")
def _identities(x: Inputs):
    """Distinct values outside the allowlists; cells inside them are dropped at the scan."""
    def outside(df, **allowed):
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(k).alias("col"), F.when(~F.col(k).isin(*v), F.col(k)).alias("value"))
            for k, v in allowed.items()]))).where("value is not null")
    strange = (x.t.customers.where(~F.col("customer_id").rlike(x.p.customer_id_pattern))
               .select(F.lit("customer_id").alias("col"), F.col("customer_id").alias("value")))
    cells = (outside(x.t.raw_quote_register, concerned_person=V.PEOPLE, incoterms=V.INCOTERMS,
                     quote_from=V.QUOTE_FROM, vertical=V.VERTICALS)
             .unionByName(outside(x.t.quotations, salesperson_code=V.PEOPLE)).unionByName(strange))
    return cells.distinct(), {"outside_allowlist": F.count(F.lit(1))}


class Check:
    """expected, the metrics it reads, and the actual text and verdict over them."""

    def __init__(self, expected: str, metrics, actual: Column | None, verdict: Column | None):
        self.expected, self.metrics, self.actual, self.verdict = expected, list(metrics), actual, verdict


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pf(cond: Column) -> Column:
    return F.when(cond, "PASS").otherwise("FAIL")


def _said(*parts) -> Column:
    """Texts and, in one-element lists, metrics, as one text."""
    return F.concat(*[_s(p[0]) if isinstance(p, list) else p if isinstance(p, Column) else F.lit(p) for p in parts])


def checks(p: Params) -> dict[str, Check]:
    """Every check as a formula over metrics."""
    c = F.col
    total = lambda names: reduce(lambda a, b: a + b, [c(n) for n in names])
    out: dict[str, Check] = {}

    def add(name, expected, metrics, actual, verdict):
        out[name] = Check(expected, metrics, actual, verdict)

    tables = ["customers", "items", "quotations", "orders", "dispatches", "invoices", "payments"]
    rows = ["rows_register", *[f"rows_{t}" for t in tables]]
    as_expected = F.lit(True) if p.expected_register_rows is None else c("rows_register") == p.expected_register_rows
    add("01 row counts", "register rows as expected, every table non-empty", rows,
        _said("register ", ["rows_register"], ", quotations ", ["rows_quotations"], ", orders ", ["rows_orders"],
              ", dispatches ", ["rows_dispatches"], ", invoices ", ["rows_invoices"], ", payments ", ["rows_payments"]),
        _pf(reduce(lambda a, b: a & b, [c(f"rows_{t}") > 0 for t in tables], as_expected)))

    # only the declared lines are listed (a few); any other text is just counted
    exp = p.expected_rows_per_line
    lines = sorted(exp or V.PRODUCT_LINES)
    per = [f"rows_line_{k}" for k in range(len(lines))]
    listed = F.concat_ws(", ", *[F.when(c(m) > 0, F.concat(F.lit(f"{v} "), _s(m))) for m, v in zip(per, lines)])
    other = F.when(c("rows_other_line") > 0, F.concat(F.lit(", other lines "), _s("rows_other_line"))).otherwise("")
    hits = reduce(lambda a, b: a & b, [c(m) > 0 if exp is None else c(m) == exp[v] for m, v in zip(per, lines)])
    add("02 rows per product line", "every product line present", [*per, "rows_other_line"],
        F.concat(listed, other), _pf(hits))

    orphans = ["orphan_customer", "orphan_quote", "orphan_terms", "orphan_line_order", "orphan_line_item",
               "orphan_dispatch", "orphan_invoice", "orphan_payment", "orphan_quotation_line"]
    add("03 orphaned foreign keys", "0 across every relationship", orphans,
        _said(total(orphans).cast("string"), " orphans"), _pf(total(orphans) == 0))
    add("04 dispatch on or after PO date", "0 violations", ["dispatched_before_po"],
        _said(["dispatched_before_po"], " dispatches before their own PO"), _pf(c("dispatched_before_po") == 0))
    add("05 invoice date = dispatch date", "0 mismatches", ["invoice_other_day"],
        _said(["invoice_other_day"], " mismatches"), _pf(c("invoice_other_day") == 0))
    add("06a quote <= PO (modelled tables)", "0 violations", ["po_before_quote", "quoted"],
        _said(["po_before_quote"], " of ", ["quoted"], " quoted orders have a PO before the quote"),
        _pf(c("po_before_quote") == 0))
    add("06b quote <= PO (raw register)", "at least one violation, modelled on purpose", ["quote_after_po"],
        _said(["quote_after_po"], " register rows with a quote date after the PO"),
        F.when(c("quote_after_po") >= 1, "EXPECTED").otherwise("FAIL"))
    add("07 invoice value = dispatched qty x price", f"0 rows off by more than {p.invoice_tolerance_inr} INR",
        ["invoice_off", "rows_invoices"],
        _said(["invoice_off"], " of ", ["rows_invoices"], " invoices out of tolerance"), _pf(c("invoice_off") == 0))
    add("08 GST by market", f"Domestic and Deemed Export {p.gst_rate_pct}% in INR, Export 0% in USD",
        ["gst_txt", "gst_bad"], c("gst_txt"), _pf(c("gst_bad") == 0))
    lo, hi = p.fx_usd_range
    add("09 FX rate by currency", f"INR invoices at 1.0, USD invoices between {lo:g} and {hi:g}", ["wrong_fx"],
        _said(["wrong_fx"], " invoices with the wrong FX rate"), _pf(c("wrong_fx") == 0))
    share = pct(c("jobs_band1"), c("jobs"), 1)
    add("10 job numbers unique and banded",
        f"all distinct, at least {p.min_job_bands} bands, about {p.job_band1_share_pct:g}% in band 1",
        ["jobs", "jobs_distinct", "job_bands", "jobs_band1"],
        _said(["jobs"], " job numbers, ", ["jobs_distinct"], " distinct, ", ["job_bands"], " bands, ",
              share.cast("string"), "% in band 1"),
        _pf((c("jobs") == c("jobs_distinct")) & (c("job_bands") >= p.min_job_bands)
            & (F.abs(share - p.job_band1_share_pct) <= p.job_band1_tolerance_pct)))
    add("11 payments do not exceed the invoice", "0 overpayments", ["overpaid"],
        _said(["overpaid"], " invoices paid more than billed"), _pf(c("overpaid") == 0))
    add("12 payment timing", "only Advance payments may predate the invoice", ["paid_early"],
        _said(["paid_early"], " non-advance payments before their invoice"), _pf(c("paid_early") == 0))
    add("13 dispatched quantities sane", "0 non-positive, 0 lines shipped more than ordered by over 1%",
        ["dispatched_nonpos", "over_shipped"],
        _said(["dispatched_nonpos"], " non-positive, ", ["over_shipped"], " over-shipped"),
        _pf((c("dispatched_nonpos") == 0) & (c("over_shipped") == 0)))
    add("14 cancelled orders never ship", "0 violations", ["cancelled_shipped"],
        _said(["cancelled_shipped"], " cancelled orders with a dispatch"), _pf(c("cancelled_shipped") == 0))
    lo, hi = p.otif_range_pct
    of_due = {m: pct(c(m), c("due"), 1).cast("string") for m in ("otif", "on_time", "in_full")}
    add("15 OTIF in range", f"between {lo:g}% and {hi:g}%", ["due", "otif", "on_time", "in_full"],
        _said("OTIF ", of_due["otif"], "% on ", ["due"], " orders due (on time ", of_due["on_time"], "%, in full ",
              of_due["in_full"], "%)"), _pf((F.lit(100.0) * c("otif") / c("due")).between(lo, hi)))
    lo, hi = p.no_quote_range_pct
    add("16 orders without a quotation", "a clear majority - most orders are repeat POs", ["rows_orders", "no_quote"],
        _said(pct(c("no_quote"), c("rows_orders"), 1).cast("string"), "% of orders have no quotation"),
        _pf((F.lit(100.0) * c("no_quote") / c("rows_orders")).between(lo, hi)))
    faults = ["dp_free_text", "date_impossible", "year_suspect", "quote_no_other"]
    add("17 register still carries its faults",
        "free-text DP dates, an impossible date, a wrong year, status words in the quote-number column", faults,
        _said(["dp_free_text"], " free-text DP, ", ["date_impossible"], " impossible date, ", ["year_suspect"],
              " wrong year, ", ["quote_no_other"], " status words in quote_no"),
        F.when(reduce(lambda a, b: a & b, [c(m) > 0 for m in faults]), "EXPECTED").otherwise("FAIL"))
    words = [*V.FORBIDDEN_STATUS[:2], V.FORBIDDEN_LD_FRAGMENT]
    found = ["forbidden_0", "forbidden_1", "forbidden_ld"]
    add("18 no invented vocabulary", ", ".join(f"no {w}" for w in words), found,
        F.concat_ws(", ", *[F.concat(_s(m), F.lit(f" {w}")) for m, w in zip(found, words)]), _pf(total(found) == 0))
    add("18b identity columns within allowlist", "every person, place and market value is one of the declared ones",
        ["outside_allowlist"], _said(["outside_allowlist"], " value(s) outside the allowlist"),
        _pf(c("outside_allowlist") == 0))
    add("19 status mapping is complete", "0 UNMAPPED - every wording in the data has a rule",
        ["unmapped", "status_wordings", "_states"],
        _said(["unmapped"], " unmapped, ", ["status_wordings"], " wordings collapsed to ", ["_states"], " states"),
        _pf(c("unmapped") == 0))
    # the log's own rows are counted
    add("20 cleaning log written", "every cleaning decision recorded, with a mix of actions",
        [*register_metrics(), *order_metrics()], None, None)
    return out


def _metric_row(tables, params: Params, asked: set[str]) -> DataFrame:
    """All asked metrics as one written row; each source is run once."""
    x, parts, kinds = Inputs(tables, params, asked), [], {}
    for source, names in _SOURCES:
        if not names() & {re.sub(r"^rows_line_[0-9]+$", "rows_line_*", k) for k in asked}:
            continue
        base, metrics = source(x)
        named = {k: v for k, v in metrics.items() if k in asked}
        if not named:
            continue
        one = base.agg(*[v.alias(k) for k, v in named.items()])
        # run and written one by one, so that the shuffle files of one source alone are on disk
        parts.append(staged(one.select(F.inline(F.array(*[F.struct(
            F.lit(k).alias("k"), (F.lit(None) if k.endswith("_txt") else F.col(k)).cast("long").alias("n"),
            (F.col(k) if k.endswith("_txt") else F.lit(None)).cast("string").alias("t")) for k in named]))),
            "check-source"))
        kinds.update({k: "t" if k.endswith("_txt") else "n" for k in named})
    both = reduce(DataFrame.unionByName, parts)
    return staged(both.agg(*[F.max(F.when(F.col("k") == k, F.col(v))).alias(k) for k, v in kinds.items()]),
                  "check-metrics")


def _rows_of(tables, names: list[str], params: Params) -> DataFrame:
    asked = {n: k for n, k in checks(params).items() if n in names}
    m = _metric_row(tables, params, {x for k in asked.values() for x in k.metrics})
    rows = [F.struct(F.lit(n).alias("check_name"), F.lit(k.expected).alias("expected"), k.actual.alias("actual"),
                     k.verdict.alias("verdict")) for n, k in asked.items() if k.actual is not None]
    parts = [m.select(F.inline(F.array(*rows)))] if rows else []
    for n, k in asked.items():
        if k.actual is None:
            log = log_rows(m, m).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("action").alias("a"))
            parts.append(log.select(
                F.lit(n).alias("check_name"), F.lit(k.expected).alias("expected"),
                _said(["n"], " entries across ", ["a"], " action types").alias("actual"),
                _pf((F.col("n") >= params.min_log_rows) & (F.col("a") >= params.min_log_actions)).alias("verdict")))
    return reduce(DataFrame.unionByName, parts)


def run_checks(tables, params: Params = DEFAULT) -> DataFrame:
    """All checks, one row each."""
    return _rows_of(tables, CHECK_NAMES, params)


def one_check(tables, name: str, params: Params = DEFAULT) -> DataFrame:
    """A single check: only the sources and metrics it needs are run."""
    return _rows_of(tables, [name], params)
