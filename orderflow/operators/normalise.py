"""Derive the normalised quotation / order / invoice tables from the register.

These are the data rules of the load step (the simulation around them is not
rebuilt). Register rows keep their ``sl_no`` as the stable id of the
quotation / order they become, so no global numbering window is needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.dates import strict_parse
from ..functions.numeric import cents_to_decimal, idiv
from ..functions.text import blank_to_null, leading_int
from ..params import DEFAULT, Params
from ..sources.staged import staged
from .blocks import numbered

DEFAULT_QUOTE_DATE = dt.date(2001, 1, 1)


def _rows(raw: DataFrame) -> DataFrame:
    """The register with empty cells as NULL and its serial number read (``_sl``,
    NULL where there is none). The register has no key, so every rule below works
    on the row itself; nothing is joined back by serial number."""
    return blank_to_null(raw).withColumn("_sl", leading_int(F.col("sl_no")))


def _is_quote() -> Column:
    return F.coalesce(F.col("quote_no").rlike(V.QUOTE_NO_PATTERN), F.lit(False))


def strict_dates(raw: DataFrame) -> DataFrame:
    """Every date cell parsed strictly (whole text, one of three layouts)."""
    return raw.select(leading_int(F.col("sl_no")).alias("sl_no"),
                      *[strict_parse(F.col(c)).alias(c) for c in
                        ("quote_date", "validity_date", "inquiry_date", "po_date", "dp_date")])


def quotation_rows(raw: DataFrame) -> DataFrame:
    """The rows whose quote-number cell is a real quote number."""
    return _rows(raw).filter(_is_quote()).select(F.col("_sl").alias("sl_no"), "quote_no")


def quote_number_parts(raw: DataFrame, carry: tuple = ()) -> DataFrame:
    """Quotation rows with the base number and the revision (0 if none, NULL
    and ``rev_unreadable`` when its digits exceed BIGINT)."""
    rev_txt = F.regexp_extract(F.col("quote_no"), V.REVISION_PATTERN, 1)
    base = F.regexp_replace(F.regexp_replace(F.col("quote_no"), V.REVISION_PATTERN, ""),
                            r"^\s+|\s+$", "")
    rev = F.when(rev_txt != "", rev_txt.try_cast("long")).otherwise(F.lit(0).cast("long"))
    return (_rows(raw).filter(_is_quote())
            .select(F.col("_sl").alias("sl_no"), base.alias("base"), rev.alias("rev"),
                    rev.isNull().alias("rev_unreadable"), *carry))


#: Revisions a cluster may span for its first rows to be taken by a partial limit.
USUAL_SPAN = 1000


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _early_places(clashing: DataFrame) -> DataFrame:
    """(base, low, early): per cluster of several revisions, the places (``_nth`` in
    register order) served before its highest revision, with the revision each gets.

    At each revision the waiting row first in register order is served. Before the
    highest revision there are ``span`` services at most, so no more than the first
    ``span`` rows of each revision matter, however many rows the cluster holds."""
    waiting = clashing.where((F.col("low") < F.col("high")) & (F.col("rev") < F.col("high"))).select(
        "base", "low", "high", "rev", "_nth", (F.col("high") - F.col("low")).alias("span"))
    rank = F.row_number().over(Window.partitionBy("base", "low", "rev").orderBy("_nth"))
    first = (waiting.where(F.col("span") <= USUAL_SPAN).withColumn("_k", rank)
             .where((F.col("_k") <= USUAL_SPAN) & (F.col("_k") <= F.col("span")))
             .unionByName(waiting.where(F.col("span") > USUAL_SPAN).withColumn("_k", rank)
                          .where(F.col("_k") <= F.col("span"))))
    steps = (first.groupBy("base", "low", "high", "rev").agg(F.sort_array(F.collect_list("_nth")).alias("rows"))
             .groupBy("base", "low", "high").agg(F.sort_array(F.collect_list(F.struct("rev", "rows"))).alias("steps")))
    state = "struct<wait:array<bigint>,out:array<struct<nth:bigint,rev:bigint>>>"

    def serve(acc: Column, k: Column) -> Column:
        step = F.col("steps")[k]
        until = F.when(k + 1 < F.size("steps"), F.col("steps")[F.least(k + 1, F.size("steps") - 1)]["rev"]
                       ).otherwise(F.col("high"))
        n = (until - step["rev"]).cast("int")
        return _let(F.array_sort(F.concat(acc["wait"], step["rows"])), lambda w: F.struct(
            F.slice(w, n + 1, F.size(w)).alias("wait"),
            F.concat(acc["out"], F.transform(F.slice(w, F.lit(1), n), lambda q, i: F.struct(
                q.alias("nth"), (step["rev"] + i).alias("rev")))).alias("out")))

    served = F.aggregate(F.sequence(F.lit(0), F.size("steps") - 1),
                         F.struct(F.array().alias("wait"), F.array().alias("out")).cast(state), serve)
    return steps.select("base", "low", F.array_sort(served["out"]).alias("early"))


def dedupe_revisions(parts: DataFrame) -> DataFrame:
    """A (base, revision) seen before is bumped to the next free revision, in
    register order (serial number, then the other columns; rows equal in all of
    them are interchangeable). Unreadable revisions stay as they are.

    Which revisions end up taken does not depend on the order. With the distinct
    revisions of a base ascending, the next free one after each is
    C + max(rev - C before), C being the running count; where a revision starts
    at or beyond that, nothing earlier reaches it, and a new cluster begins. A
    cluster without a clash stays as it is. In one with a clash, each revision goes
    to the row first in register order among those that wait for it (the same
    numbers as bumping row by row: both are the only stable assignment of rows that
    prefer low revisions to revisions that prefer early rows). So the rows left at
    the highest revision follow it in register order, which is a numbering spread
    over all tasks; only the few that are served earlier are gone through in turn.
    """
    names = parts.columns
    parts = staged(parts, "quote-parts")
    known = parts.filter(F.col("rev").isNotNull())
    counts = known.groupBy("base", "rev").agg(F.count("*").alias("n"))
    by = Window.partitionBy("base").orderBy("rev")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    ahead = F.sum("n").over(upto) - F.col("n")
    counts = counts.withColumn("ahead", ahead).withColumn(
        "free", F.col("ahead") + F.col("n") + F.max(F.col("rev") - F.col("ahead")).over(upto))
    starts = F.coalesce(F.col("rev") >= F.lag("free").over(by), F.lit(True))
    counts = counts.withColumn("low", F.last(F.when(starts, F.col("rev")), ignorenulls=True).over(upto))
    whole = Window.partitionBy("base", "low")
    asked = staged(counts.withColumns({"high": F.max("rev").over(whole), "rows": F.sum("n").over(whole),
                                       "revs": F.count("*").over(whole)})
                   .where("rows > revs").select("base", "rev", "low", "high"), "clusters")
    order = [F.col(c).asc_nulls_last() for c in
             ["sl_no", *[c for c in names if c not in ("sl_no", "base", "rev")], "rev"]]
    clashing = numbered(known.join(asked, ["base", "rev"]), ["base", "low"], order, "_nth")
    done = clashing.join(_early_places(clashing), ["base", "low"], "left")
    # places already served, up to this row; mostly all of them lie before it
    early, nth = F.col("early"), F.col("_nth")
    last = F.get(early, F.size(early) - 1)["nth"]
    before = F.when(nth > last, F.size(early)).otherwise(F.size(F.filter(early, lambda e: e["nth"] < nth)))
    at = F.array_position(F.transform(early, lambda e: e["nth"]), nth).cast("int")
    rev = (F.when(early.isNull(), F.col("high") + nth - 1)
           .when((nth <= last) & (at > 0), F.get(early, at - 1)["rev"])
           .otherwise(F.col("high") + nth - before - 1))
    moved = done.withColumn("rev", rev).select(*names)
    still = known.join(asked.select("base", "rev"), ["base", "rev"], "left_anti").select(*names)
    return still.unionByName(moved).unionByName(parts.filter(F.col("rev").isNull()))


def quote_dates(raw: DataFrame) -> DataFrame:
    """The quotation's date, else the order's, else the default."""
    return _rows(raw).filter(_is_quote()).select(F.col("_sl").alias("quote_id"),
                                                 _quote_date().alias("quote_date"))


def _quote_date():
    return F.coalesce(strict_parse(F.col("quote_date")), strict_parse(F.col("po_date")),
                      F.lit(DEFAULT_QUOTE_DATE))


QUOTE_COLUMNS = ("party", "quote_date", "validity_date", "inquiry_date", "po_date", "incoterms",
                 "concerned_person", "status")


def quotations(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The quotation table (quote_id = serial number), one row per quotation row."""
    return dedupe_revisions(quote_number_parts(raw, QUOTE_COLUMNS)).select(
        F.col("sl_no").alias("quote_id"), F.col("base").alias("quote_no"),
        F.col("rev").alias("revision_no"), F.col("party").alias("customer_id"),
        strict_parse(F.col("inquiry_date")).alias("inquiry_date"),
        _quote_date().alias("quote_date"),
        strict_parse(F.col("validity_date")).alias("validity_date"),
        "incoterms", F.col("concerned_person").alias("salesperson_code"), "status")


def _order_rows(raw: DataFrame) -> DataFrame:
    return _rows(raw).filter(F.col("job_no").isNotNull() | F.col("po_no").isNotNull()).withColumn(
        "order_id", F.col("_sl"))


def order_rows(raw: DataFrame) -> DataFrame:
    """Rows with a job or PO number."""
    return _order_rows(raw).select("order_id", "po_no", leading_int(F.col("job_no")).alias("job_no"))


def _promised(rows: DataFrame, po_documents: DataFrame) -> DataFrame:
    """The register's promised date, else the PO document's, and its source."""
    dp = strict_parse(F.col("dp_date"))
    return (rows.join(po_documents.select(F.col("sl_no").alias("_sl"), "po_promised"), "_sl", "left")
            .withColumn("promised_delivery_date", F.coalesce(dp, F.col("po_promised")))
            .withColumn("promised_date_source",
                        F.when(dp.isNotNull(), "register")
                        .when(F.col("po_promised").isNotNull(), "po_document").otherwise("none")))


def promised_dates(raw: DataFrame, po_documents: DataFrame) -> DataFrame:
    return _promised(_order_rows(raw), po_documents).select(
        "order_id", "promised_delivery_date", "promised_date_source")


def _ld():
    """The LD clause column wins where it is filled."""
    return [F.coalesce(F.col("ld_clause"), F.col("ld")).alias("ld_clause"),
            F.when(F.col("ld_clause").isNotNull(), "ld_clause_column")
            .when(F.col("ld").isNotNull(), "ld_column").alias("ld_clause_source")]


def ld_merge(raw: DataFrame) -> DataFrame:
    return _order_rows(raw).select("order_id", *_ld())


def _cancelled():
    return F.col("status").isin(*V.CANCELLED_WORDS).alias("is_cancelled")


def cancelled(raw: DataFrame) -> DataFrame:
    """Whether the wording is a cancellation (NULL without a wording)."""
    return _order_rows(raw).select("order_id", F.col("status").alias("order_status"), _cancelled())


def orders(raw: DataFrame, po_documents: DataFrame, payment_terms: DataFrame) -> DataFrame:
    """The order table from register rows with a job or PO number. A row
    that is a quotation too is linked to it (its own serial number).

    ``po_documents`` (sl_no, po_promised) carries the promised dates read off
    the PO documents; ``payment_terms`` maps a wording to its code."""
    terms = payment_terms.select(F.col("description").alias("payment_terms"), "terms_code")
    rows = _order_rows(raw).withColumn("_quote", _is_quote())
    return (_promised(rows, po_documents).join(terms, "payment_terms", "left").select(
        "order_id", F.when(F.col("_quote"), F.col("order_id")).alias("quote_id"),
        "po_no", strict_parse(F.col("po_date")).alias("po_date"),
        leading_int(F.col("job_no")).alias("job_no"), F.col("party").alias("customer_id"),
        "promised_delivery_date", "promised_date_source", "terms_code", *_ld(),
        F.col("status").alias("order_status"), _cancelled()))


def payment_terms_use(raw: DataFrame, orders_df: DataFrame, payment_terms: DataFrame) -> DataFrame:
    """The payment-terms dimension (wording -> credit days and advance share),
    with the register rows that carry the wording and the orders that carry the code."""
    worded = raw.groupBy(F.col("payment_terms").alias("description")).agg(F.count("*").alias("register_rows"))
    coded = orders_df.groupBy("terms_code").agg(F.count("*").alias("orders"))
    return (payment_terms.join(worded, "description", "left").join(coded, "terms_code", "left")
            .select("terms_code", "description", F.col("credit_days").cast("long").alias("credit_days"),
                    "advance_pct", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                     for c in ("register_rows", "orders")]))


def derive_invoices(dispatches: DataFrame, order_lines: DataFrame, orders_df: DataFrame,
                    customers: DataFrame, payment_terms: DataFrame, fx_monthly: DataFrame,
                    params: Params = DEFAULT) -> DataFrame:
    """One invoice per dispatch. Value = qty x price; Export invoices are
    in USD at the month's rate and zero-rated, the rest INR with GST; the due
    date is the dispatch date plus the terms' credit days. Amounts are rounded
    half away from zero to the cent."""
    d = (dispatches.select("dispatch_id", "order_id", "line_no", "dispatch_date",
                           "dispatched_qty")
         .join(order_lines.select("order_id", "line_no", "unit_price"), ["order_id", "line_no"])
         .join(orders_df.select("order_id", "customer_id", "terms_code"), "order_id")
         .join(customers.select("customer_id", "market_type"), "customer_id", "left")
         .join(payment_terms.select("terms_code", "credit_days"), "terms_code", "left")
         .join(fx_monthly, F.date_format("dispatch_date", "yyyy-MM")
               == F.col("month_key"), "left"))
    export = F.col("market_type") == "Export"
    inr_cents = (F.round(F.col("dispatched_qty") * F.col("unit_price"), 2) * 100).cast("long")
    fx_cents = (F.col("fx_rate") * 100).cast("long")
    taxable = F.when(export, idiv(inr_cents * 200 + fx_cents, fx_cents * 2)).otherwise(inr_cents)
    gst = F.when(export, F.lit(0).cast("long")).otherwise(
        idiv(inr_cents * (2 * params.gst_rate_pct) + 100, 200))
    return d.select(
        F.col("dispatch_id").alias("invoice_id"),
        F.concat(F.lit("INV/"), F.col("dispatch_id").cast("string")).alias("invoice_no"),
        "dispatch_id", "order_id", "customer_id", F.col("dispatch_date").alias("invoice_date"),
        F.when(export, "USD").otherwise("INR").alias("currency"),
        F.when(export, F.col("fx_rate")).otherwise(F.lit(1).cast("decimal(18,2)"))
        .cast("decimal(18,2)").alias("fx_rate_to_inr"),
        cents_to_decimal(taxable).alias("taxable_value"),
        cents_to_decimal(gst).alias("gst_amount"),
        F.date_add("dispatch_date", F.col("credit_days")).alias("due_date"))


def register_totals(raw: DataFrame, links: DataFrame, order_lines: DataFrame,
                    quotation_lines: DataFrame) -> DataFrame:
    """One row per register row. value (sum qty x price) and quantity of the
    order's lines if the row became an order, else of the quotation's lines, NULL
    where it is neither; ``value_cell`` and ``qty_cell`` are what the register's
    own cells then hold: only filled cells are overwritten."""
    o = order_lines.groupBy("order_id").agg(
        F.sum(F.col("ordered_qty") * F.col("unit_price")).alias("_ov"),
        F.sum("ordered_qty").alias("_oq"))
    q = quotation_lines.groupBy("quote_id").agg(
        F.sum(F.col("qty") * F.col("unit_price")).alias("_qv"), F.sum("qty").alias("_qq"))
    rows = _rows(raw).select(F.col("_sl").alias("sl_no"), "po_quote_value", "item_qty")
    # links without an order or quotation are not joined: they would all meet in one task
    number = lambda v, n: (F.round(F.col(v), 2).cast("double").alias("_value"),
                           F.col(n).cast("double").alias("_qty"))
    none = [F.lit(None).cast("double").alias(c) for c in ("_value", "_qty")]
    totals = (links.where("order_id is not null").join(o, "order_id", "left").select("sl_no", *number("_ov", "_oq"))
              .unionByName(links.where("order_id is null and quote_id is not null").join(q, "quote_id", "left")
                           .select("sl_no", *number("_qv", "_qq")))
              .unionByName(links.where("order_id is null and quote_id is null").select("sl_no", *none)))
    value, qty = F.col("_value"), F.col("_qty")
    return rows.join(totals, "sl_no", "left").select(
        "sl_no", value.alias("value_inr"), qty.alias("qty"),
        F.when(F.col("po_quote_value").isNotNull(), value).alias("value_cell"),
        F.when(F.col("item_qty").isNotNull(), qty).alias("qty_cell"))


def link_summary(orders_df: DataFrame) -> DataFrame:
    """How many orders link to a quotation and where promised dates come from."""
    c = F.col
    return orders_df.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(c("quote_id").isNotNull()).alias("linked"),
        F.count_if(c("promised_date_source") == "register").alias("from_register"),
        F.count_if(c("promised_date_source") == "po_document").alias("from_po_document"),
        F.count_if(c("promised_date_source") == "none").alias("no_date"),
    ).select(*[c(x).cast("long").alias(x) for x in
               ("orders", "linked", "from_register", "from_po_document", "no_date")])
