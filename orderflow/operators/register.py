"""Clean the all-text register into typed, flagged columns.

Nothing is silently fixed: a doubtful value becomes NULL in the typed column
and raises a flag, and the raw text stays next to it. One output row per raw
row. The whole operator is a single narrow projection plus one equi-join to
the customer master (for the market); the status, initials and LD rules are
literal MAP / IN-list expressions built from ``vocab`` (editable data, no
join, evaluated inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import dates as D
from ..functions.numeric import idiv
from ..functions.text import leading_int, leading_number, lookup
from ..params import DEFAULT, Params

RAW_COLUMNS = ["sl_no", "party", "project", "incoterms", "quote_from", "quote_no",
               "quote_date", "validity_date", "vertical", "category", "item", "item_qty",
               "inquiry", "inquiry_date", "job_no", "po_no", "po_date", "po_validity_date",
               "dp_date", "status", "ld", "ld_clause", "payment_terms", "po_quote_value",
               "concerned_person"]


def status_state(status: Column, became_order: Column) -> Column:
    """upper(trim(wording)) -> state; OPEN splits on whether the row is an order."""
    key = F.upper(F.trim(status))
    mapped = lookup(V.STATUS_MAP, key)
    return (F.when(key == V.OPEN_WORDING,
                   F.when(became_order, F.lit(V.OPEN_AS_ORDER)).otherwise(F.lit(V.OPEN_AS_QUOTE)))
            .otherwise(F.coalesce(mapped, F.lit(V.UNMAPPED))))


def ld_kind(ld: Column) -> Column:
    """What an LD cell actually holds. Order matters (a '%' wins over 'payment')."""
    low = F.lower(ld)
    return (F.when(ld.isNull(), F.lit(None).cast("string"))
            .when(ld.isin(*V.LD_FLAG_WORDS), "applicability flag")
            .when(ld == "Lost", "status in the wrong column")
            .when(F.instr(ld, "%") > 0, "genuine clause")
            .when(F.instr(low, "payment") > 0, "payment terms in the wrong column")
            .when(F.instr(ld, "00:00:00") > 0, "excel timestamp")
            .when(F.substring(ld, 1, 3).isin(*V.MONTH_PREFIXES),
                  "delivery month in the wrong column")
            .when((F.instr(low, "ld ") > 0) | (F.instr(low, "agreement") > 0), "genuine clause")
            .otherwise("other prose"))


def vertical_state(vertical: Column) -> Column:
    """Market wording -> Export / Domestic / NOT A MARKET / UNMAPPED."""
    up = F.upper(vertical)
    return (F.when(vertical.isNull(), F.lit(None).cast("string"))
            .when(up.startswith("EXPORT"), "Export")
            .when(up == "DOMESTIC", "Domestic")
            .when(up.isin("INTERNAL", "EXTERNAL"), "NOT A MARKET")
            .otherwise("UNMAPPED"))


def text_to_real(cell: Column) -> Column:
    """Blank -> NULL; otherwise the leading number, 0.0 when there is none
    (the source's text-to-real cast reads a numeric prefix and never fails)."""
    c = F.when(cell != "", cell)
    num = F.regexp_extract(c, r"^\s*([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?)", 1)
    return F.when(c.isNotNull(), F.coalesce(F.when(num != "", num).try_cast("double"),
                                            F.lit(0.0)))


def clean_register(raw: DataFrame, customers: DataFrame, params: Params = DEFAULT,
                   passthrough: tuple[str, ...] = ()) -> DataFrame:
    """The cleaned register (columns in the documented order)."""
    r = raw.select(*RAW_COLUMNS, *passthrough)
    cust = customers.select(F.col("customer_id").alias("_cid"),
                            F.col("market_type").alias("customer_market"))
    return _cleaned(r.join(cust, r.party == cust._cid, "left"), params, passthrough)


def clean_rows(raw: DataFrame, params: Params = DEFAULT,
               passthrough: tuple[str, ...] = ()) -> DataFrame:
    """The cleaned register without the two columns that need the customer's
    market: one narrow projection of one scan, no join."""
    market = F.lit(None).cast("string").alias("customer_market")
    return _cleaned(raw.select(*RAW_COLUMNS, *passthrough, market), params, passthrough).drop(
        "customer_market", "export_mislabelled")


def _cleaned(x: DataFrame, params: Params, passthrough: tuple[str, ...]) -> DataFrame:
    c = F.col
    q_iso, po_iso = D.iso_text(c("quote_date")), D.iso_text(c("po_date"))
    dp_iso, val_iso = D.iso_text(c("dp_date")), D.iso_text(c("validity_date"))
    x = x.select("*", q_iso.alias("_q_iso"), po_iso.alias("_po_iso"), dp_iso.alias("_dp_iso"),
                 val_iso.alias("_val_iso"))
    lo, hi = params.year_window
    po_year = F.coalesce(leading_int(F.substring(c("_po_iso"), 1, 4)), F.lit(0))
    qn = F.upper(F.trim(c("quote_no")))
    real = c("quote_no").isNotNull() & F.substring(qn, 1, 3).isin("VQ/", "VQ-")
    tender = c("quote_no").isNotNull() & (F.substring(qn, 1, 4) == "GEM/")
    other = (c("quote_no").isNotNull() & ~F.substring(qn, 1, 3).isin("VQ/", "VQ-")
             & (F.substring(qn, 1, 4) != "GEM/"))
    job = leading_int(c("job_no"))
    became_order = c("job_no").isNotNull() | c("po_no").isNotNull()
    ld_merged = F.coalesce(c("ld_clause"), c("ld"))
    person = F.trim(c("concerned_person"))
    vert_up = F.upper(c("vertical"))
    out = x.select(
        leading_int(c("sl_no")).alias("sl_no"),
        c("party").alias("customer_id"),
        "customer_market",
        "project",
        c("item").alias("product_line"),
        "category",
        D.valid_date(c("_q_iso")).alias("quote_date"),
        D.valid_date(c("_po_iso")).alias("po_date"),
        D.valid_date(c("_dp_iso")).alias("dp_date"),
        D.valid_date(c("_val_iso")).alias("validity_date"),
        (D.impossible(c("_dp_iso")) | D.impossible(c("_po_iso"))).alias("date_impossible"),
        (c("_po_iso").isNotNull() & ~po_year.between(lo, hi)).alias("year_suspect"),
        (c("dp_date").isNotNull() & c("_dp_iso").isNull()).alias("dp_is_free_text"),
        D.layout(c("po_date")).alias("po_date_format"),
        real.alias("quote_no_is_real"),
        tender.alias("quote_no_is_tender"),
        other.alias("quote_no_holds_other"),
        "quote_no",
        F.coalesce(F.instr(F.upper(c("quote_no")), "REV") > 0, F.lit(False))
        .alias("quote_is_revision"),
        job.alias("job_no"),
        (idiv(job, params.job_band_width) * params.job_band_width).alias("job_band"),
        "po_no",
        became_order.alias("became_order"),
        status_state(c("status"), became_order).alias("status_clean"),
        c("status").alias("status_raw"),
        ld_merged.alias("ld_merged"),
        F.when(c("ld_clause").isNotNull(), "ld_clause").when(c("ld").isNotNull(), "ld")
        .alias("ld_source"),
        (c("ld").isNotNull() & c("ld_clause").isNotNull()).alias("ld_both_populated"),
        ld_kind(ld_merged).alias("ld_kind"),
        c("vertical").alias("vertical_raw"),
        vertical_state(c("vertical")).alias("vertical_clean"),
        (c("vertical").isNotNull() & ~vert_up.startswith("EXPORT")
         & (c("customer_market") != "Domestic")).alias("export_mislabelled"),
        F.coalesce(lookup(V.INITIALS_MAP, person), person).alias("salesperson"),
        person.contains("/").alias("salesperson_two_names"),
        c("concerned_person").alias("salesperson_raw"),
        leading_number(c("po_quote_value")).alias("value_inr"),
        "incoterms",
        F.when(c("incoterms").isNotNull(),
               F.replace(F.upper(F.trim(c("incoterms"))), F.lit("EX WORKS"), F.lit("EX-WORKS")))
        .alias("incoterms_clean"),
        text_to_real(c("item_qty")).alias("item_qty"),
        *[c(p) for p in passthrough],
    )
    return out


# slim views over the cleaned register, one per flag group
GROUPS = {
    "dates": ["sl_no", "quote_date", "po_date", "dp_date", "validity_date", "date_impossible",
              "year_suspect", "dp_is_free_text", "po_date_format"],
    "quote_no": ["sl_no", "quote_no", "quote_no_is_real", "quote_no_is_tender",
                 "quote_no_holds_other", "quote_is_revision"],
    "job": ["sl_no", "job_no", "job_band", "po_no", "became_order"],
    "status": ["sl_no", "status_raw", "status_clean"],
    "ld": ["sl_no", "ld_merged", "ld_source", "ld_both_populated", "ld_kind"],
    "market": ["sl_no", "customer_id", "customer_market", "vertical_raw", "vertical_clean",
               "export_mislabelled"],
    "people": ["sl_no", "salesperson_raw", "salesperson", "salesperson_two_names"],
    "values": ["sl_no", "value_inr", "incoterms", "incoterms_clean", "item_qty"],
}
