"""The cleaning log - what was found, how many rows, what was done.

One aggregate pass over the cleaned register computes every count at once
(conditional counts plus the distinct counts), the row set is then produced
by unpivoting that single row; the two order-side entries come from one
aggregate over ``orders``. The LD group (L12) emits one row per kind present,
like a GROUP BY would; every other entry emits a row even at 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..params import DEFAULT, Params
from .register import clean_register

# (key, step, column, issue, action, note) in log order; L12 is expanded per kind
ENTRIES = [
    ("dates_parsed", "dates", "quote/po/dp/validity",
     "stored as text in three formats: dd.mm.yyyy, dd-mm-yyyy, yyyy-mm-dd", "PARSED",
     "Reordered by position and accepted only when the text is a real calendar day."),
    ("date_impossible", "dates", "dp_date", "impossible calendar date", "FLAGGED",
     "A day that does not exist in its month; left as typed, value NULL."),
    ("year_suspect", "dates", "po_date", "year outside the reporting window", "FLAGGED",
     "Kept as found; the intended year is not guessed."),
    ("dp_free_text", "dates", "dp_date", "free text instead of a date", "FLAGGED",
     "Wordings kept as typed."),
    ("status_wordings", "status", "status", "many wordings for one state", "MAPPED", None),
    ("status_open", "status", "status", '"Open" means two different things', "MAPPED",
     "Split by whether the row carries a PO or job number."),
    ("status_unusable", "status", "status", "value carries no usable meaning", "FLAGGED",
     "Left out of the funnel rather than forced into a state."),
    ("quote_no_other", "quote_no", "quote_no", "status word typed into the quote-number column",
     "FLAGGED", "Not counted as quotations."),
    ("quote_no_tender", "quote_no", "quote_no", "GEM tender ID instead of a quote number",
     "FLAGGED", "An inquiry reference, not a quotation issued."),
    ("ld_merged", "ld", "ld / ld_clause", "two columns for one concept", "MAPPED",
     "ld_clause wins where populated; ld_source records the column."),
    ("ld_both", "ld", "ld / ld_clause", "both columns populated on the same row", "FLAGGED",
     "ld_clause taken; the other value stays visible in the raw table."),
    ("ld_kind", "ld", "ld", None, "FLAGGED", "Classified rather than discarded."),
    ("vertical_other", "market", "vertical", "holds two unrelated taxonomies", "FLAGGED",
     "Internal/External rows carry no market."),
    ("export_mislabelled", "market", "vertical",
     "register says Domestic, customer master says export", "FLAGGED",
     "Flagged, not fixed: the two sources disagree."),
    ("people_initials", "people", "concerned_person",
     "same person recorded as a name and as initials", "MAPPED",
     "Initials tied back to the full name."),
    ("people_two", "people", "concerned_person", "two people in one cell", "FLAGGED",
     "Cannot be split without knowing who owned the row."),
    ("order_no_value", "coverage", "po_quote_value", "no value recorded on an order row",
     "FLAGGED", "Order values come from the order lines instead."),
    ("promised_from_po", "coverage", "dp_date", "promised delivery date taken from the PO document",
     "FILLED", None),
    ("promised_none", "coverage", "promised_delivery_date", "no delivery date agreed at all",
     "EXCLUDED", "Excluded from OTIF: nothing to measure against."),
]
LD_ISSUE = "value is not a liquidated-damages clause at all: "


def _cnt(cond):
    return F.count_if(F.coalesce(cond, F.lit(False)))


def register_metrics(market: bool = True) -> dict:
    """Every register-side count of the log, as aggregate expressions over the
    cleaned register (with the ``_any_date`` pass-through column); without
    ``market`` those that need no customer's market."""
    c, cnt = F.col, _cnt
    return {
        "dates_parsed": cnt(c("_any_date")),
        "date_impossible": cnt(c("date_impossible")),
        "year_suspect": cnt(c("year_suspect")),
        "dp_free_text": cnt(c("dp_is_free_text")),
        "status_wordings": F.countDistinct("status_raw"),
        "_states": F.countDistinct("status_clean"),
        "status_open": cnt(F.upper(F.trim(c("status_raw"))) == V.OPEN_WORDING),
        "status_unusable": cnt(c("status_clean").isin("UNUSABLE", V.UNMAPPED)),
        "quote_no_other": cnt(c("quote_no_holds_other")),
        "quote_no_tender": cnt(c("quote_no_is_tender")),
        "ld_merged": cnt(c("ld_merged").isNotNull()),
        "ld_both": cnt(c("ld_both_populated")),
        **{f"_ld_{i}": cnt(c("ld_kind") == k) for i, k in enumerate(V.LD_NOT_A_CLAUSE)},
        "vertical_other": cnt(c("vertical_clean") == "NOT A MARKET"),
        **({"export_mislabelled": cnt(c("export_mislabelled"))} if market else {}),
        "people_initials": F.countDistinct("salesperson_raw") - F.countDistinct("salesperson"),
        "people_two": cnt(c("salesperson_two_names")),
        "order_no_value": cnt(c("became_order") & c("value_inr").isNull()),
    }


def order_metrics() -> dict:
    c, cnt = F.col, _cnt
    return {"promised_from_po": cnt(c("promised_date_source") == "po_document"),
            "promised_none": cnt(c("promised_date_source") == "none"),
            "_from_register": cnt(c("promised_date_source") == "register"),
            "_orders": F.count(F.lit(1))}


def _named(metrics: dict) -> list:
    return [v.alias(k) for k, v in metrics.items()]


def with_any_date(raw: DataFrame) -> DataFrame:
    return raw.withColumn("_any_date",
                          F.col("po_date").isNotNull() | F.col("quote_date").isNotNull())


def cleaning_log(raw: DataFrame, customers: DataFrame, orders: DataFrame,
                 params: Params = DEFAULT) -> DataFrame:
    clean = clean_register(with_any_date(raw), customers, params, passthrough=("_any_date",))
    return log_rows(clean.agg(*_named(register_metrics())), orders.agg(*_named(order_metrics())))


def log_rows(reg: DataFrame, orders_agg: DataFrame) -> DataFrame:
    """The log from the two one-row aggregates (register side, order side)."""
    c = F.col
    rows = []
    for pos, (key, step, col, issue, action, note) in enumerate(ENTRIES, start=1):
        if key == "ld_kind":
            for i, kind in enumerate(V.LD_NOT_A_CLAUSE):
                rows.append((pos, kind, step, col, F.lit(LD_ISSUE + kind), c(f"_ld_{i}"),
                             action, F.lit(note), F.lit(True)))
            continue
        if key == "status_wordings":
            note_col = F.concat(F.lit("Collapsed to "), c("_states").cast("string"),
                                F.lit(" states; Appendix A prints the whole mapping."))
        elif key == "promised_from_po":
            note_col = F.concat(F.lit("The register gives a promised date on "),
                                c("_from_register").cast("string"), F.lit(" of "),
                                c("_orders").cast("string"),
                                F.lit(" orders; orders.promised_date_source says which is which."))
        else:
            note_col = F.lit(note)
        rows.append((pos, "", step, col, F.lit(issue), c(key), action, note_col, F.lit(False)))

    def entries(one_row, keys):
        structs = [F.struct(F.lit(pos).alias("pos"), F.lit(sub).alias("sub"),
                            F.lit(step).alias("step"), F.lit(col).alias("column_name"),
                            issue.alias("issue"), cnt_col.cast("long").alias("rows_found"),
                            F.lit(action).alias("action"), note.cast("string").alias("note"),
                            grouped.alias("grouped"))
                   for pos, sub, step, col, issue, cnt_col, action, note, grouped in rows
                   if ENTRIES[pos - 1][0] in keys]
        return one_row.select(F.inline(F.array(*structs)))

    order_keys = {"promised_from_po", "promised_none"}
    # two one-row aggregates, each unpivoted on its own and unioned (no join)
    log = entries(reg, {e[0] for e in ENTRIES} - order_keys).unionByName(
        entries(orders_agg, order_keys))
    log = log.filter(~c("grouped") | (c("rows_found") > 0))
    w = Window.partitionBy().orderBy("pos", "sub")
    return log.select(F.row_number().over(w).cast("long").alias("log_id"), "step", "column_name",
                      "issue", "rows_found", "action", "note")
