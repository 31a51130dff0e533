"""DuckDB twins of the normalisation rules.

N4's twin takes the rows of a base one by one, in register order, and looks for
the first free revision in the list of those taken: the rule as the source
words it, and another way than the Spark operator's clusters.
"""

from __future__ import annotations

from .. import vocab as V
from ..operators.normalise import DEFAULT_QUOTE_DATE
from ..params import DEFAULT, Params
from .oracle_register import _lead_int
from .oracle_tables import sql_in

QP = V.QUOTE_NO_PATTERN
RP = V.REVISION_PATTERN


def strict(c: str) -> str:
    t = f"trim({c})"
    return ("coalesce("
            f"CASE WHEN regexp_full_match({t}, '^[0-9]{{1,2}}\\.[0-9]{{1,2}}\\.[0-9]{{4}}$') "
            f"THEN CAST(try_strptime({t}, '%d.%m.%Y') AS DATE) END, "
            f"CASE WHEN regexp_full_match({t}, '^[0-9]{{1,2}}-[0-9]{{1,2}}-[0-9]{{4}}$') "
            f"THEN CAST(try_strptime({t}, '%d-%m-%Y') AS DATE) END, "
            f"CASE WHEN regexp_full_match({t}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') "
            f"THEN CAST(try_strptime({t}, '%Y-%m-%d') AS DATE) END)")


def n1_sql(p: Params = DEFAULT) -> str:
    cols = ", ".join(f"{strict(c)} AS {c}" for c in
                     ("quote_date", "validity_date", "inquiry_date", "po_date", "dp_date"))
    return f"SELECT {_lead_int('sl_no')} AS sl_no, {cols} FROM ob_raw_register"


def _parts() -> str:
    rev = f"regexp_extract(quote_no, '{RP}', 1)"
    return f"""
qparts AS (
  SELECT {_lead_int('sl_no')} AS sl_no,
         regexp_replace(regexp_replace(quote_no, '{RP}', '', 'g'), '^\\s+|\\s+$', '', 'g') AS base,
         CASE WHEN {rev} <> '' THEN TRY_CAST({rev} AS BIGINT) ELSE 0 END AS rev,
         CASE WHEN {rev} <> '' THEN TRY_CAST({rev} AS BIGINT) IS NULL ELSE FALSE END AS rev_unreadable,
         party, quote_date, validity_date, inquiry_date, po_date, incoterms, concerned_person, status
  FROM ob_raw_register WHERE regexp_matches(quote_no, '{QP}')
)"""


def _folded(keys: str) -> str:
    return _parts() + f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY base ORDER BY sl_no NULLS LAST, {keys}) AS i
  FROM qparts WHERE rev IS NOT NULL
),
walk AS (
  SELECT base, i, rev AS got, [rev] AS taken FROM numbered WHERE i = 1
  UNION ALL
  SELECT base, i, free, list_append(taken, free)
  FROM (SELECT n.base, n.i, w.taken,
               list_min(list_filter(range(n.rev, n.rev + len(w.taken) + 1),
                                    lambda v: NOT list_contains(w.taken, v))) AS free
        FROM walk w JOIN numbered n ON n.base = w.base AND n.i = w.i + 1) s
),
folded AS (
  SELECT n.* REPLACE (w.got AS rev) FROM numbered n JOIN walk w USING (base, i)
  UNION ALL
  SELECT *, NULL FROM qparts WHERE rev IS NULL
)"""


def n3_sql(p: Params = DEFAULT) -> str:
    return _parts() + "\nSELECT sl_no, base, rev, rev_unreadable FROM qparts"


def n4_sql(p: Params = DEFAULT) -> str:
    return _folded("rev_unreadable, rev") + "\nSELECT sl_no, base, rev, rev_unreadable FROM folded"


def _quotations() -> str:
    return _folded("rev_unreadable, party, quote_date, validity_date, inquiry_date, po_date, "
                   "incoterms, concerned_person, status, rev") + f""",
n_quotes AS (
  SELECT sl_no AS quote_id, base AS quote_no, rev AS revision_no, party AS customer_id,
         {strict('inquiry_date')} AS inquiry_date,
         coalesce({strict('quote_date')}, {strict('po_date')},
                  DATE '{DEFAULT_QUOTE_DATE.isoformat()}') AS quote_date,
         {strict('validity_date')} AS validity_date, nullif(incoterms, '') AS incoterms,
         concerned_person AS salesperson_code, status
  FROM folded
)"""


def n6_sql(p: Params = DEFAULT) -> str:
    return _quotations() + "\nSELECT * FROM n_quotes"


def _orders() -> str:
    po_docs = ("SELECT K * 2 + 1 AS sl_no, promised_delivery_date AS po_promised "
               "FROM ob_order_base WHERE promised_date_source = 'po_document'")
    return f"""
n_orders AS (
  SELECT {_lead_int('r.sl_no')} AS order_id,
         CASE WHEN regexp_matches(r.quote_no, '{QP}') THEN {_lead_int('r.sl_no')} END AS quote_id,
         r.po_no, {strict('r.po_date')} AS po_date, {_lead_int('r.job_no')} AS job_no,
         r.party AS customer_id,
         coalesce({strict('r.dp_date')}, pd.po_promised) AS promised_delivery_date,
         CASE WHEN {strict('r.dp_date')} IS NOT NULL THEN 'register'
              WHEN pd.po_promised IS NOT NULL THEN 'po_document' ELSE 'none' END
           AS promised_date_source,
         t.terms_code,
         coalesce(r.ld_clause, r.ld) AS ld_clause,
         CASE WHEN r.ld_clause IS NOT NULL THEN 'ld_clause_column'
              WHEN r.ld IS NOT NULL THEN 'ld_column' END AS ld_clause_source,
         r.status AS order_status,
         coalesce(r.status IN {sql_in(V.CANCELLED_WORDS)}, FALSE) AS is_cancelled_
  FROM ob_raw_register r
  LEFT JOIN ({po_docs}) pd ON pd.sl_no = {_lead_int('r.sl_no')}
  LEFT JOIN ob_payment_terms t ON t.description = r.payment_terms
  WHERE r.job_no IS NOT NULL OR r.po_no IS NOT NULL
)"""


def n11_sql(p: Params = DEFAULT) -> str:
    return _orders() + ("\nSELECT * EXCLUDE (is_cancelled_), "
                        "CASE WHEN order_status IS NULL THEN NULL ELSE is_cancelled_ END "
                        "AS is_cancelled FROM n_orders")


def n13_sql(p: Params = DEFAULT) -> str:
    return ("SELECT * EXCLUDE (fx_rate_to_inr, taxable_value, gst_amount), "
            "CAST(fx_rate_to_inr AS DOUBLE) AS fx_rate_to_inr, "
            "CAST(taxable_value AS DOUBLE) AS taxable_value, "
            "CAST(gst_amount AS DOUBLE) AS gst_amount FROM ob_invoices")


def n14_sql(p: Params = DEFAULT) -> str:
    return f"""
links AS (
  SELECT K * 2 + 1 AS sl_no, K AS order_id, CAST(NULL AS BIGINT) AS quote_id FROM ob_order_base
  UNION ALL
  SELECT K * 2 + 2, NULL, K * 2 + 1 FROM ob_order_base WHERE NOT linked AND K % 7 = 0
),
ov AS (SELECT order_id, SUM(ordered_qty * unit_price) AS v, SUM(ordered_qty) AS qn
       FROM ob_order_lines GROUP BY order_id),
qv AS (SELECT quote_id, SUM(qty * unit_price) AS v, SUM(qty) AS qn
       FROM ob_quotation_lines GROUP BY quote_id)
SELECT sl_no, value_inr, qty, CASE WHEN po_quote_value <> '' THEN value_inr END AS value_cell,
       CASE WHEN item_qty <> '' THEN qty END AS qty_cell
FROM (SELECT r.sl_no, r.po_quote_value, r.item_qty,
             CAST(round(CASE WHEN l.order_id IS NOT NULL THEN ov.v ELSE qv.v END, 2) AS DOUBLE) AS value_inr,
             CAST(CASE WHEN l.order_id IS NOT NULL THEN ov.qn ELSE qv.qn END AS DOUBLE) AS qty
      FROM (SELECT {_lead_int('sl_no')} AS sl_no, po_quote_value, item_qty FROM ob_raw_register) r
      LEFT JOIN links l ON l.sl_no = r.sl_no
      LEFT JOIN ov ON ov.order_id = l.order_id LEFT JOIN qv ON qv.quote_id = l.quote_id)"""


def n15_sql(p: Params = DEFAULT) -> str:
    c = lambda cond: f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
    return _orders() + f"""
SELECT CAST(COUNT(*) AS BIGINT) AS orders, {c('quote_id IS NOT NULL')} AS linked,
       {c("promised_date_source = 'register'")} AS from_register,
       {c("promised_date_source = 'po_document'")} AS from_po_document,
       {c("promised_date_source = 'none'")} AS no_date
FROM n_orders"""



def n_slim_sql(kind: str) -> str:
    """Twins of the slim N views (projections of the quotation / order rules)."""
    if kind == "n2":
        return (_parts() + "\nSELECT r.sl_no, r.quote_no FROM (SELECT "
                f"{_lead_int('sl_no')} AS sl_no, quote_no FROM ob_raw_register "
                f"WHERE regexp_matches(quote_no, '{QP}')) r")
    if kind == "n5":
        return (_parts() + f"\nSELECT sl_no AS quote_id, coalesce({strict('quote_date')}, "
                f"{strict('po_date')}, DATE '{DEFAULT_QUOTE_DATE.isoformat()}') AS quote_date FROM qparts")
    cols = {"n7": "order_id, po_no, job_no",
            "n8": "order_id, promised_delivery_date, promised_date_source",
            "n9": "order_id, ld_clause, ld_clause_source",
            "n10": ("order_id, order_status, CASE WHEN order_status IS NULL THEN NULL "
                    "ELSE is_cancelled_ END AS is_cancelled")}[kind]
    return _orders() + f"\nSELECT {cols} FROM n_orders"


def n12_sql(p: Params = DEFAULT) -> str:
    return """
SELECT t.terms_code, t.description, CAST(t.credit_days AS BIGINT) AS credit_days, t.advance_pct,
       (SELECT count(*) FROM ob_raw_register r WHERE r.payment_terms = t.description) AS register_rows,
       (SELECT count(*) FROM ob_orders o WHERE o.terms_code = t.terms_code) AS orders
FROM ob_payment_terms t"""
