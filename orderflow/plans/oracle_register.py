"""DuckDB twins for the register cleaning, the cleaning log, Q11 and Appendix A."""

from __future__ import annotations

from .. import vocab as V
from ..operators.audit_log import ENTRIES, LD_ISSUE
from ..params import DEFAULT, Params
from .oracle_queries import pct, rr
from .oracle_tables import q, sql_in

SHAPE = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"


def _iso(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR length(trim({c})) <> 10 THEN NULL "
            f"WHEN substr({c}, 3, 1) IN ('.', '-') "
            f"THEN substr({c}, 7, 4) || '-' || substr({c}, 4, 2) || '-' || substr({c}, 1, 2) "
            f"WHEN substr({c}, 5, 1) = '-' THEN {c} END")


def _date(iso: str) -> str:
    return f"CAST(try_strptime({iso}, '%Y-%m-%d') AS DATE)"


def _impossible(iso: str) -> str:
    return (f"(CASE WHEN {iso} IS NULL THEN FALSE "
            f"WHEN regexp_full_match({iso}, '{SHAPE}') AND {_date(iso)} IS NULL THEN TRUE "
            f"WHEN regexp_full_match({iso}, '{SHAPE}') THEN FALSE END)")


def _lead_int(c: str) -> str:
    return (f"CASE WHEN regexp_matches({c}, '^[0-9]') "
            f"THEN TRY_CAST(regexp_extract({c}, '^([0-9]+)', 1) AS BIGINT) END")


def _case_map(key: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {key} {whens} END"


def register_cte(p: Params = DEFAULT) -> str:
    lo, hi = p.year_window
    w = p.job_band_width
    months = sql_in(V.MONTH_PREFIXES)
    ld = "coalesce(x.ld_clause, x.ld)"
    return f"""
reg_x AS (
  SELECT r.*, c.market_type AS customer_market,
         {_iso('r.quote_date')} AS q_iso, {_iso('r.po_date')} AS po_iso,
         {_iso('r.dp_date')} AS dp_iso, {_iso('r.validity_date')} AS val_iso,
         r.job_no IS NOT NULL OR r.po_no IS NOT NULL AS became_order_,
         upper(trim(r.quote_no)) AS qn
  FROM ob_raw_register r LEFT JOIN ob_customers c ON c.customer_id = r.party
),
v_reg AS (
  SELECT {_lead_int('x.sl_no')} AS sl_no,
         x.party AS customer_id, x.customer_market, x.project, x.item AS product_line, x.category,
         {_date('x.q_iso')} AS quote_date, {_date('x.po_iso')} AS po_date,
         {_date('x.dp_iso')} AS dp_date, {_date('x.val_iso')} AS validity_date,
         {_impossible('x.dp_iso')} OR {_impossible('x.po_iso')} AS date_impossible,
         x.po_iso IS NOT NULL AND COALESCE({_lead_int('substr(x.po_iso, 1, 4)')}, 0)
           NOT BETWEEN {lo} AND {hi} AS year_suspect,
         x.dp_date IS NOT NULL AND x.dp_iso IS NULL AS dp_is_free_text,
         CASE WHEN x.po_date IS NULL THEN NULL
              WHEN substr(x.po_date, 3, 1) = '.' THEN 'dd.mm.yyyy'
              WHEN substr(x.po_date, 3, 1) = '-' THEN 'dd-mm-yyyy'
              WHEN substr(x.po_date, 5, 1) = '-' THEN 'yyyy-mm-dd'
              ELSE 'unrecognised' END AS po_date_format,
         x.quote_no IS NOT NULL AND substr(x.qn, 1, 3) IN ('VQ/', 'VQ-') AS quote_no_is_real,
         x.quote_no IS NOT NULL AND substr(x.qn, 1, 4) = 'GEM/' AS quote_no_is_tender,
         x.quote_no IS NOT NULL AND substr(x.qn, 1, 3) NOT IN ('VQ/', 'VQ-')
           AND substr(x.qn, 1, 4) <> 'GEM/' AS quote_no_holds_other,
         x.quote_no,
         CASE WHEN instr(upper(x.quote_no), 'REV') > 0 THEN TRUE ELSE FALSE END AS quote_is_revision,
         {_lead_int('x.job_no')} AS job_no,
         ({_lead_int('x.job_no')}) // {w} * {w} AS job_band,
         x.po_no,
         x.became_order_ AS became_order,
         CASE WHEN upper(trim(x.status)) = 'OPEN'
              THEN CASE WHEN x.became_order_ THEN {q(V.OPEN_AS_ORDER)} ELSE {q(V.OPEN_AS_QUOTE)} END
              ELSE coalesce({_case_map('upper(trim(x.status))', V.STATUS_MAP)}, {q(V.UNMAPPED)})
         END AS status_clean,
         x.status AS status_raw,
         {ld} AS ld_merged,
         CASE WHEN x.ld_clause IS NOT NULL THEN 'ld_clause' WHEN x.ld IS NOT NULL THEN 'ld' END
           AS ld_source,
         x.ld IS NOT NULL AND x.ld_clause IS NOT NULL AS ld_both_populated,
         CASE WHEN {ld} IS NULL THEN NULL
              WHEN {ld} IN {sql_in(V.LD_FLAG_WORDS)} THEN 'applicability flag'
              WHEN {ld} = 'Lost' THEN 'status in the wrong column'
              WHEN instr({ld}, '%') > 0 THEN 'genuine clause'
              WHEN instr(lower({ld}), 'payment') > 0 THEN 'payment terms in the wrong column'
              WHEN instr({ld}, '00:00:00') > 0 THEN 'excel timestamp'
              WHEN substr({ld}, 1, 3) IN {months} THEN 'delivery month in the wrong column'
              WHEN instr(lower({ld}), 'ld ') > 0 OR instr(lower({ld}), 'agreement') > 0
                THEN 'genuine clause'
              ELSE 'other prose' END AS ld_kind,
         x.vertical AS vertical_raw,
         CASE WHEN x.vertical IS NULL THEN NULL
              WHEN upper(x.vertical) LIKE 'EXPORT%' THEN 'Export'
              WHEN upper(x.vertical) = 'DOMESTIC' THEN 'Domestic'
              WHEN upper(x.vertical) IN ('INTERNAL', 'EXTERNAL') THEN 'NOT A MARKET'
              ELSE 'UNMAPPED' END AS vertical_clean,
         x.vertical IS NOT NULL AND upper(x.vertical) NOT LIKE 'EXPORT%'
           AND x.customer_market <> 'Domestic' AS export_mislabelled,
         coalesce({_case_map('trim(x.concerned_person)', V.INITIALS_MAP)}, trim(x.concerned_person))
           AS salesperson,
         trim(x.concerned_person) LIKE '%/%' AS salesperson_two_names,
         x.concerned_person AS salesperson_raw,
         CASE WHEN regexp_matches(x.po_quote_value, '^[0-9]')
              THEN CAST(round(TRY_CAST(regexp_extract(x.po_quote_value,
                   '^[0-9]+[.]?[0-9]*([eE][+-]?[0-9]+)?', 0) AS DOUBLE), 6) AS DECIMAL(28,6)) END AS value_inr,
         x.incoterms,
         CASE WHEN x.incoterms IS NULL THEN NULL
              ELSE replace(upper(trim(x.incoterms)), 'EX WORKS', 'EX-WORKS') END AS incoterms_clean,
         CASE WHEN x.item_qty IS NULL OR x.item_qty = '' THEN NULL
              ELSE coalesce(TRY_CAST(nullif(regexp_extract(x.item_qty,
                     '^\\s*([+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?)', 1), '') AS DOUBLE), 0.0)
         END AS item_qty,
         x.po_date IS NOT NULL OR x.quote_date IS NOT NULL AS any_date_
  FROM reg_x x
)"""


def register_select() -> str:
    return "SELECT * EXCLUDE (any_date_, value_inr), CAST(value_inr AS DOUBLE) AS value_inr FROM v_reg"


def cleaning_log_sql(p: Params = DEFAULT) -> str:
    parts = []
    for pos, (key, step, col, issue, action, note) in enumerate(ENTRIES, start=1):
        head = f"{pos} AS pos, "
        if key == "ld_kind":
            parts.append(
                f"SELECT {pos} AS pos, ld_kind AS sub, {q(step)} AS step, {q(col)} AS column_name, "
                f"{q(LD_ISSUE)} || ld_kind AS issue, COUNT(*) AS rows_found, {q(action)} AS action, "
                f"{q(note)} AS note FROM v_reg WHERE ld_kind IN {sql_in(V.LD_NOT_A_CLAUSE)} "
                f"GROUP BY ld_kind")
            continue
        cond = {
            "dates_parsed": "any_date_", "date_impossible": "date_impossible",
            "year_suspect": "year_suspect", "dp_free_text": "dp_is_free_text",
            "status_open": "upper(trim(status_raw)) = 'OPEN'",
            "status_unusable": "status_clean IN ('UNUSABLE', 'UNMAPPED')",
            "quote_no_other": "quote_no_holds_other", "quote_no_tender": "quote_no_is_tender",
            "ld_merged": "ld_merged IS NOT NULL", "ld_both": "ld_both_populated",
            "vertical_other": "vertical_clean = 'NOT A MARKET'",
            "export_mislabelled": "export_mislabelled",
            "people_two": "salesperson_two_names",
            "order_no_value": "became_order AND value_inr IS NULL",
        }.get(key)
        common = f"'' AS sub, {q(step)} AS step, {q(col)} AS column_name, {q(issue)} AS issue, "
        if cond is not None:
            parts.append(f"SELECT {head}{common}COUNT(*) AS rows_found, {q(action)} AS action, "
                         f"{q(note)} AS note FROM v_reg WHERE {cond}")
        elif key == "status_wordings":
            parts.append(f"SELECT {head}{common}COUNT(DISTINCT status_raw), {q(action)}, "
                         f"'Collapsed to ' || CAST((SELECT COUNT(DISTINCT status_clean) FROM v_reg)"
                         f" AS VARCHAR) || ' states; Appendix A prints the whole mapping.' "
                         f"FROM v_reg")
        elif key == "people_initials":
            parts.append(f"SELECT {head}{common}COUNT(DISTINCT salesperson_raw) - "
                         f"COUNT(DISTINCT salesperson), {q(action)}, {q(note)} FROM v_reg")
        elif key == "promised_from_po":
            parts.append(
                f"SELECT {head}{common}COUNT(*), {q(action)}, "
                f"'The register gives a promised date on ' || CAST((SELECT COUNT(*) FROM ob_orders"
                f" WHERE promised_date_source = 'register') AS VARCHAR) || ' of ' || "
                f"CAST((SELECT COUNT(*) FROM ob_orders) AS VARCHAR) || "
                f"' orders; orders.promised_date_source says which is which.' "
                f"FROM ob_orders WHERE promised_date_source = 'po_document'")
        elif key == "promised_none":
            parts.append(f"SELECT {head}{common}COUNT(*), {q(action)}, {q(note)} "
                         f"FROM ob_orders WHERE promised_date_source = 'none'")
    union = "\nUNION ALL\n".join(parts)
    return (register_cte(p) + f""",
log_rows AS (
{union}
)
SELECT CAST(row_number() OVER (ORDER BY pos, sub) AS BIGINT) AS log_id, step, column_name, issue,
       CAST(rows_found AS BIGINT) AS rows_found, action, note
FROM log_rows""")


def q11_sql(p: Params = DEFAULT) -> str:
    return register_cte(p) + f"""
SELECT product_line, status_clean AS outcome, CAST(COUNT(*) AS BIGINT) AS rows_n,
       CAST(COUNT(value_inr) AS BIGINT) AS rows_with_a_value,
       CAST(round(SUM(value_inr), 0) AS DOUBLE) AS value_inr,
       {rr('SUM(value_inr * 100)', 'COUNT(value_inr) * 100', 0)} AS avg_value_inr,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY product_line)')} AS pct_of_line_rows
FROM v_reg
WHERE status_clean IN {sql_in(V.LOST_OUTCOMES)}
GROUP BY product_line, status_clean"""


def qa_sql(p: Params = DEFAULT) -> str:
    return register_cte(p) + """
SELECT status_clean AS mapped_to, CAST(COUNT(*) AS BIGINT) AS rows_n,
       CAST(COUNT(DISTINCT status_raw) AS BIGINT) AS wordings,
       string_agg(DISTINCT status_raw, ',' ORDER BY status_raw) AS as_typed_in_the_source
FROM v_reg GROUP BY status_clean"""
