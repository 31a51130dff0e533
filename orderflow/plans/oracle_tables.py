"""DuckDB SQL that derives the same order-book tables as ``sources.adapter``.

Used only by the correctness gate (``oracle_sql()``): each oracle query is
``WITH <these CTEs>, <query CTEs> SELECT ...`` over the driver's views. The
tables are prefixed ``ob_`` so they never shadow the driver's own ``orders``.
The rules are the adapter's rules, written independently in DuckDB's dialect.
"""

from __future__ import annotations

from .. import vocab as V
from ..params import DEFAULT, Params
from ..sources.adapter import (CATEGORY_BY_LINE, DISPATCH_BASE, EXPONENTS, IDENTITY_CELLS,
                               LONG_REVISIONS, ORDER_WORDINGS, PT_CODES, QUOTE_WORDINGS,
                               UOM_BY_LINE)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + str(s).replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def sql_pick(values, idx: str) -> str:
    return f"({sql_list(values)})[({idx}) + 1]"


def sql_in(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def fmt_date(d: str, style: str) -> str:
    return (f"CASE WHEN ({style}) = 0 THEN strftime({d}, '%d.%m.%Y') "
            f"WHEN ({style}) = 1 THEN strftime({d}, '%d-%m-%Y') "
            f"ELSE strftime({d}, '%Y-%m-%d') END")


def cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2))"


def person(k: str) -> str:
    names = [n for n, _ in V.SALES_PEOPLE]
    inits = [i for _, i in V.SALES_PEOPLE]
    return (f"CASE WHEN {k} % 150 = 1 THEN {q(V.TWO_PEOPLE_CELL)} "
            f"WHEN {k} % 5 < 2 THEN {sql_pick(inits, f'{k} % 9')} "
            f"ELSE {sql_pick(names, f'{k} % 9')} END")


def vertical(k: str, market: str) -> str:
    return (f"CASE WHEN {k} % 150 = 77 THEN {q(V.TWO_PEOPLE_CELL)} "
            f"WHEN {k} % 8 = 6 THEN NULL "
            f"WHEN {k} % 10 = 4 THEN {sql_pick(['Internal', 'External'], f'{k} % 2')} "
            f"WHEN {market} = 'Export' THEN "
            f"{sql_pick(['Export', 'Export-KAG', 'Export-Non-KAG'], f'{k} % 3')} "
            f"WHEN {market} = 'Domestic' THEN {sql_pick(['Domestic', 'DOMESTIC'], f'{k} % 2')} "
            f"ELSE 'Domestic' END")


def category(line_idx: str, k: str) -> str:
    parts = [f"WHEN {line_idx} = {i} THEN {sql_pick(c, f'{k} % {len(c)}')}"
             for i, c in enumerate(CATEGORY_BY_LINE[:2])]
    last = CATEGORY_BY_LINE[2]
    return "CASE " + " ".join(parts) + f" ELSE {sql_pick(last, f'{k} % {len(last)}')} END"


def adapter_ctes(params: Params = DEFAULT) -> str:
    as_of = f"DATE '{params.as_of.isoformat()}'"
    gst2 = 2 * params.gst_rate_pct
    terms_rows = ", ".join(f"({q(c)}, {q(d)}, {n}, {float(a)})"
                           for c, d, n, a in V.PAYMENT_TERMS)
    ldv, ldc = V.LD_VALUES, V.LD_CLAUSE_VALUES
    real_quote = ("'VQ/FG/' || CAST(CASE WHEN K % 60 IN (0, 1, 5, 6, 10) THEN K // 60 * 60 ELSE K END "
                  f"AS VARCHAR) || CASE WHEN K % 240 = 11 THEN {q(LONG_REVISIONS[0])} "
                  f"WHEN K % 480 = 16 THEN {q(LONG_REVISIONS[1])} WHEN K % 3 > 0 "
                  "THEN ' REV-0' || CAST(K % 3 AS VARCHAR) ELSE '' END")

    def serial(n: str) -> str:
        return (f"CASE WHEN K % 401 = 13 THEN NULL WHEN K % 409 = 17 THEN 'S' || ({n}) "
                f"WHEN K % 419 = 19 THEN CAST({n} - 2 AS VARCHAR) ELSE CAST({n} AS VARCHAR) END")

    identity = (f"CASE WHEN K % 313 = 7 THEN {q(IDENTITY_CELLS[0])} WHEN K % 317 = 11 "
                f"THEN {q(IDENTITY_CELLS[1])} WHEN K % 331 = 13 THEN {q(IDENTITY_CELLS[2])} "
                f"WHEN K % 337 = 17 THEN {q(IDENTITY_CELLS[3])} WHEN K % 4 = 2 THEN 'E-mail' END")
    gem = "'GEM/2001/B/' || CAST(7000000 + K % 1000000 AS VARCHAR)"
    return f"""
ob_customers AS (
  SELECT printf('C%06d', c.c_custkey) AS customer_id,
         CASE WHEN c.c_custkey % 10 < 7 THEN 'Domestic'
              WHEN c.c_custkey % 10 < 9 THEN 'Export' ELSE 'Deemed Export' END AS market_type,
         CASE WHEN c.c_custkey % 10 IN (7, 8) THEN g.n_name ELSE {q(V.HOME_COUNTRY)} END AS country,
         CASE WHEN c.c_custkey % 10 IN (7, 8) THEN g.r_name
              WHEN c.c_custkey % 10 < 7 THEN {sql_pick(V.DOMESTIC_REGIONS, 'c.c_nationkey % 4')}
              ELSE {sql_pick(V.DEEMED_EXPORT_REGIONS, 'c.c_nationkey % 2')} END AS region,
         DATE '1994-01-01' - CAST(c.c_custkey % 1500 AS INTEGER) AS onboarded_date
  FROM customer c
  LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n
             JOIN region r ON n.n_regionkey = r.r_regionkey) g
         ON c.c_nationkey = g.n_nationkey
),
ob_items AS (
  SELECT printf('I%07d', p_partkey) AS item_id,
         {sql_pick(V.PRODUCT_LINES, 'p_partkey % 3')} AS product_line,
         {sql_pick([c[0] for c in CATEGORY_BY_LINE], 'p_partkey % 3')} AS category,
         CASE WHEN p_partkey % 3 = 0
              THEN 'FRP pressure vessel, '
                   || CAST({sql_pick(V.VESSEL_SIZES_MM, 'p_size % 7')} AS VARCHAR) || ' mm dia'
              ELSE p_type END AS description,
         {sql_pick(UOM_BY_LINE, 'p_partkey % 3')} AS uom,
         CAST(CASE WHEN p_partkey % 3 = 0 THEN {sql_pick(V.VESSEL_SIZES_MM, 'p_size % 7')} END
              AS INTEGER) AS vessel_diameter_mm
  FROM part
),
ob_payment_terms AS (
  SELECT * FROM (VALUES {terms_rows}) t(terms_code, description, credit_days, advance_pct)
),
ob_lines_raw AS (
  SELECT l_orderkey AS order_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
              l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate)
              AS INTEGER) AS line_no,
         l_partkey AS partkey,
         CAST(l_quantity AS BIGINT) AS qty_int,
         CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS unit_cents
  FROM lineitem
),
ob_order_lines AS (
  SELECT order_id, line_no, printf('I%07d', partkey) AS item_id,
         CAST(qty_int AS DECIMAL(18,3)) AS ordered_qty,
         {cents('unit_cents')} AS unit_price
  FROM ob_lines_raw
),
ob_order_base AS (
  SELECT K, customer_id, po_date, po_no, job_no, linked, promised_date_source,
         CASE WHEN promised_date_source <> 'none'
              THEN po_date + CAST(10 + (K * 13) % 60 AS INTEGER) END AS promised_delivery_date,
         terms_code, ld_cell, ld_clause_cell, cancelled,
         CASE WHEN cancelled THEN {sql_pick(V.CANCELLED_WORDS, 'K % 5')}
              ELSE {sql_pick(ORDER_WORDINGS, f'(K * 7) % {len(ORDER_WORDINGS)}')} END AS status_text,
         CASE WHEN cancelled THEN po_date + CAST(5 + K % 86 AS INTEGER) END AS cancellation_date
  FROM (
    SELECT o_orderkey AS K,
           printf('C%06d', o_custkey) AS customer_id,
           CAST(o_orderdate AS DATE) AS po_date,
           CASE WHEN o_orderkey % 9 <> 0 OR o_orderkey % 10 = 3
                THEN 'PO/' || CAST(o_orderkey AS VARCHAR) END AS po_no,
           CASE WHEN o_orderkey % 10 <> 3 THEN
                (CASE o_orderkey % 50 WHEN 7 THEN 3 WHEN 17 THEN 4 WHEN 27 THEN 5
                      WHEN 37 THEN 6 WHEN 47 THEN 7 ELSE 1 END) * CAST({params.job_band_width} AS BIGINT)
                + o_orderkey END AS job_no,
           o_orderkey % 5 < 2 AS linked,
           CASE WHEN o_orderkey % 33 = 0 THEN 'none' WHEN o_orderkey % 4 = 1 THEN 'register'
                ELSE 'po_document' END AS promised_date_source,
           {sql_pick(PT_CODES, 'o_orderkey % 14')} AS terms_code,
           CASE WHEN o_orderkey % 6 = 0
                THEN {sql_pick(ldv, f'(o_orderkey // 6) % {len(ldv)}')} END AS ld_cell,
           CASE WHEN o_orderkey % 70 = 36
                THEN {sql_pick(ldc, f'(o_orderkey // 70) % {len(ldc)}')} END AS ld_clause_cell,
           o_orderkey % 25 = 7 AS cancelled
    FROM orders
  ) b
),
ob_orders AS (
  SELECT K AS order_id, CASE WHEN linked THEN K * 2 END AS quote_id, po_no, po_date, job_no,
         customer_id, promised_delivery_date, promised_date_source, terms_code,
         coalesce(ld_clause_cell, ld_cell) AS ld_clause,
         CASE WHEN ld_clause_cell IS NOT NULL THEN 'ld_clause_column'
              WHEN ld_cell IS NOT NULL THEN 'ld_column' END AS ld_clause_source,
         status_text AS order_status, cancellation_date
  FROM ob_order_base
),
ob_order_facts AS (
  SELECT coalesce(f.order_id, v.order_id) AS order_id, f.line_idx, f.first_qty, v.value_cents
  FROM (SELECT order_id, partkey % 3 AS line_idx, qty_int AS first_qty
        FROM ob_lines_raw WHERE line_no = 1) f
  FULL JOIN (SELECT order_id, sum(qty_int * unit_cents) AS value_cents
             FROM ob_lines_raw GROUP BY order_id) v ON f.order_id = v.order_id
),
ob_dispatch_pre AS (
  SELECT b.K, b.po_date, b.promised_delivery_date, b.customer_id, b.terms_code,
         l.line_no, l.qty_int, l.unit_cents,
         CASE WHEN (b.K + l.line_no) % 12 = 0 AND l.qty_int >= 2
              THEN (l.qty_int * 4) // 5 ELSE l.qty_int END AS ship_total,
         (b.K * 3 + l.line_no) % 6 = 0 AND l.qty_int >= 4 AS split,
         b.po_date + CAST(5 + (b.K * 7) % 45 + l.line_no AS INTEGER) AS first_date
  FROM ob_order_base b JOIN ob_lines_raw l ON b.K = l.order_id
  WHERE NOT b.cancelled AND b.K % 11 <> 0
),
ob_dispatch_rows AS (
  SELECT * FROM (
    SELECT {DISPATCH_BASE} + K * 1000000 + line_no * 10 + part AS dispatch_id, K AS order_id, line_no, part,
           CASE WHEN part = 1 THEN first_date
                ELSE first_date + CAST(3 + K % 23 AS INTEGER) END AS dispatch_date,
           1000 * shipped - CASE WHEN K % 37 = 4 AND shipped > 1 THEN 445 ELSE 0 END AS qty_milli,
           unit_cents, customer_id, terms_code, promised_delivery_date
    FROM (SELECT *, CASE WHEN NOT split THEN ship_total WHEN part = 1 THEN ship_total // 2
                         ELSE ship_total - ship_total // 2 END AS shipped
          FROM (SELECT *, 1 AS part FROM ob_dispatch_pre
                UNION ALL SELECT *, 2 FROM ob_dispatch_pre WHERE split) w) x
  ) y
  WHERE dispatch_date <= {as_of}
),
ob_dispatches AS (
  SELECT dispatch_id, order_id, line_no, dispatch_date,
         CAST(CAST(qty_milli AS DECIMAL(20,0)) * 0.001 AS DECIMAL(18,3)) AS dispatched_qty,
         {sql_pick(V.SHIP_MODES, f'(order_id + line_no) % {len(V.SHIP_MODES)}')} AS ship_mode,
         CASE WHEN promised_delivery_date IS NOT NULL AND dispatch_date > promised_delivery_date
              THEN {sql_pick(V.DELAY_REASONS, f'order_id % {len(V.DELAY_REASONS)}')}
              END AS delay_reason
  FROM ob_dispatch_rows
),
ob_invoice_rows AS (
  SELECT d.dispatch_id AS invoice_id, 'INV/' || CAST(d.dispatch_id AS VARCHAR) AS invoice_no,
         d.dispatch_id, d.order_id, d.line_no, d.part, d.customer_id,
         d.dispatch_date AS invoice_date,
         CASE WHEN c.market_type = 'Export' THEN 'USD' ELSE 'INR' END AS currency,
         CASE WHEN c.market_type = 'Export' THEN {cents('fx_cents')}
              ELSE CAST(1 AS DECIMAL(18,2)) END AS fx_rate_to_inr,
         CASE WHEN c.market_type = 'Export'
              THEN (d.inr_cents * 200 + fx_cents) // (fx_cents * 2)
              ELSE d.inr_cents END AS taxable_cents,
         CASE WHEN c.market_type = 'Export' THEN CAST(0 AS BIGINT)
              ELSE (d.inr_cents * {gst2} + 100) // 200 END AS gst_cents,
         d.dispatch_date + CAST(t.credit_days AS INTEGER) AS due_date,
         CAST(t.advance_pct AS BIGINT) AS advance_pct
  FROM (SELECT *, 8300 + ((year(dispatch_date) * 12 + month(dispatch_date)) * 37) % 701
                  AS fx_cents, (qty_milli * unit_cents + 500) // 1000 AS inr_cents
        FROM ob_dispatch_rows) d
  LEFT JOIN ob_customers c ON d.customer_id = c.customer_id
  LEFT JOIN ob_payment_terms t ON d.terms_code = t.terms_code
),
ob_invoices AS (
  SELECT invoice_id, invoice_no, dispatch_id, order_id, customer_id, invoice_date, currency,
         fx_rate_to_inr, {cents('taxable_cents')} AS taxable_value,
         {cents('gst_cents')} AS gst_amount, due_date
  FROM ob_invoice_rows
),
ob_pay_pre AS (
  SELECT invoice_id, invoice_date, due_date, order_id AS K,
         (order_id * 7 + line_no * 3 + part) % 10 AS h,
         (taxable_cents + gst_cents) * advance_pct // 100 AS adv,
         (taxable_cents + gst_cents) - (taxable_cents + gst_cents) * advance_pct // 100 AS rest
  FROM ob_invoice_rows
),
ob_payments AS (
  SELECT invoice_id * 10 + seq AS payment_id, invoice_id, payment_date,
         {cents('amount_cents')} AS amount, payment_type
  FROM (
    SELECT invoice_id, 1 AS seq, 'Advance' AS payment_type, adv AS amount_cents,
           invoice_date - CAST(h + 1 AS INTEGER) AS payment_date
    FROM ob_pay_pre
    UNION ALL
    SELECT invoice_id, 2 AS seq,
           CASE WHEN h = 1 THEN 'Part' WHEN adv > 0 THEN 'Final' ELSE 'Full' END,
           CASE WHEN h = 0 THEN 0 WHEN h = 1 THEN rest // 2 ELSE rest END,
           CASE WHEN h = 1 THEN due_date + 5
                WHEN h <= 4 THEN due_date + CAST(20 + K % 60 AS INTEGER)
                ELSE greatest(due_date - CAST(h AS INTEGER), invoice_date) END
    FROM ob_pay_pre
  ) p
  WHERE amount_cents > 0 AND payment_date <= {as_of}
),
ob_quote_rows AS (
  SELECT K, CASE WHEN linked THEN K * 2 ELSE K * 2 + 1 END AS quote_id, linked,
         'VQ/FG/' || CAST(K AS VARCHAR) AS quote_no, CAST(K % 3 AS INTEGER) AS revision_no,
         customer_id,
         CASE WHEN linked THEN po_date - CAST(1 + K % 40 AS INTEGER) ELSE po_date END
           AS quote_date,
         po_date
  FROM ob_order_base
  WHERE linked OR K % 7 = 0
),
ob_quotations AS (
  SELECT quote_id, quote_no, revision_no, customer_id, quote_date - 7 AS inquiry_date,
         quote_date, quote_date + 30 AS validity_date,
         CASE WHEN K % 2 = 0 THEN {sql_pick(V.INCOTERMS, f'K % {len(V.INCOTERMS)}')} END
           AS incoterms,
         {person('K')} AS salesperson_code,
         CASE WHEN linked THEN 'Won'
              ELSE {sql_pick(QUOTE_WORDINGS, f'(K * 7) % {len(QUOTE_WORDINGS)}')} END AS status
  FROM ob_quote_rows
),
ob_quotation_lines AS (
  SELECT r.quote_id, l.line_no, l.item_id, l.ordered_qty AS qty, l.unit_price
  FROM ob_quote_rows r JOIN ob_order_lines l ON r.K = l.order_id
),
ob_register_base AS (
  SELECT b.*, f.line_idx, f.first_qty, f.value_cents, c.market_type,
         t.description AS terms_text,
         coalesce(f.line_idx, b.K % 3) AS li,
         CASE WHEN b.K % 97 = 5 THEN b.po_date + 3
              ELSE b.po_date - CAST(1 + b.K % 40 AS INTEGER) END AS qdate,
         {cents('f.value_cents')} AS value_dec
  FROM ob_order_base b
  LEFT JOIN ob_order_facts f ON b.K = f.order_id
  LEFT JOIN ob_customers c ON b.customer_id = c.customer_id
  LEFT JOIN ob_payment_terms t ON b.terms_code = t.terms_code
),
ob_raw_register AS (
  SELECT {serial('K * 2 + 1')} AS sl_no,
         customer_id AS party,
         {sql_pick(V.PROJECT_WORDS, f'K % {len(V.PROJECT_WORDS)}')} AS project,
         CASE WHEN K % 2 = 0 THEN {sql_pick(V.INCOTERMS, f'K % {len(V.INCOTERMS)}')} END AS incoterms,
         CASE WHEN K % 3 = 0 THEN {sql_pick(V.QUOTE_FROM, f'K % {len(V.QUOTE_FROM)}')} END AS quote_from,
         CASE WHEN linked THEN {real_quote}
              WHEN K % 17 = 3 THEN {gem}
              WHEN K % 19 = 5 THEN {sql_pick(V.QUOTE_NO_JUNK, f'K % {len(V.QUOTE_NO_JUNK)}')}
              END AS quote_no,
         CASE WHEN linked THEN {fmt_date('qdate', 'K % 3')} END AS quote_date,
         CASE WHEN linked THEN {fmt_date('qdate + 30', '(K + 1) % 3')} END AS validity_date,
         {vertical('K', 'market_type')} AS vertical,
         {category('li', 'K')} AS category,
         {sql_pick(V.PRODUCT_LINES, 'li')} AS item,
         CASE WHEN K % 101 = 9 THEN 'n/a' WHEN K % 107 = 3 THEN '1.5E+02'
              WHEN K % 4 = 0 THEN CAST(first_qty AS VARCHAR) END AS item_qty,
         {identity} AS inquiry,
         CAST(NULL AS VARCHAR) AS inquiry_date,
         CASE WHEN K % 211 = 5 THEN CAST(job_no AS VARCHAR) || 'A'
              ELSE CAST(job_no AS VARCHAR) END AS job_no,
         po_no,
         CASE WHEN K % 499 = 17 THEN '31-11-' || CAST(year(po_date) AS VARCHAR)
              WHEN K % 503 = 19 THEN strftime(po_date, '%d.%m.') || '2205'
              ELSE {fmt_date('po_date', 'K % 3')} END AS po_date,
         CAST(NULL AS VARCHAR) AS po_validity_date,
         CASE WHEN promised_date_source = 'register'
              THEN {fmt_date('promised_delivery_date', '(K + 2) % 3')}
              WHEN K % 47 = 3 THEN {sql_pick(V.DP_FREE_TEXT, f'K % {len(V.DP_FREE_TEXT)}')}
              END AS dp_date,
         status_text AS status,
         ld_cell AS ld,
         ld_clause_cell AS ld_clause,
         CASE WHEN K % 30 = 0 THEN terms_text END AS payment_terms,
         CASE WHEN K % 101 = 9 THEN 'n/a'
              WHEN K % 103 = 11 THEN {sql_pick(EXPONENTS, f'K % {len(EXPONENTS)}')}
              WHEN K % 3 <> 0 THEN CAST(value_dec AS VARCHAR) END AS po_quote_value,
         {person('K')} AS concerned_person
  FROM ob_register_base
  UNION ALL
  SELECT {serial('K * 2 + 2')},
         customer_id,
         {sql_pick(V.PROJECT_WORDS, f'K % {len(V.PROJECT_WORDS)}')},
         CASE WHEN K % 2 = 0 THEN {sql_pick(V.INCOTERMS, f'K % {len(V.INCOTERMS)}')} END,
         CASE WHEN K % 3 = 0 THEN {sql_pick(V.QUOTE_FROM, f'K % {len(V.QUOTE_FROM)}')} END,
         CASE WHEN K % 7 = 0 THEN {real_quote}
              WHEN K % 17 = 3 THEN {gem}
              ELSE {sql_pick(V.QUOTE_NO_JUNK, f'K % {len(V.QUOTE_NO_JUNK)}')} END,
         CASE WHEN K % 7 = 0 THEN {fmt_date('po_date', 'K % 3')} END,
         CASE WHEN K % 7 = 0 THEN {fmt_date('po_date + 30', '(K + 1) % 3')} END,
         {vertical('K', 'market_type')},
         {category('li', 'K')},
         {sql_pick(V.PRODUCT_LINES, 'li')},
         CASE WHEN K % 4 = 0 THEN CAST(first_qty AS VARCHAR) END,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         {sql_pick(QUOTE_WORDINGS, f'(K * 7) % {len(QUOTE_WORDINGS)}')},
         NULL, NULL, NULL,
         CASE WHEN K % 2 = 0 THEN CAST(value_dec AS VARCHAR) END,
         {person('K')}
  FROM ob_register_base
  WHERE NOT linked AND (K % 7 = 0 OR K % 17 = 3 OR K % 19 = 5)
)"""


TABLE_CTES = {
    "customers": "ob_customers", "items": "ob_items", "payment_terms": "ob_payment_terms",
    "quotations": "ob_quotations", "quotation_lines": "ob_quotation_lines",
    "orders": "ob_orders", "order_lines": "ob_order_lines", "dispatches": "ob_dispatches",
    "invoices": "ob_invoices", "payments": "ob_payments",
    "raw_quote_register": "ob_raw_register",
}


def with_tables(body: str, params: Params = DEFAULT) -> str:
    """Prefix a query (which may start with more CTEs, no WITH) with the tables.

    ``body`` is either ``"<cte>, <cte> SELECT ..."`` style text starting with
    ``name AS (`` or a bare ``SELECT``.
    """
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {adapter_ctes(params)}\n{body}"
    return f"WITH RECURSIVE {adapter_ctes(params)},\n{body}"
