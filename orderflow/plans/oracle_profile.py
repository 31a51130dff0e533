"""DuckDB twins of the register profile."""

from __future__ import annotations

from ..operators.profile import QUANTILES, TOP_K
from ..operators.register import RAW_COLUMNS
from ..params import DEFAULT, Params
from .oracle_queries import pct
from .oracle_register import _iso, register_cte
from .oracle_tables import q


def f1_sql(p: Params = DEFAULT) -> str:
    c = lambda cond: f"SUM(CASE WHEN {cond} THEN 1 ELSE 0 END)"
    qr, w = "quote_no_is_real", "became_order"
    return register_cte(p) + f"""
SELECT product_line, CAST(COUNT(*) AS BIGINT) AS rows_n,
       CAST({c(qr)} AS BIGINT) AS has_quote_no, CAST({c(w)} AS BIGINT) AS won,
       CAST({c(f'{qr} AND {w}')} AS BIGINT) AS won_and_quoted,
       CAST({c(f'NOT {qr} AND {w}')} AS BIGINT) AS won_without_quote_no,
       CAST({c(f'{qr} AND NOT {w}')} AS BIGINT) AS quoted_not_won,
       CAST({c(f'NOT {qr} AND NOT {w}')} AS BIGINT) AS neither,
       {pct(c(f'NOT {qr} AND {w}'), c(w))} AS no_quote_share_of_won_pct,
       {pct(c(f'{qr} AND {w}'), c(qr))} AS conversion_of_quoted_pct
FROM v_reg GROUP BY product_line"""


def f2_sql(p: Params = DEFAULT) -> str:
    measures = {"quote_to_po_days": ("CAST(po_date - quote_date AS DOUBLE)", "TRUE"),
                "po_to_dp_days": ("CAST(dp_date - po_date AS DOUBLE)", "TRUE"),
                "order_value_inr": ("CAST(value_inr AS DOUBLE)", "became_order"),
                "item_qty": ("item_qty", "TRUE")}
    values = " UNION ALL ".join(f"SELECT '{m}' AS measure, product_line, {v} AS x FROM v_reg WHERE {c}"
                                for m, (v, c) in measures.items())
    at = ", ".join(f"xs[greatest((len(xs) * {k} + 50) // 100, 1)] AS p{k}" for k in QUANTILES)
    return register_cte(p) + f""",
lists AS (SELECT measure, product_line, list_sort(list(x)) AS xs FROM ({values}) v WHERE x IS NOT NULL
          GROUP BY measure, product_line)
SELECT measure, product_line, CAST(len(xs) AS BIGINT) AS n, {at}, xs[-1] AS max,
       CAST(len(list_filter(xs, lambda x: x < 0)) AS BIGINT) AS negatives FROM lists"""


def f3_sql(p: Params = DEFAULT) -> str:
    tops = ", ".join(
        f"CAST((2000 * CAST(round(list_sum(vs[:{k}]) * 100) AS HUGEINT) + CAST(round(list_sum(vs) * 100) AS HUGEINT))"
        f" // (2 * CAST(round(list_sum(vs) * 100) AS HUGEINT)) AS DOUBLE) / 10 AS top{k}_value_pct" for k in TOP_K)
    return register_cte(p) + f""",
per AS (SELECT product_line, customer_id, sum(value_inr) AS v FROM v_reg WHERE value_inr IS NOT NULL
        GROUP BY product_line, customer_id),
lists AS (SELECT product_line, list(v ORDER BY v DESC, customer_id) AS vs FROM per GROUP BY product_line)
SELECT product_line, CAST(len(vs) AS BIGINT) AS customers, {tops} FROM lists"""


def f4_sql(p: Params = DEFAULT) -> str:
    won = "(SELECT * FROM ob_raw_register WHERE coalesce(job_no, '') <> '' OR coalesce(po_no, '') <> '') won"
    parts = [f"SELECT {q(c)} AS column_name, CAST(count(nullif({c}, '')) AS BIGINT) AS filled, "
             f"{pct(f'count(nullif({c}, {q(chr(39) * 0)}))', 'count(*)')} AS fill_pct "
             f"FROM {won}" for c in RAW_COLUMNS]
    return "\nUNION ALL\n".join(parts)


def f5_sql(p: Params = DEFAULT) -> str:
    return f"""
SELECT 'status' AS block, status AS wording, CAST(NULL AS VARCHAR) AS product_line,
       CAST(COUNT(*) AS BIGINT) AS rows_n
FROM ob_raw_register WHERE status IS NOT NULL GROUP BY status
UNION ALL
SELECT 'vertical', vertical, item, CAST(COUNT(*) AS BIGINT)
FROM ob_raw_register WHERE vertical IS NOT NULL GROUP BY vertical, item
UNION ALL
SELECT 'dp_free_text', dp_date, CAST(NULL AS VARCHAR), CAST(COUNT(*) AS BIGINT)
FROM ob_raw_register WHERE dp_date IS NOT NULL AND ({_iso('dp_date')}) IS NULL GROUP BY dp_date"""


def f6_sql(p: Params = DEFAULT) -> str:
    return register_cte(p) + """
SELECT job_band, CAST(COUNT(*) AS BIGINT) AS rows_n FROM v_reg
WHERE job_band IS NOT NULL GROUP BY job_band"""
