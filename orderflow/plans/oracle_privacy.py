"""DuckDB twins for the privacy scan.

DuckDB's regular expressions have no look-around and their word boundaries are
ASCII. So every character that is not a word character is doubled first: then a
pattern may consume one of the pair on either side as its context, and
neighbouring matches still have one each. A match is halved again afterwards.
"""

from __future__ import annotations

from .. import vocab as V
from ..operators.privacy import (PER_FILE, PERSON_RULE, PERSON_SAMPLE, PERSON_SHAPE_EXEMPT, SAMPLE,
                                 declared_strings)
from ..sources.adapter import SCHEMA
from .oracle_checks import log_cte
from .oracle_tables import TABLE_CTES, q, sql_in, sql_list

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LOG_COLUMNS = ["log_id", "step", "column_name", "issue", "rows_found", "action", "note"]
W = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"  # word characters
S = r"\s\x0b\x{85}\p{Z}"          # white space
D = r"\p{Nd}"
#: rule -> (pattern over doubled text, its group with the match)
DOUBLED = {
    "email address": rf"([{W}.-]+@@[{W}.-]+\.\.[{W}]{{2,}})",
    "Indian mobile number": rf"(?:^|[^{W}.])((?:\+\+91(?:[{S}-]{{2}})?)?[6-9]{D}{{9}})(?:$|[^{W}.])",
    "GSTIN": rf"(?:^|[^{W}])({D}{{2}}[A-Z]{{5}}{D}{{4}}[A-Z]{D}[A-Z]{D})(?:$|[^{W}])",
    "PAN": rf"(?:^|[^{W}])([A-Z]{{5}}{D}{{4}}[A-Z])(?:$|[^{W}])",
    "tender ref in an actual serial range":
        rf"(GEM//{D}{{4}}//[A-Z]//(?:4[89]{D}{{5}}|[56]{D}{{6}}))(?:$|[^{D}])",
    PERSON_RULE: rf"(?:^|[^{W}])([A-Z][a-z]{{2,}}[{S}]+[A-Z][a-z]{{2,}})(?:$|[^{W}])",
}


def _cells() -> str:
    tables = [(t, TABLE_CTES[t], cols) for t, cols in SCHEMA.items()]
    tables += [("documents", "documents", DOCUMENT_COLUMNS), ("cleaning_log", "the_log", LOG_COLUMNS)]
    return " UNION ALL ".join(
        f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, CAST({c} AS VARCHAR) AS value FROM {source}"
        for t, source, cols in tables for c in cols)


def _matches() -> str:
    rules = " UNION ALL ".join(
        f"SELECT {q(rule)} AS rule, table_name, column_name, "
        f"unnest(regexp_extract_all(wide, '{rx}', 1)) AS found FROM doubled" for rule, rx in DOUBLED.items())
    exempt = " OR ".join(f"(table_name = {q(t)} AND column_name = {q(c)})" for t, c in sorted(PERSON_SHAPE_EXEMPT))
    return log_cte() + f""",
doubled AS (
  SELECT table_name, column_name, regexp_replace(value, '([^{W}])', '\\1\\1', 'g') AS wide
  FROM (SELECT DISTINCT * FROM ({_cells()}) c) v
  WHERE regexp_matches(value, '@|[6-9]{D}{{9}}|[A-Z]{{5}}|GEM/|[A-Z][a-z]{{2,}}[{S}]+[A-Z][a-z]{{2,}}')
),
matches AS (
  SELECT DISTINCT rule, table_name, column_name,
         regexp_replace(found, '([^{W}])[^{W}]', '\\1', 'g') AS match
  FROM ({rules}) r
),
declared AS (SELECT unnest({sql_list(declared_strings())}) AS said),
findings AS (
  SELECT * FROM matches
  WHERE rule <> {q(PERSON_RULE)} OR NOT (({exempt}) OR match IN {sql_in(V.PEOPLE)}
        OR EXISTS (SELECT 1 FROM declared WHERE contains(said, match)))
)"""


def _sampled(keys: str, where: str, n: int) -> str:
    return (f"SELECT {keys}, CAST(count(*) AS BIGINT) AS hits, "
            f"array_to_string(list_sort(list(match))[:{n}], ' | ') AS sample "
            f"FROM findings WHERE {where} GROUP BY {keys}")


def p5_sql() -> str:
    """Line numbers over the texts of each volume one after another, by id."""
    rules = " UNION ALL ".join(
        f"SELECT {q(rule)} AS rule, volume, line_no, unnest(regexp_extract_all(wide, '{rx}', 1)) AS found FROM doubled"
        for rule, rx in DOUBLED.items() if rule != PERSON_RULE)
    return f"""
WITH lines AS (SELECT coalesce(CAST(floor(doc_id / {PER_FILE}) AS BIGINT), -1) AS volume, doc_id,
                      unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
numbered AS (SELECT volume, rtrim(line, chr(13)) AS line,
                    row_number() OVER (PARTITION BY volume ORDER BY doc_id, i) AS line_no FROM lines),
doubled AS (SELECT volume, line_no, regexp_replace(line, '([^{W}])', '\\1\\1', 'g') AS wide FROM numbered)
SELECT DISTINCT rule, volume, line_no, regexp_replace(found, '([^{W}])[^{W}]', '\\1', 'g') AS match
FROM ({rules}) r"""


PERSON, PATTERN = f"rule = {q(PERSON_RULE)}", f"rule <> {q(PERSON_RULE)}"


def p3_sql() -> str:
    return _matches() + "\n" + _sampled("rule, table_name, column_name", PATTERN, SAMPLE)


def p4_sql() -> str:
    return _matches() + "\n" + _sampled("table_name, column_name", PERSON, PERSON_SAMPLE)


def p6_sql() -> str:
    keys = "rule, table_name, column_name"
    return _matches() + f""",
report AS (
  SELECT 'allowlist' AS rule, table_name || '.' || column_name AS location, outside_values AS hits, sample
  FROM ({p2_sql()}) a WHERE outside_values > 0
  UNION ALL
  SELECT rule, table_name || '.' || column_name, hits, sample
  FROM ({_sampled(keys, PATTERN, SAMPLE)} UNION ALL {_sampled(keys, PERSON, PERSON_SAMPLE)}) f
)
SELECT * FROM report UNION ALL
SELECT 'outcome', if(coalesce(sum(hits), 0) = 0, 'clean', 'not clean'), CAST(coalesce(sum(hits), 0) AS BIGINT), ''
FROM report"""


def p1_sql() -> str:
    parts = []
    for t, cols in SCHEMA.items():
        for c in cols:
            parts.append(f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, "
                         f"CAST(COUNT({c}) AS BIGINT) AS cells FROM {TABLE_CTES[t]}")
    more = [("documents", "documents", DOCUMENT_COLUMNS), ("cleaning_log", "the_log", LOG_COLUMNS)]
    for t, source, cols in more:
        parts += [f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, "
                  f"CAST(COUNT({c}) AS BIGINT) AS cells FROM {source}" for c in cols]
    return log_cte() + "\n" + "\nUNION ALL\n".join(parts)


def p2_sql() -> str:
    lists = {
        ("raw_quote_register", "concerned_person"): sql_in(V.PEOPLE),
        ("customers", "country"):
            f"(SELECT n_name FROM nation UNION ALL SELECT {q(V.HOME_COUNTRY)})",
        ("customers", "region"):
            "(SELECT r_name FROM region UNION ALL SELECT unnest("
            + "[" + ", ".join(q(x) for x in V.DOMESTIC_REGIONS + V.DEEMED_EXPORT_REGIONS) + "]))",
        ("raw_quote_register", "incoterms"): sql_in(V.PLACES),
        ("raw_quote_register", "quote_from"): sql_in(V.PLACES),
        ("raw_quote_register", "vertical"): sql_in(V.VERTICALS),
        ("quotations", "salesperson_code"): sql_in(V.PEOPLE),
        ("quotations", "incoterms"): sql_in(V.PLACES),
        ("customers", "market_type"): sql_in(V.MARKET_TYPES),
    }
    parts = []
    for (t, c), allowed in lists.items():
        parts.append(
            f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, "
            f"CAST(COUNT(value) AS BIGINT) AS outside_values, "
            f"coalesce(array_to_string(list_slice(list_sort(list(value)), 1, 5), ' | '), '') "
            f"AS sample FROM (SELECT DISTINCT {c} AS value FROM {TABLE_CTES[t]} "
            f"WHERE {c} IS NOT NULL AND {c} NOT IN {allowed}) x")
    return "\nUNION ALL\n".join(parts)
