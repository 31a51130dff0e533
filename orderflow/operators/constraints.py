"""K1-K6: the declared schema constraints, audited instead of enforced.

Output rows: (table_name, rule, kind, violations). Every rule is one
distributed aggregate (``groupBy(keys).count()`` for keys, one pass over a table for
all of its foreign keys, conditional counts for domains / ranges / NOT NULL, all of a table
in a single pass), so the audit scales with the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V

PRIMARY_KEYS = [
    ("customers", ["customer_id"]), ("items", ["item_id"]), ("payment_terms", ["terms_code"]),
    ("quotations", ["quote_id"]), ("quotation_lines", ["quote_id", "line_no"]),
    ("orders", ["order_id"]), ("order_lines", ["order_id", "line_no"]),
    ("dispatches", ["dispatch_id"]), ("invoices", ["invoice_id"]), ("payments", ["payment_id"]),
    ("cleaning_log", ["log_id"]),
]
UNIQUE_KEYS = [
    ("quotations", ["quote_no", "revision_no"]), ("orders", ["job_no"]),
    ("invoices", ["invoice_no"]), ("invoices", ["dispatch_id"]),
]
FOREIGN_KEYS = [
    ("quotations", ["customer_id"], "customers", ["customer_id"]),
    ("quotation_lines", ["quote_id"], "quotations", ["quote_id"]),
    ("quotation_lines", ["item_id"], "items", ["item_id"]),
    ("orders", ["quote_id"], "quotations", ["quote_id"]),
    ("orders", ["customer_id"], "customers", ["customer_id"]),
    ("orders", ["terms_code"], "payment_terms", ["terms_code"]),
    ("order_lines", ["order_id"], "orders", ["order_id"]),
    ("order_lines", ["item_id"], "items", ["item_id"]),
    ("dispatches", ["order_id"], "orders", ["order_id"]),
    ("dispatches", ["order_id", "line_no"], "order_lines", ["order_id", "line_no"]),
    ("invoices", ["dispatch_id"], "dispatches", ["dispatch_id"]),
    ("invoices", ["order_id"], "orders", ["order_id"]),
    ("invoices", ["customer_id"], "customers", ["customer_id"]),
    ("payments", ["invoice_id"], "invoices", ["invoice_id"]),
]
DOMAINS = [
    ("customers", "market_type", V.MARKET_TYPES),
    ("items", "product_line", V.PRODUCT_LINES),
    ("orders", "promised_date_source", V.PROMISED_DATE_SOURCES),
    ("invoices", "currency", V.CURRENCIES),
    ("payments", "payment_type", V.PAYMENT_TYPES),
    ("cleaning_log", "action", V.LOG_ACTIONS),
]
RANGES = [
    ("quotation_lines", "qty > 0", "qty", "gt0"), ("quotation_lines", "unit_price >= 0",
                                                   "unit_price", "ge0"),
    ("order_lines", "ordered_qty > 0", "ordered_qty", "gt0"),
    ("order_lines", "unit_price >= 0", "unit_price", "ge0"),
    ("dispatches", "dispatched_qty > 0", "dispatched_qty", "gt0"),
    ("invoices", "fx_rate_to_inr > 0", "fx_rate_to_inr", "gt0"),
    ("invoices", "taxable_value >= 0", "taxable_value", "ge0"),
    ("invoices", "gst_amount >= 0", "gst_amount", "ge0"),
    ("payments", "amount > 0", "amount", "gt0"),
]
NOT_NULL = {
    "customers": ["market_type", "country", "region", "onboarded_date"],
    "items": ["product_line", "category", "description", "uom"],
    "payment_terms": ["description", "credit_days", "advance_pct"],
    "quotations": ["quote_no", "revision_no", "customer_id", "quote_date", "salesperson_code",
                   "status"],
    "quotation_lines": ["quote_id", "line_no", "item_id", "qty", "unit_price"],
    "orders": ["po_date", "customer_id", "promised_date_source", "order_status"],
    "order_lines": ["order_id", "line_no", "item_id", "ordered_qty", "unit_price"],
    "dispatches": ["order_id", "line_no", "dispatch_date", "dispatched_qty", "ship_mode"],
    "invoices": ["invoice_no", "dispatch_id", "order_id", "customer_id", "invoice_date",
                 "currency", "fx_rate_to_inr", "taxable_value", "gst_amount", "due_date"],
    "payments": ["invoice_id", "payment_date", "amount", "payment_type"],
    "cleaning_log": ["step", "issue", "rows_found", "action"],
}


def _row(df: DataFrame, table: str, rule: str, kind: str) -> DataFrame:
    """df holds one column ``violations`` in one row."""
    return df.select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
                     F.lit(kind).alias("kind"), F.col("violations").cast("long"))


def _union(dfs):
    return reduce(DataFrame.unionByName, dfs)


def _key_violations(df: DataFrame, keys, nulls_count: bool) -> DataFrame:
    """Key values held by more than one row (+ rows with a NULL key part for a PK),
    from one grouped pass."""
    anynull = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    g = df.groupBy(*keys).count()
    dup = F.when(~anynull & (F.col("count") > 1), 1)
    v = F.when(anynull, F.col("count")).otherwise(dup) if nulls_count else dup
    return g.agg(F.coalesce(F.sum(v), F.lit(0)).alias("violations"))


def k1_primary_keys(tables) -> DataFrame:
    return _union([_row(_key_violations(tables[t], keys, True), t,
                        f"PRIMARY KEY ({', '.join(keys)})", "primary key")
                   for t, keys in PRIMARY_KEYS])


def k2_unique(tables) -> DataFrame:
    return _union([_row(_key_violations(tables[t], keys, False), t,
                        f"UNIQUE ({', '.join(keys)})", "unique")
                   for t, keys in UNIQUE_KEYS])


def with_parents(tables, child: DataFrame, fks) -> DataFrame:
    """``child`` with a column ``_fk0``, ``_fk1`` ... for each (ckeys, parent, pkeys):
    TRUE where the parent has the row's key, else NULL. A parent is asked by its
    distinct keys, so a doubled key there does not multiply the child's rows."""
    for k, (ckeys, parent, pkeys) in enumerate(fks):
        keys = [f"_fk{k}_{i}" for i in range(len(pkeys))]
        known = tables[parent].select(*[F.col(pk).alias(n) for pk, n in zip(pkeys, keys)]).distinct()
        same = reduce(lambda a, b: a & b, [child[c] == known[n] for c, n in zip(ckeys, keys)])
        child = child.join(known.withColumn(f"_fk{k}", F.lit(True)), same, "left").drop(*keys)
    return child


def orphaned(ckeys, k: int) -> Column:
    """Whether a row of ``with_parents`` has a whole key k that its parent lacks."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ckeys])
    return whole & F.col(f"_fk{k}").isNull()


def k3_foreign_keys(tables) -> DataFrame:
    """All foreign keys of a table in one pass over it."""
    parts = []
    for child in dict.fromkeys(f[0] for f in FOREIGN_KEYS):
        fks = [f[1:] for f in FOREIGN_KEYS if f[0] == child]
        columns = list(dict.fromkeys(c for ck, _, _ in fks for c in ck))
        one = with_parents(tables, tables[child].select(*columns), fks).agg(
            *[F.count_if(orphaned(ck, k)).alias(f"_{k}") for k, (ck, _, _) in enumerate(fks)])
        rows = F.array(*[F.struct(F.lit(f"({', '.join(ck)}) REFERENCES {pa} ({', '.join(pk)})").alias("rule"),
                                  F.col(f"_{k}").cast("long").alias("violations"))
                         for k, (ck, pa, pk) in enumerate(fks)])
        parts.append(one.select(F.inline(rows)).select(
            F.lit(child).alias("table_name"), "rule", F.lit("foreign key").alias("kind"), "violations"))
    return _union(parts)


COLUMN_KINDS = ("domain", "range", "not null")


def column_rules(kinds=COLUMN_KINDS) -> dict[str, list[tuple[str, str, Column]]]:
    """Table -> (rule, kind, condition of a violating row) of the asked kinds."""
    def bad(col, op):
        return F.col(col) <= 0 if op == "gt0" else F.col(col) < 0
    rules = [(t, f"{c} IN ({', '.join(vals)})", "domain", F.col(c).isNotNull() & ~F.col(c).isin(*vals))
             for t, c, vals in DOMAINS]
    rules += [(t, rule, "range", bad(c, op)) for t, rule, c, op in RANGES]
    rules += [(t, f"{c} NOT NULL", "not null", F.col(c).isNull()) for t, cols in NOT_NULL.items() for c in cols]
    out: dict[str, list] = {}
    for t, rule, kind, cond in rules:
        if kind in kinds:
            out.setdefault(t, []).append((rule, kind, cond))
    return out


def column_violations(tables, kinds=COLUMN_KINDS) -> DataFrame:
    """K4-K6: all rules of a table that look at one row, as one aggregate over it."""
    parts = []
    for t, rules in column_rules(kinds).items():
        one = tables[t].agg(*[F.count_if(cond).alias(f"_{k}") for k, (_, _, cond) in enumerate(rules)])
        rows = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(kind).alias("kind"),
                                  F.col(f"_{k}").cast("long").alias("violations"))
                         for k, (rule, kind, _) in enumerate(rules)])
        parts.append(one.select(F.inline(rows)).select(F.lit(t).alias("table_name"), "rule", "kind", "violations"))
    return _union(parts)


def k4_domains(tables) -> DataFrame:
    return column_violations(tables, ["domain"])


def k5_ranges(tables) -> DataFrame:
    return column_violations(tables, ["range"])


def k6_not_null(tables) -> DataFrame:
    return column_violations(tables, ["not null"])


def audit_constraints(tables) -> DataFrame:
    return _union([k1_primary_keys(tables), k2_unique(tables), k3_foreign_keys(tables),
                   column_violations(tables)])
