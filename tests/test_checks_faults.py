"""Each check passes on the derived book and fails once its fault is planted."""

import pytest
from pyspark.sql import functions as F

from orderflow.operators.checks import run_checks
from orderflow.operators.constraints import audit_constraints


class Book:
    """An order book with some tables replaced."""

    def __init__(self, base, **replaced):
        self._base, self._replaced = base, replaced
        self.TABLES = base.TABLES

    def __getitem__(self, name):
        return getattr(self, name)

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        return self._replaced.get(name) if name in self._replaced else self._base[name]


def verdicts(df):
    return {r.check_name: r.verdict for r in df.collect()}


@pytest.fixture(scope="module")
def clean_verdicts(book):
    return verdicts(run_checks(book))


def test_clean_book_passes(clean_verdicts):
    assert len(clean_verdicts) == 22
    assert {k for k, v in clean_verdicts.items() if v == "EXPECTED"} == {
        "06b quote <= PO (raw register)", "17 register still carries its faults"}
    assert all(v in ("PASS", "EXPECTED") for v in clean_verdicts.values()), clean_verdicts


def with_cells(df, where, **cells):
    """``df`` with cells replaced in the rows where the condition holds."""
    cond = F.expr(where)
    return df.select(*[F.when(cond, F.expr(cells[f.name]).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
                       if f.name in cells else F.col(f.name) for f in df.schema.fields])


# check -> the fault that must make it FAIL: table, where, cells
FAULTS = {
    "02 rows per product line": ("raw_quote_register", "item = 'Pultrusion'", dict(item="'Rope'")),
    "03 orphaned foreign keys": ("order_lines", "line_no = 1 AND order_id < 50", dict(item_id="'I_NOT_THERE'")),
    "04 dispatch on or after PO date": ("dispatches", "line_no = 1", dict(dispatch_date="'1900-01-01'")),
    "05 invoice date = dispatch date": ("invoices", "order_id < 50", dict(invoice_date="date_add(invoice_date, 1)")),
    "06a quote <= PO (modelled tables)": ("quotations", "quote_id < 200", dict(quote_date="'2100-01-01'")),
    "06b quote <= PO (raw register)": ("raw_quote_register", "true", dict(quote_date="null")),
    "07 invoice value = dispatched qty x price": ("invoices", "order_id < 50",
                                                   dict(taxable_value="taxable_value + 100")),
    "08 GST by market": ("invoices", "currency = 'INR' AND taxable_value > 100", dict(gst_amount="0")),
    "09 FX rate by currency": ("invoices", "currency = 'INR' AND order_id < 50", dict(fx_rate_to_inr="2")),
    "10 job numbers unique and banded": ("orders", "order_id < 100", dict(job_no="7")),
    "11 payments do not exceed the invoice": ("payments", "payment_type = 'Full'", dict(amount="1000000000")),
    "12 payment timing": ("payments", "payment_type = 'Full'", dict(payment_date="'1900-01-01'")),
    "13 dispatched quantities sane": ("dispatches", "order_id < 50", dict(dispatched_qty="0")),
    "14 cancelled orders never ship": ("orders", "order_id < 50", dict(cancellation_date="'2000-01-01'")),
    "15 OTIF in range": ("dispatches", "true", dict(dispatch_date="'2001-08-30'")),
    "16 orders without a quotation": ("orders", "true", dict(quote_id="null")),
    "17 register still carries its faults": ("raw_quote_register", "true", dict(dp_date="null")),
    "18 no invented vocabulary": ("raw_quote_register", "sl_no = '1'", dict(status="'Verbally Confirmed'")),
    "18b identity columns within allowlist": ("raw_quote_register", "sl_no = '1'",
                                              dict(concerned_person="'Zed Unknown'")),
    "19 status mapping is complete": ("raw_quote_register", "sl_no = '1'", dict(status="'no such wording'")),
}


@pytest.mark.parametrize("name", sorted(FAULTS))
def test_planted_fault_fails(book, name):
    from orderflow.operators.checks import one_check
    table, where, cells = FAULTS[name]
    bad = Book(book, **{table: with_cells(book[table], where, **cells)})
    assert [r.verdict for r in one_check(bad, name).collect()] == ["FAIL"]


def test_empty_table_and_short_log_fail(book):
    from orderflow.operators.checks import one_check
    from orderflow.params import Params
    assert one_check(Book(book, payments=book.payments.limit(0)), "01 row counts").first().verdict == "FAIL"
    assert one_check(book, "20 cleaning log written", Params(min_log_rows=100)).first().verdict == "FAIL"


CONSTRAINT_FAULTS = [
    ("primary key", "orders", "order_id < 50", dict(order_id="null")),
    ("primary key", "cleaning_log", "log_id = 2", dict(log_id="1")),
    ("unique", "invoices", "order_id < 50", dict(invoice_no="'X'")),
    ("foreign key", "payments", "payment_type = 'Full'", dict(invoice_id="-1")),
    ("domain", "customers", "customer_id LIKE '%1'", dict(market_type="'Moon'")),
    ("domain", "cleaning_log", "log_id = 2", dict(action="'GUESSED'")),
    ("range", "payments", "payment_type = 'Full'", dict(amount="-1")),
    ("not null", "orders", "order_id < 50", dict(po_date="null")),
    ("not null", "cleaning_log", "log_id = 2", dict(issue="null")),
]


def test_clean_book_breaks_no_constraint(book):
    assert audit_constraints(book).filter(F.col("violations") > 0).count() == 0


@pytest.mark.parametrize("kind,table,where,cells", CONSTRAINT_FAULTS)
def test_constraint_audit_finds_the_fault(book, kind, table, where, cells):
    from orderflow.operators import constraints as K
    audit = {"primary key": K.k1_primary_keys, "unique": K.k2_unique, "foreign key": K.k3_foreign_keys,
             "domain": K.k4_domains, "range": K.k5_ranges, "not null": K.k6_not_null}[kind]
    bad = Book(book, **{table: with_cells(book[table], where, **cells)})
    found = {r.table_name for r in audit(bad).filter(F.col("violations") > 0).collect()}
    assert found == {table}


def test_check_names_and_keys(clean_verdicts):
    from orderflow.operators.checks import CHECK_NAMES, check_key
    assert set(CHECK_NAMES) == set(clean_verdicts)
    assert check_key("06a quote <= PO (modelled tables)") == "c06a_quote_po_modelled_tables"


def test_single_check_prunes_other_branches(book):
    from orderflow.operators.checks import one_check
    df = one_check(book, "09 FX rate by currency")
    assert [r.verdict for r in df.collect()] == ["PASS"]
