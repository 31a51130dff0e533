"""Normalisation rules: strict dates, quote-number parts, the revision fold."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderflow.operators import normalise as N
from orderflow.operators.blocks import numbered
from orderflow.operators.register import RAW_COLUMNS


def raw_df(spark, rows):
    full = [tuple(r.get(c) for c in RAW_COLUMNS) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in RAW_COLUMNS))


def py_fold(rows):
    taken, out = {}, {}
    for sl, base, rev in sorted(rows):
        t = taken.setdefault(base, set())
        while rev in t:
            rev += 1
        t.add(rev)
        out[sl] = rev
    return out


def test_revision_fold_matches_python(spark):
    rows = [(1, "A", 0), (2, "A", 0), (3, "A", 1), (4, "A", 0), (5, "B", 2), (6, "B", 2),
            (7, "C", 0), (8, "A", 7), (9, "A", 3)]
    df = spark.createDataFrame(rows, "sl_no long, base string, rev long")
    got = {r.sl_no: r.rev for r in N.dedupe_revisions(df).collect()}
    assert got == py_fold(rows)


def test_revision_fold_matches_python_on_many_clashes(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ABCD"), rng.choice([0, 0, 0, 1, 2, 9, 10, 40])) for i in range(400)]
    df = spark.createDataFrame(rows, "sl_no long, base string, rev long").repartition(5)
    assert {r.sl_no: r.rev for r in N.dedupe_revisions(df).collect()} == py_fold(rows)


def test_rows_without_a_usable_serial_number(spark):
    """sl_no 1, 1, NULL and S4: four quotations and four orders, none doubled."""
    df = raw_df(spark, [dict(sl_no=s, quote_no=f"VQ/FG/{k}", party=f"C{k}", po_no=f"P{k}",
                             ld="", ld_clause="2%", incoterms="", job_no="")
                        for k, s in enumerate(["1", "1", None, "S4"])])
    assert sorted(r.customer_id for r in N.quotations(df).collect()) == ["C0", "C1", "C2", "C3"]
    docs = spark.createDataFrame([], "sl_no long, po_promised date")
    terms = spark.createDataFrame([], "description string, terms_code string")
    got = N.orders(df, docs, terms).collect()
    assert sorted(r.customer_id for r in got) == ["C0", "C1", "C2", "C3"]
    assert all(r.ld_clause == "2%" and r.job_no is None for r in got)


def test_blank_cells_are_not_filled(spark):
    df = raw_df(spark, [dict(sl_no="1", job_no="", po_no=""), dict(sl_no="2", po_no="P", ld_clause="", ld="5%")])
    assert [r.order_id for r in N.order_rows(df).collect()] == [2]
    assert N.ld_merge(df).collect()[0][1:] == ("5%", "ld_column")


def test_long_revision_numbers(spark):
    df = raw_df(spark, [dict(sl_no="1", quote_no="VQ/FG/1 REV 99999999999"),
                        dict(sl_no="2", quote_no="VQ/FG/1 REV 123456789012345678901234567890")])
    got = {r.sl_no: (r.rev, r.rev_unreadable) for r in N.dedupe_revisions(N.quote_number_parts(df)).collect()}
    assert got == {1: (99999999999, False), 2: (None, True)}


def test_invoice_amounts_are_rounded(spark):
    """1.555 x 10.01 = 15.56555: 15.57, not 15.56."""
    from orderflow.params import DEFAULT
    day = dt.date(2001, 1, 5)
    d = spark.createDataFrame([(1, 1, 1, day, "1.555")], "dispatch_id long, order_id long, line_no int, "
                              "dispatch_date date, q string").selectExpr("* except(q)", "cast(q as decimal(18,3)) dispatched_qty")
    ln = spark.createDataFrame([(1, 1, "10.01")], "order_id long, line_no int, p string").selectExpr(
        "* except(p)", "cast(p as decimal(18,2)) unit_price")
    o = spark.createDataFrame([(1, "C1", "T")], "order_id long, customer_id string, terms_code string")
    c = spark.createDataFrame([("C1", "Domestic")], "customer_id string, market_type string")
    t = spark.createDataFrame([("T", 30)], "terms_code string, credit_days int")
    fx = spark.createDataFrame([("2001-01", "83")], "month_key string, f string").selectExpr(
        "month_key", "cast(f as decimal(18,2)) fx_rate")
    r = N.derive_invoices(d, ln, o, c, t, fx, DEFAULT).first()
    assert str(r.taxable_value) == "15.57" and str(r.gst_amount) == "2.80"


def test_totals_have_one_row_per_register_row(spark):
    df = raw_df(spark, [dict(sl_no="1", po_quote_value="x"), dict(sl_no="9"), dict(sl_no=None)])
    links = spark.createDataFrame([(1, 5, None)], "sl_no long, order_id long, quote_id long")
    lines = spark.createDataFrame([(5, 2.0, 3.0)], "order_id long, ordered_qty double, unit_price double").selectExpr(
        "order_id", "cast(ordered_qty as decimal(18,3)) ordered_qty", "cast(unit_price as decimal(18,2)) unit_price")
    q = spark.createDataFrame([], "quote_id long, qty decimal(18,3), unit_price decimal(18,2)")
    got = sorted((tuple(r) for r in N.register_totals(df, links, lines, q).collect()), key=str)
    assert got == sorted([(1, 6.0, 2.0, 6.0, None), (9, None, None, None, None), (None,) * 5], key=str)


def test_strict_dates(spark):
    df = raw_df(spark, [dict(sl_no="1", quote_date="5.1.2024", po_date="31-11-2024",
                             dp_date=" 2024-02-29 ", validity_date="2024-1-5x",
                             inquiry_date="05/01/2024")])
    r = N.strict_dates(df).first()
    assert r.quote_date == dt.date(2024, 1, 5)
    assert r.po_date is None and r.validity_date is None and r.inquiry_date is None
    assert r.dp_date == dt.date(2024, 2, 29)


def test_quote_number_parts(spark):
    df = raw_df(spark, [dict(sl_no="1", quote_no="VQ/FG/012/24-25 REV-03"),
                        dict(sl_no="2", quote_no="vq - fg / 7"),
                        dict(sl_no="3", quote_no="GEM/2024/B/7300973"),
                        dict(sl_no="4", quote_no="Open")])
    got = {r.sl_no: (r.base, r.rev) for r in N.quote_number_parts(df).collect()}
    assert got == {1: ("VQ/FG/012/24-25", 3), 2: ("vq - fg / 7", 0)}


@pytest.mark.parametrize("span", [3, 1000])
def test_revision_fold_with_hot_and_long_clusters(spark, monkeypatch, span):
    """One base with most rows, long runs of revisions with a clash below them, late
    rows with early revisions, gaps, and rows equal in everything."""
    monkeypatch.setattr(N, "USUAL_SPAN", span)
    rng = random.Random(9)
    rows = [(i, "HOT", rng.choice([0] * 30 + [1, 2, 3, 900])) for i in range(1200)]
    rows += [(2000 + i, "RUN", i) for i in range(60)] + [(3000 + i, "RUN", rng.choice([0, 5, 59])) for i in range(9)]
    rows += [(4000 + i, "LATE", 40 - i) for i in range(40)] + [(4100, "LATE", 1), (3990, "LATE", 2)]
    rows += [(5000 + i, f"B{i % 7}", rng.randrange(6)) for i in range(100)]
    df = spark.createDataFrame(rows, "sl_no long, base string, rev long").repartition(7)
    assert {r.sl_no: r.rev for r in N.dedupe_revisions(df).collect()} == py_fold(rows)
    same = spark.createDataFrame([(1, "A", 4)] * 50 + [(1, "A", 6)] * 3, df.schema)
    assert sorted(r.rev for r in N.dedupe_revisions(same).collect()) == list(range(4, 57))


def test_numbering_goes_on_over_partitions(spark):
    rows = [(k, i) for k in "abc" for i in range(400 if k == "b" else 3)]
    random.Random(1).shuffle(rows)
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k string, i long").repartition(5)
        got = numbered(df, ["k"], [F.col("i")], "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert len(got) == len(rows) and all(r.n == r.i + 1 for r in got)
