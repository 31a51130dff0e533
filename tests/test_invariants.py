"""Relations that must hold between the outputs."""

from pyspark.sql import functions as F

from orderflow.operators import analysis as A
from orderflow.operators.delivery import otif
from orderflow.operators.register import clean_register


def test_clean_register_keeps_every_row(book):
    assert clean_register(book.raw_quote_register, book.customers).count() == \
        book.raw_quote_register.count()


def test_otif_is_product_of_flags(book):
    v = otif(book)
    assert v.filter(F.col("otif") != F.col("on_time") * F.col("in_full")).count() == 0
    assert v.filter((F.col("on_time") == 1) & (F.col("days_late") > 0)).count() == 0


def test_ageing_shares_sum_to_100(book):
    s = A.q6_receivables_ageing(book).agg(F.sum("pct_of_total")).first()[0]
    assert abs(s - 100.0) <= 0.3


def test_running_total_ends_at_sum(book):
    rows = A.q8_monthly_billing(book).orderBy("month_key").collect()
    assert abs(rows[-1].running_total_inr - sum(r.invoiced_inr for r in rows)) < 1e-6
    for a, b in zip(rows, rows[1:]):
        assert b.vs_prev_month == b.invoiced_inr - a.invoiced_inr


def test_open_book_partition(book):
    open_n = A.q10_open_order_book(book).agg(F.sum("open_orders")).first()[0]
    with_line1 = book.orders.join(book.order_lines.filter("line_no = 1"), "order_id")
    shipped = with_line1.join(book.dispatches.select("order_id"), "order_id", "left_semi")
    not_shipped = with_line1.join(book.dispatches.select("order_id"), "order_id", "left_anti")
    cancelled_unshipped = not_shipped.filter(F.col("cancellation_date").isNotNull()).count()
    assert open_n + shipped.count() + cancelled_unshipped == with_line1.count()


def test_q3_lag_skips_dropped_quarters(book):
    rows = A.q3_otif_trend(book).collect()
    by_line = {}
    for r in rows:
        by_line.setdefault(r.product_line, []).append(r)
    for line_rows in by_line.values():
        line_rows.sort(key=lambda r: ((int(r.quarter_label[2:4]) + 50) % 100, r.quarter_label[-1]))
        assert line_rows[0].vs_prev_quarter is None
        for a, b in zip(line_rows, line_rows[1:]):
            assert round(b.vs_prev_quarter, 1) == round(b.otif_pct - a.otif_pct, 1)


def test_q4_factor_is_ratio_of_rounded_means(book):
    rows = {r.grouping: r for r in A.q4_vessel_lead_time(book).collect()}
    base = rows["2 medium (2000-2400)"].mean_promised
    for r in rows.values():
        assert abs(r.factor_vs_medium - r.mean_promised / base) <= 0.005 + 1e-9
