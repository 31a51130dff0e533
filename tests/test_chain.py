"""A register and its records, built into the tables Q1 and V8 take."""

from pyspark.sql import functions as F

from orderflow.operators.analysis import q1_funnel
from orderflow.operators.delivery import otif
from orderflow.sources.chain import RegisterBook


def test_questions_run_over_a_register(book):
    def serial(df, column="order_id"):  # the fixture's order K stands in row 2K + 1
        return df.withColumn(column, F.col(column) * 2 + 1)
    own = RegisterBook(
        book.raw_quote_register, book.customers, book.items, book.payment_terms, book.po_document_dates,
        serial(book.order_lines), serial(book.order_lines).select(
            F.col("order_id").alias("quote_id"), "line_no", "item_id", F.col("ordered_qty").alias("qty"),
            "unit_price"),
        serial(book.dispatches), book.payments, book.fx_monthly)
    got = {r.order_id: (r.on_time, r.in_full, r.days_late) for r in otif(own).collect()}
    want = {r.order_id * 2 + 1: (r.on_time, r.in_full, r.days_late) for r in otif(book).collect()}
    both = set(got) & set(want)
    # only rows with an unusable serial number or date differ
    assert len(both) > 0.95 * len(want) and all(got[k] == want[k] for k in both)
    funnel = q1_funnel(own).collect()
    assert sum(r.orders_total for r in funnel) > 0.95 * book.orders.count()
    assert 0 < sum(r.quotes_won for r in funnel) <= sum(r.quotes_issued for r in funnel)
    assert own.invoices.count() > 0
