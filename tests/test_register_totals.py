"""Register rows without a quotation do not meet in one task."""

from orderflow.operators.normalise import register_totals


def test_no_join_brings_rows_without_a_key_together(spark, book):
    df = register_totals(book.raw_quote_register, book.register_links, book.order_lines, book.quotation_lines)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for key in ("order_id", "quote_id"):
        assert f"isnull({key}" in plan  # kept apart from the joins
    assert df.count() == book.raw_quote_register.count()
