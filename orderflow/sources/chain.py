"""From a register to the tables the questions are asked of.

``RegisterBook`` has the same tables as the derived order book (``TABLES``), built
by the normalisation rules from a register and the records kept beside it, so
that every Q, V, C and K operator runs on a user's own data::

    book = RegisterBook(register, customers, items, terms, po_dates, order_lines,
                        quotation_lines, dispatches, payments, fx_monthly)
    otif(book); q1_funnel(book); run_checks(book)

Quotations and orders are keyed by the register's serial number; order lines,
quotation lines and dispatches name it in their ``order_id`` / ``quote_id``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import normalise as N
from ..params import DEFAULT, Params
from .adapter import SCHEMA, OrderBook


class RegisterBook:
    TABLES = OrderBook.TABLES

    def __init__(self, register: DataFrame, customers: DataFrame, items: DataFrame,
                 payment_terms: DataFrame, po_document_dates: DataFrame, order_lines: DataFrame,
                 quotation_lines: DataFrame, dispatches: DataFrame, payments: DataFrame,
                 fx_monthly: DataFrame, cancellations: DataFrame | None = None,
                 params: Params = DEFAULT):
        self.raw_quote_register, self.customers, self.items = register, customers, items
        self.payment_terms, self.po_document_dates = payment_terms, po_document_dates
        self.order_lines, self.quotation_lines = order_lines, quotation_lines
        self.dispatches, self.payments, self.fx_monthly = dispatches, payments, fx_monthly
        self.cancellations, self.params = cancellations, params

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def quotations(self) -> DataFrame:
        return N.quotations(self.raw_quote_register, self.params).select(*SCHEMA["quotations"])

    @cached_property
    def orders(self) -> DataFrame:
        """Orders; a cancelled one without a known date counts from its PO date."""
        o = N.orders(self.raw_quote_register, self.po_document_dates, self.payment_terms)
        known = F.lit(None).cast("date")
        if self.cancellations is not None:
            o = o.join(self.cancellations.select("order_id", F.col("cancellation_date").alias("_known")),
                       "order_id", "left")
            known = F.col("_known")
        return o.withColumn("cancellation_date", F.when(
            F.col("is_cancelled"), F.coalesce(known, F.col("po_date")))).select(*SCHEMA["orders"])

    @cached_property
    def invoices(self) -> DataFrame:
        return N.derive_invoices(self.dispatches, self.order_lines, self.orders, self.customers,
                                 self.payment_terms, self.fx_monthly, self.params)

    @cached_property
    def cleaning_log(self) -> DataFrame:
        from ..operators.audit_log import cleaning_log
        return cleaning_log(self.raw_quote_register, self.customers, self.orders, self.params)
