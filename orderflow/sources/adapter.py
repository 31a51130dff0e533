"""Derive the order-book tables from the driver's TPC-H-style Parquet tables.

The order book (customers, items, payment terms, quotations, orders, lines,
dispatches, invoices, payments and the all-text register) is derived by fixed
integer rules on the source keys, so the same rows come out on any engine and
at any scale, and the work grows with the source tables. ``K`` below is
``o_orderkey``.

Distribution: every rule is a narrow projection over one source row, except
  * line numbering (a window partitioned by order key; groups are a handful of
    lines per order),
  * per-order line totals (one aggregate on order key),
  * equi-joins on order key / terms code, and one of orders with customers: an
    order carries its customer's market on to dispatches, invoices and register.
The fixed-size dimensions (nation, region, payment terms: 25 / 5 / 14 rows at
any scale) are broadcast explicitly; everything whose size grows with the data
is left to Spark's statistics-based and AQE runtime join selection.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.numeric import cents_to_decimal, idiv, milli_to_decimal
from ..functions.text import fmt_date, literal_table, pick
from ..params import DEFAULT, Params
from . import tpch

# --- fixture rules ---------------------------------------------------------------
ONBOARD_EPOCH = dt.date(1994, 1, 1)
# ids have 16 digits or more, so that none has the shape of a phone number, and
# leave room for 10^5 lines in an order
DISPATCH_BASE = 10 ** 15
# cells that the cleaning and privacy rules have to cope with
EXPONENTS = ["1.2E+07", "3.5e5", "7E2"]
LONG_REVISIONS = [" REV-99999999999", " REV 123456789012345678901234567890"]
IDENTITY_CELLS = ["GST 27ABCDE1234F1Z5", "PAN ABCDE1234F", "see GEM/2024/B/4800123",
                  "call 9876543210"]
ORDER_STATES = {"Delivered", "Order in progress", "Closed", "On hold"}
QUOTE_STATES = {"Quote live", "Lost", "Retender", "Not received", "Closed", "UNUSABLE"}


def _state(wording: str) -> str | None:
    return V.STATUS_MAP.get(wording.strip().upper())


def _is_open(wording: str) -> bool:
    return wording.strip().upper() == V.OPEN_WORDING


ORDER_WORDINGS = [w for w in V.mapped_status_wordings()
                  if w not in V.CANCELLED_WORDS and (_state(w) in ORDER_STATES or _is_open(w))]
QUOTE_WORDINGS = [w for w in V.mapped_status_wordings()
                  if _state(w) in QUOTE_STATES or _is_open(w)]
CATEGORY_BY_LINE = [V.CATEGORY_TEXT[line] for line in V.PRODUCT_LINES]
UOM_BY_LINE = ["Nos", "Mtr", "Sqm"]
PT_CODES = [c for c, _, _, _ in V.PAYMENT_TERMS]


def _padded(letter: str, digits: int, key: Column) -> Column:
    """format_string(letter + "%0<digits>d"), which costs much more a row, on the rest only."""
    text = key.cast("string")
    return (F.when(key.between(0, 10 ** digits - 1), F.concat(F.lit(letter), F.lpad(text, digits, "0")))
            .when(key >= 10 ** digits, F.concat(F.lit(letter), text))
            .otherwise(F.format_string(f"{letter}%0{digits}d", key)))


def customer_id(key: Column) -> Column:
    return _padded("C", 6, key)


def item_id(key: Column) -> Column:
    return _padded("I", 7, key)


def product_line_of_part(partkey: Column) -> Column:
    return pick(V.PRODUCT_LINES, partkey % 3)


def _category(line_idx: Column, k: Column) -> Column:
    # category text of a product line, varied by row key
    return (F.when(line_idx == 0, pick(CATEGORY_BY_LINE[0], k % len(CATEGORY_BY_LINE[0])))
            .when(line_idx == 1, pick(CATEGORY_BY_LINE[1], k % len(CATEGORY_BY_LINE[1])))
            .otherwise(pick(CATEGORY_BY_LINE[2], k % len(CATEGORY_BY_LINE[2]))))


def _person(k: Column) -> Column:
    names = [n for n, _ in V.SALES_PEOPLE]
    inits = [i for _, i in V.SALES_PEOPLE]
    return (F.when(k % 150 == 1, F.lit(V.TWO_PEOPLE_CELL))
            .when(k % 5 < 2, pick(inits, k % 9))
            .otherwise(pick(names, k % 9)))


def _vertical(k: Column, market: Column) -> Column:
    return (F.when(k % 150 == 77, F.lit(V.TWO_PEOPLE_CELL))
            .when(k % 8 == 6, F.lit(None).cast("string"))
            .when(k % 10 == 4, pick(["Internal", "External"], k % 2))
            .when(market == "Export", pick(["Export", "Export-KAG", "Export-Non-KAG"], k % 3))
            .when(market == "Domestic", pick(["Domestic", "DOMESTIC"], k % 2))
            .otherwise(F.lit("Domestic")))


class OrderBook:
    """Lazily derived order-book tables (each a DataFrame, nothing computed)."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = DEFAULT):
        self.spark = spark
        self.sf_dir = sf_dir
        self.params = params

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def _read(self, name: str) -> DataFrame:
        return tpch.read(self.spark, self.sf_dir, name)

    # ---------------------------------------------------------------- dimensions
    @cached_property
    def customers(self) -> DataFrame:
        geo = (self._read("nation")
               .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey")))
        c = self._read("customer")
        k = F.col("c_custkey")
        market = (F.when(k % 10 < 7, "Domestic").when(k % 10 < 9, "Export")
                  .otherwise("Deemed Export"))
        return (c.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .select(
                    customer_id(k).alias("customer_id"),
                    market.alias("market_type"),
                    F.when(market == "Export", F.col("n_name"))
                     .otherwise(F.lit(V.HOME_COUNTRY)).alias("country"),
                    F.when(market == "Export", F.col("r_name"))
                     .when(market == "Domestic", pick(V.DOMESTIC_REGIONS, F.col("c_nationkey") % 4))
                     .otherwise(pick(V.DEEMED_EXPORT_REGIONS, F.col("c_nationkey") % 2))
                     .alias("region"),
                    F.date_sub(F.lit(ONBOARD_EPOCH), (k % 1500).cast("int")).alias("onboarded_date"),
                ))

    @cached_property
    def items(self) -> DataFrame:
        p = self._read("part")
        k = F.col("p_partkey")
        line_idx = k % 3
        dia = F.when(line_idx == 0, pick(V.VESSEL_SIZES_MM, F.col("p_size") % 7))
        return p.select(
            item_id(k).alias("item_id"),
            pick(V.PRODUCT_LINES, line_idx).alias("product_line"),
            pick([c[0] for c in CATEGORY_BY_LINE], line_idx).alias("category"),
            F.when(line_idx == 0, F.concat(F.lit("FRP pressure vessel, "), dia.cast("string"),
                                           F.lit(" mm dia")))
             .otherwise(F.col("p_type")).alias("description"),
            pick(UOM_BY_LINE, line_idx).alias("uom"),
            dia.cast("int").alias("vessel_diameter_mm"),
        )

    @cached_property
    def payment_terms(self) -> DataFrame:
        return literal_table(
            self.spark, [(c, d, n, float(a)) for c, d, n, a in V.PAYMENT_TERMS],
            [("terms_code", "string"), ("description", "string"), ("credit_days", "int"),
             ("advance_pct", "double")])

    # ------------------------------------------------------------------ lines
    @cached_property
    def _lines(self) -> DataFrame:
        """Order lines with their integer price in cents (internal)."""
        l = self._read("lineitem")
        w = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_shipdate")
        qty = F.col("l_quantity").cast("long")
        unit_cents = idiv(F.round(F.col("l_extendedprice") * 100).cast("long"), qty)
        return l.select(
            F.col("l_orderkey").alias("order_id"),
            F.row_number().over(w).cast("int").alias("line_no"),
            F.col("l_partkey").alias("partkey"),
            qty.alias("qty_int"),
            unit_cents.alias("unit_cents"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        return self._lines.select(
            "order_id", "line_no",
            item_id(F.col("partkey")).alias("item_id"),
            F.col("qty_int").cast("decimal(18,3)").alias("ordered_qty"),
            cents_to_decimal(F.col("unit_cents")).alias("unit_price"),
        )

    # ----------------------------------------------------------------- orders
    @cached_property
    def _order_base(self) -> DataFrame:
        """Every per-order rule, including the register-only cells and the market types of
        the customer master's rows of the order's customer (internal)."""
        master = self.customers.groupBy("customer_id").agg(
            F.collect_list(F.struct("market_type")).alias("markets"))
        o = self._read("orders").withColumn("customer_id", customer_id(F.col("o_custkey"))).join(
            master, "customer_id", "left")
        K = F.col("o_orderkey")
        po_date = F.col("o_orderdate").cast("date")
        has_job = K % 10 != 3
        has_po = (K % 9 != 0) | ~has_job
        band = (F.when(K % 50 == 7, 3).when(K % 50 == 17, 4).when(K % 50 == 27, 5)
                .when(K % 50 == 37, 6).when(K % 50 == 47, 7).otherwise(1))
        cancelled = K % 25 == 7
        source = (F.when(K % 33 == 0, "none").when(K % 4 == 1, "register")
                  .otherwise("po_document"))
        promised = F.when(source != "none",
                          F.date_add(po_date, (F.lit(10) + (K * 13) % 60).cast("int")))
        ld_cell = F.when(K % 6 == 0, pick(V.LD_VALUES, idiv(K, 6) % len(V.LD_VALUES)))
        ld_clause_cell = F.when(K % 70 == 36, pick(V.LD_CLAUSE_VALUES,
                                                   idiv(K, 70) % len(V.LD_CLAUSE_VALUES)))
        status = F.when(cancelled, pick(V.CANCELLED_WORDS, K % 5)).otherwise(
            pick(ORDER_WORDINGS, (K * 7) % len(ORDER_WORDINGS)))
        return o.select(
            K.alias("K"),
            "customer_id", "markets",
            po_date.alias("po_date"),
            F.when(has_po, F.concat(F.lit("PO/"), K.cast("string"))).alias("po_no"),
            F.when(has_job, band.cast("long") * F.lit(self.params.job_band_width).cast("long") + K)
             .alias("job_no"),
            (K % 5 < 2).alias("linked"),
            source.alias("promised_date_source"),
            promised.alias("promised_delivery_date"),
            pick(PT_CODES, K % 14).alias("terms_code"),
            ld_cell.alias("ld_cell"),
            ld_clause_cell.alias("ld_clause_cell"),
            status.alias("status_text"),
            cancelled.alias("cancelled"),
            F.when(cancelled, F.date_add(po_date, (F.lit(5) + K % 86).cast("int")))
             .alias("cancellation_date"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        b = self._order_base
        return b.select(
            F.col("K").alias("order_id"),
            F.when(F.col("linked"), F.col("K") * 2).alias("quote_id"),
            "po_no", "po_date", "job_no", "customer_id", "promised_delivery_date",
            "promised_date_source", "terms_code",
            F.coalesce("ld_clause_cell", "ld_cell").alias("ld_clause"),
            F.when(F.col("ld_clause_cell").isNotNull(), "ld_clause_column")
             .when(F.col("ld_cell").isNotNull(), "ld_column").alias("ld_clause_source"),
            F.col("status_text").alias("order_status"),
            "cancellation_date",
        )

    @cached_property
    def _order_facts(self) -> DataFrame:
        """Per order, one aggregate over its lines: product line and quantity of
        line 1, order value in cents (internal)."""
        ln = self._lines
        first = F.col("line_no") == 1
        return ln.groupBy("order_id").agg(
            F.max(F.when(first, F.col("partkey") % 3)).alias("line_idx"),
            F.max(F.when(first, F.col("qty_int"))).alias("first_qty"),
            F.sum(F.col("qty_int") * F.col("unit_cents")).alias("value_cents"))

    # ------------------------------------------------------------- dispatches
    @cached_property
    def _dispatch_rows(self) -> DataFrame:
        """Dispatch rows with the keys their derived rules need (internal)."""
        b = self._order_base.filter(~F.col("cancelled") & (F.col("K") % 11 != 0)).select(
            "K", "po_date", "promised_delivery_date", "customer_id", "markets", "terms_code")
        ln = self._lines.select("order_id", "line_no", "qty_int", "unit_cents")
        j = b.join(ln, b.K == ln.order_id)
        K, line_no, qty = F.col("K"), F.col("line_no"), F.col("qty_int")
        total = F.when(((K + line_no) % 12 == 0) & (qty >= 2), idiv(qty * 4, 5)).otherwise(qty)
        split = ((K * 3 + line_no) % 6 == 0) & (qty >= 4)
        first_date = F.date_add(F.col("po_date"),
                                (F.lit(5) + (K * 7) % 45 + line_no).cast("int"))
        j = j.select("*", total.alias("ship_total"), split.alias("split"),
                     first_date.alias("first_date"))
        parts = F.explode(F.when(F.col("split"), F.array(F.lit(1), F.lit(2)))
                          .otherwise(F.array(F.lit(1))))
        j = j.select("*", parts.alias("part"))
        part = F.col("part")
        half = idiv(F.col("ship_total"), 2)
        d_qty = (F.when(~F.col("split"), F.col("ship_total"))
                 .when(part == 1, half).otherwise(F.col("ship_total") - half))
        d_date = F.when(part == 1, F.col("first_date")).otherwise(
            F.date_add(F.col("first_date"), (F.lit(3) + K % 23).cast("int")))
        out = j.select(
            (F.lit(DISPATCH_BASE) + K * 1_000_000 + line_no * 10 + part).alias("dispatch_id"),
            K.alias("order_id"), line_no.alias("line_no"), part.alias("part"),
            d_date.alias("dispatch_date"),
            # thousandths: some dispatches ship a fraction of a unit
            (d_qty * 1000 - F.when((K % 37 == 4) & (d_qty > 1), 445).otherwise(0))
            .alias("qty_milli"),
            "unit_cents", "customer_id", "markets", "terms_code", "promised_delivery_date",
        )
        return out.filter(F.col("dispatch_date") <= F.lit(self.params.as_of))

    @cached_property
    def dispatches(self) -> DataFrame:
        d = self._dispatch_rows
        late = (F.col("promised_delivery_date").isNotNull()
                & (F.col("dispatch_date") > F.col("promised_delivery_date")))
        return d.select(
            "dispatch_id", "order_id", "line_no", "dispatch_date",
            milli_to_decimal(F.col("qty_milli")).alias("dispatched_qty"),
            pick(V.SHIP_MODES, (F.col("order_id") + F.col("line_no")) % len(V.SHIP_MODES))
             .alias("ship_mode"),
            F.when(late, pick(V.DELAY_REASONS, F.col("order_id") % len(V.DELAY_REASONS)))
             .alias("delay_reason"),
        )

    # --------------------------------------------------------------- invoices
    @cached_property
    def _invoice_rows(self) -> DataFrame:
        d = self._dispatch_rows
        terms = F.broadcast(self.payment_terms.select("terms_code", "credit_days",
                                                      "advance_pct"))
        j = d.select("*", F.inline_outer("markets")).join(terms, "terms_code", "left")
        export = F.col("market_type") == "Export"
        inr_cents = idiv(F.col("qty_milli") * F.col("unit_cents") + 500, 1000)
        ym = F.year("dispatch_date") * 12 + F.month("dispatch_date")
        fx_cents = F.lit(8300) + (ym * 37) % 701
        taxable = F.when(export, idiv(inr_cents * 200 + fx_cents, fx_cents * 2)).otherwise(inr_cents)
        gst = F.when(export, F.lit(0).cast("long")).otherwise(
            idiv(inr_cents * (2 * self.params.gst_rate_pct) + 100, 200))
        return j.select(
            F.col("dispatch_id").alias("invoice_id"),
            F.concat(F.lit("INV/"), F.col("dispatch_id").cast("string")).alias("invoice_no"),
            "dispatch_id", "order_id", "line_no", "part", "customer_id",
            F.col("dispatch_date").alias("invoice_date"),
            F.when(export, "USD").otherwise("INR").alias("currency"),
            F.when(export, cents_to_decimal(fx_cents)).otherwise(
                F.lit(1).cast("decimal(18,2)")).alias("fx_rate_to_inr"),
            taxable.alias("taxable_cents"),
            gst.alias("gst_cents"),
            F.date_add(F.col("dispatch_date"), F.col("credit_days")).alias("due_date"),
            F.col("advance_pct").cast("long").alias("advance_pct"),
        )

    @cached_property
    def invoices(self) -> DataFrame:
        i = self._invoice_rows
        return i.select(
            "invoice_id", "invoice_no", "dispatch_id", "order_id", "customer_id",
            "invoice_date", "currency", "fx_rate_to_inr",
            cents_to_decimal(F.col("taxable_cents")).alias("taxable_value"),
            cents_to_decimal(F.col("gst_cents")).alias("gst_amount"),
            "due_date",
        )

    @cached_property
    def payments(self) -> DataFrame:
        i = self._invoice_rows
        K = F.col("order_id")
        h = (K * 7 + F.col("line_no") * 3 + F.col("part")) % 10
        gross = F.col("taxable_cents") + F.col("gst_cents")
        adv = idiv(gross * F.col("advance_pct"), 100)
        rest = gross - adv
        settle = F.when(adv > 0, "Final").otherwise("Full")
        rest_type = F.when(h == 1, "Part").otherwise(settle)
        rest_amt = F.when(h == 1, idiv(rest, 2)).otherwise(rest)
        rest_date = (F.when(h == 1, F.date_add("due_date", 5))
                     .when(h <= 4, F.date_add(F.col("due_date"), (F.lit(20) + K % 60).cast("int")))
                     .otherwise(F.greatest(F.date_sub(F.col("due_date"), h.cast("int")),
                                           F.col("invoice_date"))))
        rows = F.array(
            F.struct(F.lit(1).alias("seq"), F.lit("Advance").alias("payment_type"),
                     adv.alias("amount_cents"),
                     F.date_sub(F.col("invoice_date"), (h + 1).cast("int")).alias("payment_date")),
            F.struct(F.lit(2).alias("seq"), rest_type.alias("payment_type"),
                     F.when(h != 0, rest_amt).otherwise(F.lit(0).cast("long")).alias("amount_cents"),
                     rest_date.alias("payment_date")),
        )
        p = i.select("invoice_id", F.inline(rows))
        p = p.filter((F.col("amount_cents") > 0)
                     & (F.col("payment_date") <= F.lit(self.params.as_of)))
        return p.select(
            (F.col("invoice_id") * 10 + F.col("seq")).alias("payment_id"),
            "invoice_id", "payment_date",
            cents_to_decimal(F.col("amount_cents")).alias("amount"),
            "payment_type",
        )

    # ------------------------------------------------------------- quotations
    @cached_property
    def _quote_rows(self) -> DataFrame:
        """Linked quotes (won, id 2K) and unlinked quotes (id 2K+1) (internal)."""
        b = self._order_base
        K = F.col("K")
        unlinked = ~F.col("linked") & (K % 7 == 0)
        q = b.filter(F.col("linked") | unlinked)
        K = F.col("K")
        return q.select(
            K.alias("K"),
            F.when(F.col("linked"), K * 2).otherwise(K * 2 + 1).alias("quote_id"),
            F.col("linked"),
            F.concat(F.lit("VQ/FG/"), K.cast("string")).alias("quote_no"),
            (K % 3).cast("int").alias("revision_no"),
            "customer_id",
            F.when(F.col("linked"), F.date_sub(F.col("po_date"), (F.lit(1) + K % 40).cast("int")))
             .otherwise(F.col("po_date")).alias("quote_date"),
            "po_date",
        )

    @cached_property
    def quotations(self) -> DataFrame:
        q = self._quote_rows
        K = F.col("K")
        return q.select(
            "quote_id", "quote_no", "revision_no", "customer_id",
            F.date_sub("quote_date", 7).alias("inquiry_date"),
            "quote_date",
            F.date_add("quote_date", 30).alias("validity_date"),
            F.when(K % 2 == 0, pick(V.INCOTERMS, K % len(V.INCOTERMS))).alias("incoterms"),
            _person(K).alias("salesperson_code"),
            F.when(F.col("linked"), "Won").otherwise(
                pick(QUOTE_WORDINGS, (K * 7) % len(QUOTE_WORDINGS))).alias("status"),
        )

    @cached_property
    def quotation_lines(self) -> DataFrame:
        q = self._quote_rows.select("K", "quote_id")
        ln = self.order_lines
        return q.join(ln, q.K == ln.order_id).select(
            "quote_id", "line_no", "item_id", F.col("ordered_qty").alias("qty"), "unit_price")

    # ------------------------------------------------------- the raw register
    @cached_property
    def raw_quote_register(self) -> DataFrame:
        """The all-text register: one row per order plus, for some orders that
        were not quoted, a quote-only row (one pass: each order explodes into
        its one or two register rows)."""
        b = self._order_base.join(self._order_facts, F.col("K") == F.col("order_id"), "left")
        b = b.select("*", F.inline_outer("markets"))
        terms = F.broadcast(self.payment_terms.select(
            "terms_code", F.col("description").alias("terms_text")))
        b = b.join(terms, "terms_code", "left")
        K = F.col("K")
        quote_only = ~F.col("linked") & ((K % 7 == 0) | (K % 17 == 3) | (K % 19 == 5))
        b = b.select("*", F.explode(F.when(quote_only, F.array(F.lit(0), F.lit(1)))
                                    .otherwise(F.array(F.lit(0)))).alias("_kind"))
        order_row = F.col("_kind") == 0

        def pick_row(for_order, for_quote):
            return F.when(order_row, for_order).otherwise(for_quote)

        none = F.lit(None).cast("string")
        line_idx = F.coalesce(F.col("line_idx"), K % 3)
        value_text = cents_to_decimal(F.col("value_cents")).cast("string")
        po_date = F.col("po_date")
        quote_date = F.when(K % 97 == 5, F.date_add(po_date, 3)).otherwise(
            F.date_sub(po_date, (F.lit(1) + K % 40).cast("int")))
        rev_suffix = (F.when(K % 240 == 11, LONG_REVISIONS[0]).when(K % 480 == 16, LONG_REVISIONS[1])
                      .when(K % 3 > 0, F.concat(F.lit(" REV-0"), (K % 3).cast("string")))
                      .otherwise(F.lit("")))
        # five rows of every sixty share a quote number, and their revisions clash
        quote_key = F.when((K % 60).isin(0, 1, 5, 6, 10), K - K % 60).otherwise(K)
        real_quote = F.concat(F.lit("VQ/FG/"), quote_key.cast("string"), rev_suffix)
        # serial numbers: missing, not a number, or the same as two rows before
        serial = pick_row(K * 2 + 1, K * 2 + 2)
        serial_text = (F.when(K % 401 == 13, F.lit(None).cast("string"))
                       .when(K % 409 == 17, F.concat(F.lit("S"), serial.cast("string")))
                       .when(K % 419 == 19, (serial - 2).cast("string"))
                       .otherwise(serial.cast("string")))
        identity = (F.when(K % 313 == 7, IDENTITY_CELLS[0]).when(K % 317 == 11, IDENTITY_CELLS[1])
                    .when(K % 331 == 13, IDENTITY_CELLS[2]).when(K % 337 == 17, IDENTITY_CELLS[3]))
        gem = F.concat(F.lit("GEM/2001/B/"), (F.lit(7000000) + K % 1000000).cast("string"))
        junk = pick(V.QUOTE_NO_JUNK, K % len(V.QUOTE_NO_JUNK))
        is_quote = K % 7 == 0
        year_txt = F.year(po_date).cast("string")
        po_text = (F.when(K % 499 == 17, F.concat(F.lit("31-11-"), year_txt))
                   .when(K % 503 == 19, F.concat(F.date_format(po_date, "dd.MM."), F.lit("2205")))
                   .otherwise(fmt_date(po_date, K % 3)))
        job_text = F.when(K % 211 == 5, F.concat(F.col("job_no").cast("string"), F.lit("A"))) \
            .otherwise(F.col("job_no").cast("string"))
        dp_text = (F.when(F.col("promised_date_source") == "register",
                          fmt_date(F.col("promised_delivery_date"), (K + 2) % 3))
                   .when(K % 47 == 3, pick(V.DP_FREE_TEXT, K % len(V.DP_FREE_TEXT))))
        return b.select(
            serial_text.alias("sl_no"),
            F.col("customer_id").alias("party"),
            pick(V.PROJECT_WORDS, K % len(V.PROJECT_WORDS)).alias("project"),
            F.when(K % 2 == 0, pick(V.INCOTERMS, K % len(V.INCOTERMS))).alias("incoterms"),
            F.when(K % 3 == 0, pick(V.QUOTE_FROM, K % len(V.QUOTE_FROM))).alias("quote_from"),
            pick_row(F.when(F.col("linked"), real_quote).when(K % 17 == 3, gem)
                     .when(K % 19 == 5, junk),
                     F.when(is_quote, real_quote).when(K % 17 == 3, gem).otherwise(junk))
            .alias("quote_no"),
            pick_row(F.when(F.col("linked"), fmt_date(quote_date, K % 3)),
                     F.when(is_quote, fmt_date(po_date, K % 3))).alias("quote_date"),
            pick_row(F.when(F.col("linked"), fmt_date(F.date_add(quote_date, 30), (K + 1) % 3)),
                     F.when(is_quote, fmt_date(F.date_add(po_date, 30), (K + 1) % 3)))
            .alias("validity_date"),
            _vertical(K, F.col("market_type")).alias("vertical"),
            _category(line_idx, K).alias("category"),
            pick(V.PRODUCT_LINES, line_idx).alias("item"),
            pick_row(F.when(K % 101 == 9, F.lit("n/a")).when(K % 107 == 3, F.lit("1.5E+02"))
                     .when(K % 4 == 0, F.col("first_qty").cast("string")),
                     F.when(K % 4 == 0, F.col("first_qty").cast("string"))).alias("item_qty"),
            pick_row(F.coalesce(identity, F.when(K % 4 == 2, F.lit("E-mail"))), none).alias("inquiry"),
            none.alias("inquiry_date"),
            pick_row(job_text, none).alias("job_no"),
            pick_row(F.col("po_no"), none).alias("po_no"),
            pick_row(po_text, none).alias("po_date"),
            none.alias("po_validity_date"),
            pick_row(dp_text, none).alias("dp_date"),
            pick_row(F.col("status_text"), pick(QUOTE_WORDINGS, (K * 7) % len(QUOTE_WORDINGS)))
            .alias("status"),
            pick_row(F.col("ld_cell"), none).alias("ld"),
            pick_row(F.col("ld_clause_cell"), none).alias("ld_clause"),
            pick_row(F.when(K % 30 == 0, F.col("terms_text")), none).alias("payment_terms"),
            pick_row(F.when(K % 101 == 9, F.lit("n/a"))
                     .when(K % 103 == 11, pick(EXPONENTS, K % len(EXPONENTS)))
                     .when(K % 3 != 0, value_text),
                     F.when(K % 2 == 0, value_text)).alias("po_quote_value"),
            _person(K).alias("concerned_person"),
        )

    # ----------------------------------------- inputs of the normalisation rules
    @cached_property
    def po_document_dates(self) -> DataFrame:
        """Promised dates read off the PO documents, keyed by register row."""
        b = self._order_base.filter(F.col("promised_date_source") == "po_document")
        return b.select((F.col("K") * 2 + 1).alias("sl_no"),
                        F.col("promised_delivery_date").alias("po_promised"))

    @cached_property
    def fx_monthly(self) -> DataFrame:
        """One USD->INR rate per dispatch month (bounded by the number of months)."""
        m = self._dispatch_rows.groupBy(
            F.date_format("dispatch_date", "yyyy-MM").alias("month_key")).agg(
            F.min("dispatch_date").alias("_d"))
        ym = F.year("_d") * 12 + F.month("_d")
        return m.select("month_key", cents_to_decimal(F.lit(8300) + (ym * 37) % 701)
                        .alias("fx_rate"))

    @cached_property
    def register_links(self) -> DataFrame:
        """Register row -> the order (order rows) or quotation (quote-only rows) it holds."""
        b = self._order_base.select("K", "linked")
        K = F.col("K")
        rows = F.array(
            F.struct((K * 2 + 1).alias("sl_no"), K.alias("order_id"),
                     F.lit(None).cast("long").alias("quote_id")),
            F.struct((K * 2 + 2).alias("sl_no"), F.lit(None).cast("long").alias("order_id"),
                     (K * 2 + 1).alias("quote_id")))
        quote_only = ~F.col("linked") & (K % 7 == 0)
        return b.select(F.inline(F.when(quote_only, rows).otherwise(F.slice(rows, 1, 1))))

    @cached_property
    def cleaning_log(self) -> DataFrame:
        """The cleaning log, audited and scanned like any other table."""
        from ..operators.audit_log import cleaning_log
        return cleaning_log(self.raw_quote_register, self.customers, self.orders, self.params)

    TABLES = ("customers", "items", "payment_terms", "quotations", "quotation_lines",
              "orders", "order_lines", "dispatches", "invoices", "payments",
              "raw_quote_register")


def build(spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> OrderBook:
    return OrderBook(spark, sf_dir, params)


# column order of every derived table (the schema the operators rely on)
SCHEMA = {
    "customers": ["customer_id", "market_type", "country", "region", "onboarded_date"],
    "items": ["item_id", "product_line", "category", "description", "uom",
              "vessel_diameter_mm"],
    "payment_terms": ["terms_code", "description", "credit_days", "advance_pct"],
    "quotations": ["quote_id", "quote_no", "revision_no", "customer_id", "inquiry_date",
                   "quote_date", "validity_date", "incoterms", "salesperson_code", "status"],
    "quotation_lines": ["quote_id", "line_no", "item_id", "qty", "unit_price"],
    "orders": ["order_id", "quote_id", "po_no", "po_date", "job_no", "customer_id",
               "promised_delivery_date", "promised_date_source", "terms_code", "ld_clause",
               "ld_clause_source", "order_status", "cancellation_date"],
    "order_lines": ["order_id", "line_no", "item_id", "ordered_qty", "unit_price"],
    "dispatches": ["dispatch_id", "order_id", "line_no", "dispatch_date", "dispatched_qty",
                   "ship_mode", "delay_reason"],
    "invoices": ["invoice_id", "invoice_no", "dispatch_id", "order_id", "customer_id",
                 "invoice_date", "currency", "fx_rate_to_inr", "taxable_value", "gst_amount",
                 "due_date"],
    "payments": ["payment_id", "invoice_id", "payment_date", "amount", "payment_type"],
    "raw_quote_register": ["sl_no", "party", "project", "incoterms", "quote_from", "quote_no",
                           "quote_date", "validity_date", "vertical", "category", "item",
                           "item_qty", "inquiry", "inquiry_date", "job_no", "po_no", "po_date",
                           "po_validity_date", "dp_date", "status", "ld", "ld_clause",
                           "payment_terms", "po_quote_value", "concerned_person"],
}
