"""Query registrations (one per operator from the survey's inventory)."""

from __future__ import annotations

from ..operators import analysis as A
from ..operators import delivery as D
from ..params import DEFAULT
from . import oracle_queries as OQ
from .catalog import _oq, _tables, register


def _q(name, fn):
    register(name, _oq(name))(lambda spark, sf_dir: fn(_tables(spark, sf_dir), DEFAULT))


_q("v8_otif", D.otif)
_q("q1_funnel", A.q1_funnel)
_q("q2_quote_to_po", A.q2_quote_to_po)
_q("q3_otif_trend", A.q3_otif_trend)
_q("q4_vessel_lead_time", A.q4_vessel_lead_time)
_q("q4b_vessel_sizes", A.q4b_vessel_sizes)
_q("q5_delay_reasons", A.q5_delay_reasons)
_q("q6_receivables_ageing", A.q6_receivables_ageing)
_q("q7_payment_behaviour", A.q7_payment_behaviour)
_q("q8_monthly_billing", A.q8_monthly_billing)
_q("q9_customer_pareto", A.q9_customer_pareto)
_q("q10_open_order_book", A.q10_open_order_book)
_q("q12_ld_exposure", A.q12_ld_exposure)


# ------------------------------------------------------------- register / log
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import DecimalType  # noqa: E402

from ..operators import audit_log as L  # noqa: E402
from ..operators import register as R  # noqa: E402
from . import oracle_register as OR  # noqa: E402
from .oracle_tables import with_tables  # noqa: E402


def as_reported(df):
    """Exact DECIMAL columns are reported as DOUBLE (same on both engines)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _clean(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return R.clean_register(t.raw_quote_register, t.customers, DEFAULT)


def _rows(spark, sf_dir):
    """The cleaned register without the customer's market (no join)."""
    return R.clean_rows(_tables(spark, sf_dir).raw_quote_register, DEFAULT)


register("r26_clean_register",
         lambda p: with_tables(OR.register_cte(p) + "\n" + OR.register_select(), p))(
    lambda spark, sf_dir: as_reported(_clean(spark, sf_dir)))

for _g, _cols in R.GROUPS.items():
    _sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c == "value_inr" else c for c in _cols)
    register(f"r_{_g}", (lambda s: lambda p: with_tables(
        OR.register_cte(p) + f"\nSELECT {s} FROM v_reg", p))(_sel))(
        (lambda g, cols: lambda spark, sf_dir: as_reported(
            (_clean if g == "market" else _rows)(spark, sf_dir).select(*cols)))(_g, _cols))

register("l_cleaning_log", lambda p: with_tables(OR.cleaning_log_sql(p), p))(
    lambda spark, sf_dir: (lambda t: L.cleaning_log(t.raw_quote_register, t.customers, t.orders,
                                                    DEFAULT))(_tables(spark, sf_dir)))
register("q11_lost_business", lambda p: with_tables(OR.q11_sql(p), p))(
    lambda spark, sf_dir: A.q11_lost_business(_rows(spark, sf_dir), DEFAULT))
register("qa_status_mapping", lambda p: with_tables(OR.qa_sql(p), p))(
    lambda spark, sf_dir: A.qa_status_mapping(_rows(spark, sf_dir), DEFAULT))


# ------------------------------------------------------- checks / constraints
from ..operators import checks as C  # noqa: E402
from ..operators import constraints as K  # noqa: E402
from . import oracle_checks as OC  # noqa: E402

register("c_checks", lambda p: with_tables(OC.checks_sql(p), p))(
    lambda spark, sf_dir: C.run_checks(_tables(spark, sf_dir), DEFAULT))

for _k, _fn in (("k1", K.k1_primary_keys), ("k2", K.k2_unique), ("k3", K.k3_foreign_keys),
                ("k4", K.k4_domains), ("k5", K.k5_ranges), ("k6", K.k6_not_null)):
    _name = {"k1": "k1_primary_keys", "k2": "k2_unique_keys", "k3": "k3_foreign_keys",
             "k4": "k4_domains", "k5": "k5_ranges", "k6": "k6_not_null"}[_k]
    register(_name, (lambda k: lambda p: with_tables(OC.k_sql(k), p))(_k))(
        (lambda fn: lambda spark, sf_dir: fn(_tables(spark, sf_dir)))(_fn))


# ----------------------------------------------------------------- privacy
from ..operators import privacy as P  # noqa: E402
from . import oracle_privacy as OP  # noqa: E402


def _scanned(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return t, P.scanned_tables(t, spark, sf_dir)


register("p1_cells", lambda p: with_tables(OP.p1_sql(), p))(
    lambda spark, sf_dir: P.cell_counts(_scanned(spark, sf_dir)[1]))
register("p2_allowlist", lambda p: with_tables(OP.p2_sql(), p))(
    lambda spark, sf_dir: P.allowlist_scan(_tables(spark, sf_dir), spark, sf_dir))
register("p3_patterns", lambda p: with_tables(OP.p3_sql(), p))(
    lambda spark, sf_dir: P.pattern_scan(_scanned(spark, sf_dir)[1]))
register("p4_person_shapes", lambda p: with_tables(OP.p4_sql(), p))(
    lambda spark, sf_dir: P.person_shapes(_scanned(spark, sf_dir)[1]))
register("p5_text_files", lambda p: OP.p5_sql())(P.document_file_findings)
register("p6_privacy_report", lambda p: with_tables(OP.p6_sql(), p))(
    lambda spark, sf_dir: P.privacy_report(_tables(spark, sf_dir), spark, sf_dir))


# ----------------------------------------------------------------- profile
from ..operators import profile as PF  # noqa: E402
from . import oracle_profile as OPF  # noqa: E402

register("f1_funnel_profile", lambda p: with_tables(OPF.f1_sql(p), p))(
    lambda spark, sf_dir: PF.f1_funnel(_rows(spark, sf_dir)))
register("f2_lead_time_quantiles", lambda p: with_tables(OPF.f2_sql(p), p))(
    lambda spark, sf_dir: PF.f2_lead_time_quantiles(_rows(spark, sf_dir)))
register("f3_customer_concentration", lambda p: with_tables(OPF.f3_sql(p), p))(
    lambda spark, sf_dir: PF.f3_concentration(_rows(spark, sf_dir)))
register("f4_fill_rates", lambda p: with_tables(OPF.f4_sql(p), p))(
    lambda spark, sf_dir: PF.f4_fill_rates(_tables(spark, sf_dir).raw_quote_register))
register("f5_vocabulary", lambda p: with_tables(OPF.f5_sql(p), p))(
    lambda spark, sf_dir: PF.f5_vocabulary(_tables(spark, sf_dir).raw_quote_register))
register("f6_job_bands", lambda p: with_tables(OPF.f6_sql(p), p))(
    lambda spark, sf_dir: PF.f6_job_bands(_rows(spark, sf_dir)))


# --------------------------------------------------------------- normalise
from ..operators import normalise as N  # noqa: E402
from . import oracle_normalise as ON  # noqa: E402


def _n_quotes(spark, sf_dir):
    return N.quotations(_tables(spark, sf_dir).raw_quote_register, DEFAULT)


def _n_orders(spark, sf_dir):
    t = _tables(spark, sf_dir)
    raw = t.raw_quote_register
    return N.orders(raw, t.po_document_dates, t.payment_terms)


register("n1_strict_dates", lambda p: with_tables(ON.n1_sql(p), p))(
    lambda spark, sf_dir: N.strict_dates(_tables(spark, sf_dir).raw_quote_register))
register("n3_quote_numbers", lambda p: with_tables(ON.n3_sql(p), p))(
    lambda spark, sf_dir: N.quote_number_parts(_tables(spark, sf_dir).raw_quote_register))
register("n4_revision_dedupe", lambda p: with_tables(ON.n4_sql(p), p))(
    lambda spark, sf_dir: N.dedupe_revisions(
        N.quote_number_parts(_tables(spark, sf_dir).raw_quote_register)))
register("n6_quotations", lambda p: with_tables(ON.n6_sql(p), p))(_n_quotes)
register("n11_orders", lambda p: with_tables(ON.n11_sql(p), p))(_n_orders)
register("n12_payment_terms", lambda p: with_tables(ON.n12_sql(p), p))(
    lambda spark, sf_dir: (lambda t: N.payment_terms_use(t.raw_quote_register, t.orders, t.payment_terms))(
        _tables(spark, sf_dir)))
register("n13_invoices", lambda p: with_tables(ON.n13_sql(p), p))(
    lambda spark, sf_dir: as_reported((lambda t: N.derive_invoices(
        t.dispatches, t.order_lines, t.orders, t.customers, t.payment_terms, t.fx_monthly,
        DEFAULT))(_tables(spark, sf_dir))))
register("n14_register_totals", lambda p: with_tables(ON.n14_sql(p), p))(
    lambda spark, sf_dir: (lambda t: N.register_totals(
        t.raw_quote_register, t.register_links, t.order_lines, t.quotation_lines))(_tables(spark, sf_dir)))
register("n15_link_summary", lambda p: with_tables(ON.n15_sql(p), p))(
    lambda spark, sf_dir: N.link_summary(_n_orders(spark, sf_dir)))

for _name in C.CHECK_NAMES:
    register(C.check_key(_name), (lambda n: lambda p: with_tables(
        OC.checks_sql(p) + f" WHERE check_name = '{n}'", p))(_name))(
        (lambda n: lambda spark, sf_dir: C.one_check(_tables(spark, sf_dir), n, DEFAULT))(_name))


# ------------------------------------------------- slim N and V views
def _n_slim(kind):
    def run(spark, sf_dir):
        t = _tables(spark, sf_dir)
        raw = t.raw_quote_register
        if kind == "n8":
            return N.promised_dates(raw, t.po_document_dates)
        return {"n2": N.quotation_rows, "n5": N.quote_dates, "n7": N.order_rows,
                "n9": N.ld_merge, "n10": N.cancelled}[kind](raw)
    return run


for _kind, _name in (("n2", "n2_quotation_rows"), ("n5", "n5_quote_dates"),
                     ("n7", "n7_order_rows"), ("n8", "n8_promised_dates"),
                     ("n9", "n9_ld_merge"), ("n10", "n10_cancelled")):
    register(_name, (lambda k: lambda p: with_tables(ON.n_slim_sql(k), p))(_kind))(
        _n_slim(_kind))

register("v1_due_orders", lambda p: with_tables(OQ.v_slim_sql("v1", p), p))(
    lambda spark, sf_dir: D.due_orders(_tables(spark, sf_dir).orders, DEFAULT))
register("v2_line_shipments", lambda p: with_tables(OQ.v_slim_sql("v2", p), p))(
    lambda spark, sf_dir: as_reported(
        D.line_shipments(_tables(spark, sf_dir), DEFAULT).drop("item_id")))


# --------------------------------------------------- sources and sinks, round trips
from ..sources import register_io as IO  # noqa: E402

register("s3_register_csv", lambda p: with_tables(
    "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in R.RAW_COLUMNS) + " FROM ob_raw_register", p))(
    lambda spark, sf_dir: IO.reloaded_register(_tables(spark, sf_dir).raw_quote_register))
register("s5_cleaning_log", lambda p: with_tables(OR.cleaning_log_sql(p), p))(
    lambda spark, sf_dir: (lambda t: IO.reloaded_log(L.cleaning_log(
        t.raw_quote_register, t.customers, t.orders, DEFAULT)))(_tables(spark, sf_dir)))
register("s5_check_log", lambda p: with_tables(OC.checks_sql(p), p))(
    lambda spark, sf_dir: IO.reloaded_log(C.run_checks(_tables(spark, sf_dir), DEFAULT)))
register("s6_otif_by_line", lambda p: with_tables(OQ.otif_by_line_sql(p), p))(
    lambda spark, sf_dir: IO.otif_by_line(spark, _tables(spark, sf_dir), DEFAULT))
