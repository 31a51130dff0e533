"""Run parameters: dataset facts and thresholds, kept out of operator code."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # reporting date every ageing / due / open-book figure is measured at
    as_of: dt.date = dt.date(2001, 8, 31)
    # days of slack before an order counts as due (moves only the due cut-off)
    grace_days: int = 0
    # a PO year outside this window is a typo, not a date
    year_window: tuple[int, int] = (1994, 2002)
    # job numbers are banded by this width; band 1 is the main series
    job_band_width: int = 10 ** 17
    # date-shaped vessel size bands (upper bounds, labels) and the base band
    size_bands: tuple[tuple[int, str], ...] = (
        (1800, "1 small (1400-1800)"),
        (2400, "2 medium (2000-2400)"),
        (10**9, "3 large (2600-3000)"),
    )
    base_size_band: str = "2 medium (2000-2400)"
    # minimum group sizes before a group is reported
    min_lead_time_orders: int = 5
    min_orders_due_per_quarter: int = 5
    min_late_orders_per_reason: int = 2
    min_invoices_per_customer: int = 3
    top_customers_reported: int = 15
    pareto_top_k: int = 5
    # payment tolerance (currency units) and invoice tolerance (INR)
    settle_tolerance: int = 1
    invoice_tolerance_inr: int = 2
    outstanding_floor_inr: int = 1
    # validation thresholds
    expected_register_rows: int | None = None      # None: only require non-empty
    expected_rows_per_line: dict[str, int] | None = None
    otif_range_pct: tuple[float, float] = (25.0, 75.0)
    no_quote_range_pct: tuple[float, float] = (40.0, 80.0)
    job_band1_share_pct: float = 90.0
    job_band1_tolerance_pct: float = 4.0
    min_job_bands: int = 5
    fx_usd_range: tuple[float, float] = (83.0, 90.0)
    gst_rate_pct: int = 18
    overship_factor: float = 1.01
    min_log_rows: int = 15
    min_log_actions: int = 4
    customer_id_pattern: str = r"^C[0-9]{6,}$"
    ageing_bounds: tuple[int, ...] = (0, 30, 60, 90)
    open_book_bounds: tuple[int, ...] = (30, 60, 90)
    extra: dict = field(default_factory=dict)


DEFAULT = Params()
