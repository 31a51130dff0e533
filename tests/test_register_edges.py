"""Hand-written register rows covering every cleaning branch (literal expectations)."""

import datetime as dt
from decimal import Decimal

import pytest

from orderflow.operators.register import RAW_COLUMNS, clean_register
from orderflow.params import Params

P = Params(year_window=(2023, 2027))
CUSTOMERS = [("C000001", "Domestic"), ("C000002", "Export")]


def _rows():
    rows = [
        dict(sl_no="1", quote_date="30.11.2024", po_date="30-11-2024", dp_date="2024-11-30",
             party="C000001", job_no="10555", status="PO RECEIVED & DELIVERED"),
        dict(sl_no="2", dp_date="31-11-2024", po_date="01.12.2024", job_no="12abc", status="Open"),
        dict(sl_no="3", po_date="01.13.2024", status="Open", job_no="abc"),
        dict(sl_no="4", po_date="32.01.2024", po_no="P1", status="HANDED OVER TO CUSTOMER"),
        dict(sl_no="5", po_date="12.05.2205", po_no="P2"),
        dict(sl_no="6", dp_date="AEAP", status="Supply-HO"),
        dict(sl_no="7", dp_date="WEDNESDAY(25/03/2026)", status=" po received & delivered "),
        dict(sl_no="8", dp_date=" 30.11.2024"),
        dict(sl_no="9", quote_no="VQ/FG/012/24-25", ld="NA", vertical="Export-KAG",
             concerned_person="IK", po_quote_value="1234.50", incoterms="Ex works"),
        dict(sl_no="10", quote_no="vq-FG-1-24-25 REV-03", ld="Lost", vertical="DOMESTIC",
             party="C000002", concerned_person="Ishan Kabir", po_quote_value="n/a",
             incoterms="EX-WORKS PLANT-1", item_qty="12"),
        dict(sl_no="11", quote_no="GEM/2024/B/7300973", ld="0.5% per week", vertical="Internal",
             concerned_person="Rohan Mehta /Anika Rao", item_qty="n/a"),
        dict(sl_no="12", quote_no="po received & delivered", vertical="Rohan Mehta /Anika Rao",
             ld="100% basic payment along with 100% Taxes & Duties within 45 days",
             party="C999999", item_qty=""),
        dict(sl_no="13", ld="payment within 30 days of delivery", vertical="Domestic",
             party="C999999"),
        dict(sl_no="14", ld="2025-07-01 00:00:00", ld_clause="Not mentioned"),
        dict(sl_no="15", ld="Sept,25"),
        dict(sl_no="16", ld="Ref. As per original agreement"),
        dict(sl_no="17", ld="For LD Purpose, Date of site readiness clearance will only be considered"),
        dict(sl_no="18", ld="something else entirely"),
    ]
    return [tuple(r.get(c) for c in RAW_COLUMNS) for r in rows]


@pytest.fixture(scope="module")
def clean(spark):
    raw = spark.createDataFrame(_rows(), ", ".join(f"{c} string" for c in RAW_COLUMNS))
    cust = spark.createDataFrame(CUSTOMERS, "customer_id string, market_type string")
    return {r.sl_no: r for r in clean_register(raw, cust, P).collect()}


def test_one_row_per_raw_row(clean):
    assert len(clean) == 18


def test_three_date_layouts(clean):
    r = clean[1]
    assert r.quote_date == r.po_date == r.dp_date == dt.date(2024, 11, 30)
    assert r.date_impossible is False and r.dp_is_free_text is False
    assert r.po_date_format == "dd-mm-yyyy"


def test_impossible_and_unparseable_dates(clean):
    assert clean[2].dp_date is None and clean[2].date_impossible is True
    assert clean[3].po_date is None and clean[3].date_impossible is None   # month 13
    assert clean[4].po_date is None and clean[4].date_impossible is None   # day 32


def test_wrong_year_is_kept_and_flagged(clean):
    assert clean[5].po_date == dt.date(2205, 5, 12) and clean[5].year_suspect is True
    assert clean[1].year_suspect is False


def test_free_text_and_padded_cells(clean):
    assert clean[6].dp_is_free_text is True and clean[7].dp_is_free_text is True
    assert clean[8].dp_date is None and clean[8].dp_is_free_text is True


def test_quote_numbers(clean):
    assert clean[9].quote_no_is_real and not clean[9].quote_is_revision
    assert clean[10].quote_no_is_real and clean[10].quote_is_revision
    assert clean[11].quote_no_is_tender and not clean[11].quote_no_holds_other
    assert clean[12].quote_no_holds_other
    assert clean[1].quote_no_holds_other is False and clean[1].quote_is_revision is False


def test_job_numbers(clean):
    assert (clean[1].job_no, clean[2].job_no, clean[3].job_no, clean[4].job_no) == \
        (10555, 12, None, None)
    assert clean[1].job_band == 0  # 10555 // 1e9 bands


def test_status_mapping(clean):
    assert clean[1].status_clean == "Delivered"
    assert clean[2].status_clean == "Order in progress"   # Open with a job number
    assert clean[3].status_clean == "Order in progress"   # job cell filled, even if junk
    assert clean[4].status_clean == "UNMAPPED"
    assert clean[5].status_clean == "UNMAPPED"            # NULL status
    assert clean[6].status_clean == "UNUSABLE"
    assert clean[7].status_clean == "Delivered"           # case and spaces folded


def test_open_without_order_is_quote_live(spark):
    raw = spark.createDataFrame([tuple("Open" if c == "status" else ("1" if c == "sl_no" else None)
                                       for c in RAW_COLUMNS)],
                                ", ".join(f"{c} string" for c in RAW_COLUMNS))
    cust = spark.createDataFrame(CUSTOMERS, "customer_id string, market_type string")
    assert clean_register(raw, cust, P).first().status_clean == "Quote live"


def test_ld_kinds_in_order(clean):
    kinds = {k: clean[k].ld_kind for k in range(9, 19)}
    assert kinds == {
        9: "applicability flag", 10: "status in the wrong column", 11: "genuine clause",
        12: "genuine clause",  # '%' wins over 'payment'
        13: "payment terms in the wrong column", 14: "applicability flag",  # clause column wins
        15: "delivery month in the wrong column", 16: "genuine clause", 17: "genuine clause",
        18: "other prose"}
    assert clean[14].ld_source == "ld_clause" and clean[14].ld_both_populated is True
    assert clean[15].ld_source == "ld" and clean[15].ld_both_populated is False


def test_vertical_and_market(clean):
    assert [clean[k].vertical_clean for k in (9, 10, 11, 12, 1)] == \
        ["Export", "Domestic", "NOT A MARKET", "UNMAPPED", None]
    assert clean[10].export_mislabelled is True      # Domestic in register, Export master
    assert clean[13].export_mislabelled is None      # unknown customer


def test_people(clean):
    assert clean[9].salesperson == clean[10].salesperson == "Ishan Kabir"
    assert clean[11].salesperson_two_names is True
    assert clean[9].salesperson_two_names is False


def test_values_quantities_incoterms(clean):
    assert clean[9].value_inr == Decimal("1234.50")
    assert clean[10].value_inr is None
    assert clean[10].item_qty == 12.0 and clean[11].item_qty == 0.0 and clean[12].item_qty is None
    assert clean[9].incoterms_clean == "EX-WORKS"
    assert clean[10].incoterms_clean == "EX-WORKS PLANT-1"
