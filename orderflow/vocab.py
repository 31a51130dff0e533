"""Fixed vocabularies of the order book.

FIXED VALUES. Every list and mapping below must equal the source register's
wording for the cleaning rules and the checks to give the right results. They
are kept here, in their natural order, as plain data; the operators read them
and turn them into literal map / array expressions, so a user can edit a
mapping without touching operator code.
"""

from __future__ import annotations

# --- FIXED VALUES: product lines and vessel sizes --------------------------------
PRODUCT_LINES = ["Pressure Vessel", "Pultrusion", "Grating"]
VESSEL_SIZES_MM = [1400, 1600, 1800, 2000, 2400, 2600, 3000]
MARKET_TYPES = ["Domestic", "Export", "Deemed Export"]
PROMISED_DATE_SOURCES = ["register", "po_document", "none"]
CURRENCIES = ["INR", "USD"]
PAYMENT_TYPES = ["Advance", "Part", "Full", "Final"]
LOG_ACTIONS = ["FLAGGED", "MAPPED", "FILLED", "PARSED", "EXCLUDED"]

# --- FIXED VALUES: status wordings as typed in the register ----------------------
STATUS_AS_TYPED = [
    "PO Received & Delivered", "Open", "PO RECEIVED & DELIVERED", "Closed", "CLOSED",
    "Not Received", "PO RECEIVED", "NOT RECEIVED", "OPEN", "PO Received",
    "Work in Progress", "Budgetary", "LOST", "Order Confirmed", "BUDGETARY",
    "PENDING", "Po Received & Delivered", "PO received & Delivered", "On Hold",
    "UNDER DISCUSSION", "Lost", "LOA", "Cancel", "Work in progress",
    "PO Not Received", "RETENDER", "Pending", "RFQ Submitted",
    "HANDED OVER TO CUSTOMER", "Retender", "CANCELED", "ON HOLD", "LOA RECEIVED",
    "CANCELLED", "UNDER HOLD", "Cancelled", "CANCEL", "Supply-HO",
    "Handed over to customer", "Bill", "Quotation submitted", "Under Discussion",
    "lost", "LOA Received", "PO RECEIVED & Delivered",
]

# --- FIXED VALUES: upper(trim(status)) -> state ----------------------------------
# 'OPEN' is context dependent (see OPEN_WORDING) and has no entry here.
STATUS_MAP = {
    "PO RECEIVED & DELIVERED": "Delivered",
    "PO RECEIVED": "Order in progress",
    "WORK IN PROGRESS": "Order in progress",
    "ORDER CONFIRMED": "Order in progress",
    "LOA": "Order in progress",
    "LOA RECEIVED": "Order in progress",
    "PENDING": "Order in progress",
    "CANCEL": "Cancelled",
    "CANCELED": "Cancelled",
    "CANCELLED": "Cancelled",
    "ON HOLD": "On hold",
    "UNDER HOLD": "On hold",
    "BUDGETARY": "Quote live",
    "UNDER DISCUSSION": "Quote live",
    "RFQ SUBMITTED": "Quote live",
    "QUOTATION SUBMITTED": "Quote live",
    "RETENDER": "Retender",
    "LOST": "Lost",
    "CLOSED": "Closed",
    "NOT RECEIVED": "Not received",
    "PO NOT RECEIVED": "Not received",
    "SUPPLY-HO": "UNUSABLE",
    "BILL": "UNUSABLE",
}
OPEN_WORDING = "OPEN"
OPEN_AS_ORDER = "Order in progress"
OPEN_AS_QUOTE = "Quote live"
UNMAPPED = "UNMAPPED"

# exact wordings that make an order cancelled in the normalised tables
CANCELLED_WORDS = ["Cancel", "CANCEL", "CANCELED", "CANCELLED", "Cancelled"]

# outcome states reported by the lost-business query
LOST_OUTCOMES = ["Lost", "Cancelled", "Retender", "Not received", "Closed"]

# --- FIXED VALUES: LD cells ------------------------------------------------------
LD_VALUES = [
    "NA", "Not Applicable", "No", "YES", "—",
    "Aug,25", "Dec,25", "Sept,25", "Jan,26", "Nov,25", "Oct,25", "July,25",
    "Nov-25,Dec-25", "Dec-25,Jan-26", "April,25", "Oct-25,Dec-25",
    "Jul-25,Aug-25,Sept-25", "Sept-25,Oct-25,Nov-25,Dec-25", "June-25 & July-25",
    "Jul-25 & Aug-25", "Nov-25,Dec-25,Jan-26", "Sept-25 & Oct-25",
    "Lost",
    "2025-07-01 00:00:00", "2025-08-01 00:00:00",
    "0.5% per week",
    "Not mentioned",
    "0.5% for the first 2 weeks and 1% thereafter, subject to a maximum of 5%",
    "0.50 % per week or part thereof for the portion executed / supplied",
    "0.5% of total subcontract value/week or part thereof; max. 5%",
    "0.5% per Week of delay for 1st 4 Weeks thereafter 1.5% per week",
    "2%/month if material not lifted within 15 days of inspection call",
    "For LD Purpose, Date of site readiness clearance will only be considered",
    "Ref. As per original agreement",
    "LD charges will be applicable on actual handover date to 3PL and same will "
    "be considered by warehouse team for LD applicability",
    "100% basic payment along with 100% Taxes & Duties within 45 days",
    "Payment terms - 25% Adv. & 75% on 90 Days LC",
]
LD_CLAUSE_VALUES = [
    "Not mentioned",
    "LD charges will be applicable on actual handover date to 3PL and same will "
    "be considered by warehouse team for LD applicability",
]

# the cleaned register's applicability flags (ld_kind)
LD_FLAG_WORDS = ["NA", "Not Applicable", "No", "YES", "—", "Not mentioned"]
# the LD exposure query's "explicitly none" list (a different list on purpose)
LD_NONE_WORDS = ["NA", "Not Applicable", "No", "Not mentioned"]
MONTH_PREFIXES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep",
                  "Oct", "Nov", "Dec"]
# ld kinds that are logged as "not a clause at all"
LD_NOT_A_CLAUSE = ["delivery month in the wrong column", "status in the wrong column",
                   "payment terms in the wrong column", "excel timestamp"]

# --- FIXED VALUES: people --------------------------------------------------------
SALES_PEOPLE = [
    ("Ishan Kabir", "IK"), ("Niharika Vora", "NV"), ("Zubin Tandon", "ZT"),
    ("Anika Rao", "AR"), ("Farhan Qureshi", "FQ"), ("Rohan Mehta", "RM"),
    ("Yash Nagpal", "YN"), ("Ketan Oza", "KO"), ("Hemal Zaveri", "HZ"),
]
TWO_PEOPLE_CELL = "Rohan Mehta /Anika Rao"
INITIALS_MAP = {initials: name for name, initials in SALES_PEOPLE}
PEOPLE = ([name for name, _ in SALES_PEOPLE] + [ini for _, ini in SALES_PEOPLE]
          + [TWO_PEOPLE_CELL])

# --- FIXED VALUES: places, markets, categories, projects -------------------------
INCOTERMS = ["Ex-Works Plant 1", "EX-WORKS PLANT 1", "EX-WORKS PLANT-1",
             "Ex-Works", "Ex-works Plant 1", "FOB", "ExW",
             "EX-WORKS PLANT 2", "Ex works", "FOR", "EXW", "FOR SITE"]
QUOTE_FROM = ["HO", "NA", "H.O.", "PLANT 2"]
PLACES = INCOTERMS + QUOTE_FROM
VERTICALS = ["Domestic", "DOMESTIC", "Internal", "External", "Export",
             "Export-KAG", "Export-Non-KAG", TWO_PEOPLE_CELL]
CATEGORY_TEXT = {
    "Pressure Vessel": ["FRP Vessel", "VESSEL", "Vessel", "Pressure Vessel",
                        "FRP Pressure Vessel"],
    "Pultrusion": ["Pultrusion", "PULTRUSION", "Pultruded Profiles",
                   "Pultrusion - Handrail"],
    "Grating": ["Grating", "GRATING", "Moulded Grating", "Pultruded Grating"],
}
PROJECT_WORDS = [
    "Tank Farm Revamp", "ETP Upgradation", "Caustic Storage", "Walkway & Handrail",
    "Cooling Tower Replacement", "Desalination Package", "Bio Tank Package",
    "Platform Extension", "Chlorine Dosing Skid", "Effluent Line Replacement",
    "Clarifier Internals", "RO Skid Package", "Brine Handling", "Scrubber Package",
    "Sea Water Intake", "Pickling Line Covers", "Acid Dilution Unit",
    "Filter Press Area", "Sump Covers", "Cable Trench Covers", "Pump House Flooring",
]
DOMESTIC_REGIONS = ["East", "West", "South", "North"]
DEEMED_EXPORT_REGIONS = ["West", "South"]
HOME_COUNTRY = "India"

# --- FIXED VALUES: free text typed where a delivery date belongs -----------------
DP_FREE_TEXT = [
    "AS EARLY AS POSSIBLE",
    "8–10 weeks from receipt of PO, drawing approval and manufacturing clearance",
    "As early as possible", "Immediate", "31-11-2024", "6 WEEKS DATE OF ISSUAL OF PO",
    "WEDNESDAY(25/03/2026)", "IMMEDIATE", "NA",
    "Delivery within 10–12 weeks from confirmation along with design & drawing "
    "acceptance",
    "AEAP", "With In4-6Weeks", "7-10 days from date of order",
    "4-6 WEEKS FROM THE DATE OF RECEIPT OF PO, DRG APPROVAL",
    "7-10 Days (Extra charges applicable)",
    "17.11.2026 (Within 60 days from the date of received of PO)",
    "Last weeks of August 2026",
]

# --- FIXED VALUES: status words typed into the quote-number column ---------------
QUOTE_NO_JUNK = ["Open", "po received & delivered", "PO received", "Closed",
                 "Work in Process", "verbally confirmed", "Quoted Verbally",
                 "Rfq submitted"]

# --- FIXED VALUES: payment terms (code, wording, credit days, advance %) --------
PAYMENT_TERMS = [
    ("PT01", "45 Days Credit", 45, 0),
    ("PT02", "100%Against Delivery", 0, 0),
    ("PT03", "Current dated cheque against delivery", 0, 0),
    ("PT04", "100% payment advance along with PO", 0, 100),
    ("PT05", "Payment due immediately from date of invoice", 0, 0),
    ("PT06", "100% prior to dispatch of materials", 0, 100),
    ("PT07", "45 days credit – MSME / 90 days – non-MSME", 45, 0),
    ("PT08", "100% basic payment + 100% taxes & duties within 45 days from date "
             "of delivery", 45, 0),
    ("PT09", "30% advance with PO balance, 70% post material readiness", 30, 30),
    ("PT10", "100% Payment Prior to Dispatch", 0, 100),
    ("PT11", "100% against the receipt of materials", 0, 0),
    ("PT12", "25% on order confirmation, 25% after fabrication of cylinders/heads "
             "against photographs, 45% before dispatch, 5% upon arrival (as agreed "
             "via email attachment).", 0, 50),
    ("PT13", "100% through a TReDS receivables platform, with 180 "
             "usance days from date of dispatch, with 10% PBG valid for 24 months",
     180, 0),
    ("PT14", "To be short closed.", 0, 0),
]

# --- FIXED VALUES: dispatch vocabulary -------------------------------------------
SHIP_MODES = ["Road", "Flat rack", "40HC", "20FT", "Rail", "Air"]
DELAY_REASONS = ["Customer hold on drawing approval", "Raw material not received",
                 "Inspection call delayed by customer", "Transport not arranged",
                 "Capacity clash with another job", "Payment milestone not met",
                 "Dimensional rework after inspection", "Site not ready"]

# --- FIXED VALUES: words the register must never contain -------------------------
FORBIDDEN_STATUS = ["Verbally Confirmed", "Closed/Not Received"]
FORBIDDEN_LD_FRAGMENT = "Appl:Y"

# --- FIXED VALUES: item descriptions of the price list ---------------------------
ITEM_DESCRIPTIONS = ["FRP pressure vessel", "Pultruded handrail section",
                     "Pultruded angle profile", "Pultruded channel profile",
                     "Pultruded tube 50x50", "Pultruded ladder stringer",
                     "Moulded grating 38 mm, 1x4 m panel", "Moulded grating 25 mm, 1x4 m panel",
                     "Pultruded grating 40 mm panel", "Grating with anti-skid grit top",
                     "Stair tread with nosing"]

# --- FIXED VALUES: privacy scan patterns (Java regex) ----------------------------
PRIVACY_PATTERNS = [
    ("email address", r"[\w\.\-]+@[\w\.\-]+\.\w{2,}"),
    ("Indian mobile number", r"(?<![\w.])(?:\+91[\s\-]?)?[6-9]\d{9}(?![\w.])"),
    ("GSTIN", r"\b\d{2}[A-Z]{5}\d{4}[A-Z]\d[A-Z]\d\b"),
    ("PAN", r"\b[A-Z]{5}\d{4}[A-Z]\b"),
    ("tender ref in an actual serial range",
     r"GEM/\d{4}/[A-Z]/(?:4[89]\d{5}|[56]\d{6})(?!\d)"),
]
PERSON_SHAPE = r"\b[A-Z][a-z]{2,}\s+[A-Z][a-z]{2,}\b"

# --- FIXED VALUES: quotation-number patterns -------------------------------------
QUOTE_NO_PATTERN = r"(?i)^VQ\s*[/-](?:\s*[A-Z&.]{1,6}\s*[/-]){1,3}\s*\d{1,4}"
REVISION_PATTERN = r"(?i)rev\s*[.\-]?\s*(\d+)"

# states of the as-typed vocabulary that have a cleaning rule
def mapped_status_wordings() -> list[str]:
    """As-typed wordings the status rule maps (drops wordings with no rule)."""
    return [s for s in STATUS_AS_TYPED
            if s.strip().upper() in STATUS_MAP or s.strip().upper() == OPEN_WORDING]
