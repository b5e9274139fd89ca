"""Small claim tables of our own with known outcomes."""

from datetime import date

from claimworks.constants import RAW_COLUMNS


def _claim(number, **fields):
    sound = {
        "claim_id": f"T-{number}", "member_id": f"PERSON{number}", "provider_npi": "1555000111",
        "service_date": "2025-04-15", "icd10_code": "K21.0", "cpt_code": "74022", "billed_amount": "$2,000.00",
        "allowed_amount": "1900.00", "paid_amount": "$1,500.00", "claim_status": " Approved", "payer_id": "north",
        "line_of_business": "retail", "network_flag": "in",
    }
    return tuple({**sound, **fields}[c] for c in RAW_COLUMNS)


#: A sound claim, a denied one with a slashed date, a copy of the first, one without a member and one
#: with amounts below zero.
RAW = [
    _claim(1),
    _claim(2, service_date="4/2/2025", claim_status="denied", billed_amount="310", allowed_amount="300",
           paid_amount="0", payer_id="south", provider_npi="1555000222"),
    _claim(1, claim_status="APPROVED"),
    _claim(3, member_id=None, claim_status="pending"),
    _claim(4, billed_amount="-80", allowed_amount="-70", paid_amount="-20", claim_status="adjusted"),
]
AS_OF = "2025-12-31"

SILVER_DDL = (
    "claim_id string, member_id string, provider_npi string, service_date date, "
    "billed_amount double, allowed_amount double, paid_amount double, claim_status string, "
    "payer_id string, icd10_code string, cpt_code string, line_of_business string, "
    "network_flag string, service_year int, service_month int, silver_updated_at date"
)
_LOAD = date(2025, 5, 2)
SILVER = [
    ("S-1", "PA", "DOC0000001", date(2025, 4, 3), 1600.0, 1500.0, 1200.0, "APPROVED", "NORTH", "K21.0", "a", "RETAIL", "IN", 2025, 4, _LOAD),
    ("S-2", "PB", "DOC0000001", date(2025, 4, 9), 400.0, 300.0, 0.0, "DENIED", "NORTH", "M54.5", "b", "RETAIL", "IN", 2025, 4, _LOAD),
    ("S-3", "PA", "DOC0000002", date(2025, 4, 20), 900.0, 800.0, 700.0, "APPROVED", "SOUTH", "Z01.0", "a", "RETAIL", "OUT", 2025, 4, _LOAD),
]
