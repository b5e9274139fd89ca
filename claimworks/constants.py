"""Names, formats, word lists and limits that results must equal."""

# The raw text columns of a claim, in file order.
RAW_COLUMNS = (
    "claim_id", "member_id", "provider_npi", "service_date", "icd10_code", "cpt_code",
    "billed_amount", "allowed_amount", "paid_amount", "claim_status", "payer_id",
    "line_of_business", "network_flag",
)
AMOUNT_COLUMNS = ("billed_amount", "allowed_amount", "paid_amount")

# Accepted service-date formats, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "yyyyMMdd")

# Characters removed from amount text ("$", "," and white space).
MONEY_NOISE = "$, \t\n\x0b\f\r"

# Identifier width and the statuses a claim may have.
NPI_WIDTH = 10
STATUSES = ("APPROVED", "DENIED", "PENDING", "ADJUSTED", "VOIDED")
DENIED = "DENIED"

# Service levels of a batch, in percent.
MIN_VALIDITY_PCT = 95.0
MIN_COVERAGE_PCT = 90.0

# Provider tiers by denial rate, member tiers by claims and amount paid.
PREFERRED_BELOW_PCT = 5
STANDARD_BELOW_PCT = 15
HIGH_CLAIMS, HIGH_PAID = 50, 100_000
MEDIUM_CLAIMS, MEDIUM_PAID = 20, 30_000
RISK_VIEW_MIN_CLAIMS = 5
TOP_DIAGNOSES = 50

# Freshness of an empty table and of a table that cannot be read.
AGE_EMPTY = 9999.0
AGE_UNREADABLE = -1.0

# Table names.
BRONZE = "bronze_claims_raw"
BRONZE_STREAM = "bronze_claims_realtime"
BRONZE_LOG = "bronze_ingestion_log"
STREAM_LOG = "bronze_stream_log"
SILVER = "silver_claims"
QUARANTINE = "quarantine_invalid_claims"
DAILY_KPI = "gold_daily_claims_kpi"
SCORECARD = "gold_provider_scorecard"
MEMBER_360 = "gold_member_360"
DIAGNOSIS = "gold_diagnosis_trending"
# Fixed values end here: what a load keeps for itself.
DIAGNOSIS_MONTHLY = "gold_diagnosis_monthly"
SILVER_CHANGES = "silver_changed_months"
GOLD_LOG = "gold_refresh_log"
GOLD_TABLES = (DAILY_KPI, SCORECARD, MEMBER_360, DIAGNOSIS)
CHECK_LOG = "dq_run_log"
KPI_SNAPSHOT = "kpi_snapshot"
