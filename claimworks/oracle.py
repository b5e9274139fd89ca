"""The registered queries in DuckDB SQL, written apart from the operators and over whole tables.

Texts are put together from common table expressions: raw claims, their newest copies, typed
claims, checked claims, and the aggregate tables.
"""

from __future__ import annotations

AS_OF = "DATE '2024-12-15'"
FIRST, SECOND = "DATE '1998-06-01'", "DATE '2001-12-01'"


def rnd(x: str, digits: int = 2) -> str:
    """Half-up rounding of the shortest decimal text of a double, as Spark rounds doubles."""
    return f"round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15)), {digits})::DOUBLE"


def total(x: str) -> str:
    return f"CAST(CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE)"


def big(x: str) -> str:
    """As ``total`` where amounts from 1e18 on are added up by themselves."""
    def part(test: str) -> str:
        return (f"coalesce(CAST(CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10))) FILTER (abs({x}) {test}) AS VARCHAR) "
                f"AS DOUBLE), 0::DOUBLE)")
    return f"(CASE WHEN count({x}) > 0 THEN {part('< 1e18')} + {part('>= 1e18')} END)"


def big_mean(x: str) -> str:
    return f"({big(x)} / nullif(count({x}), 0)::DOUBLE)"


def mean(x: str) -> str:
    return f"(CAST(CAST(sum({x}::DECIMAL(28,10)) AS VARCHAR) AS DOUBLE) / count({x}))"


def rate(part: str, whole: str, digits: int = 2) -> str:
    return rnd(f"({part})::DOUBLE / nullif(({whole})::DOUBLE, 0) * 100.0", digits)


def share(part: str, whole: str) -> str:
    return rnd(f"({part})::DOUBLE * 100.0 / nullif(({whole})::DOUBLE, 0)")


def text(x: str) -> str:
    return f"(({x}) // 100)::VARCHAR || '.' || lpad((({x}) % 100)::VARCHAR, 2, '0')"


RAW = f"""raw AS (
  SELECT
    CASE WHEN l_orderkey % 997 <> 0 THEN 'CLM' || lpad(l_orderkey::VARCHAR, 8, '0') || '-' || l_linenumber END AS claim_id,
    CASE WHEN o_custkey % 97 <> 0 THEN ' MBR' || lpad(o_custkey::VARCHAR, 7, '0') END AS member_id,
    (CASE WHEN l_suppkey % 50 = 7 THEN NULL
          WHEN l_suppkey % 10 = 3 THEN l_suppkey + 12345
          WHEN l_suppkey % 50 = 9 THEN l_suppkey + 10000000000
          ELSE l_suppkey + 1000000000 END)::VARCHAR AS provider_npi,
    CASE WHEN l_orderkey % 211 = 0 THEN 'not-a-date'
         WHEN l_orderkey % 4 = 0 THEN strftime(d, '%Y-%m-%d')
         WHEN l_orderkey % 4 = 1 THEN strftime(d, '%m/%d/%Y')
         WHEN l_orderkey % 4 = 2 THEN month(d) || '/' || day(d) || '/' || year(d)
         ELSE strftime(d, '%Y%m%d') END AS service_date,
    lower(p_brand) || ' ' AS icd10_code,
    p_type AS cpt_code,
    CASE WHEN l_partkey % 83 = 0 THEN '-' ELSE '$' END || {text('cents')} AS billed_amount,
    {text('acents')} AS allowed_amount,
    CASE WHEN l_partkey % 83 = 0 THEN '-' ELSE '' END
      || {text("acents + CASE WHEN l_partkey % 89 = 0 THEN cents ELSE 0 END")} AS paid_amount,
    CASE WHEN l_partkey % 101 = 0 THEN 'UNKNOWN'
         WHEN l_partkey % 103 = 0 THEN NULL
         WHEN l_partkey % 20 <= 1 THEN 'denied'
         WHEN l_partkey % 20 <= 3 THEN ' PENDING'
         WHEN l_partkey % 20 = 4 THEN 'Adjusted'
         WHEN l_partkey % 20 = 5 THEN 'voided'
         ELSE 'approved ' END AS claim_status,
    'pyr00' || n_regionkey AS payer_id,
    lower(c_mktsegment) AS line_of_business,
    CASE WHEN l_returnflag = 'R' THEN 'out' ELSE 'in ' END AS network_flag,
    l_shipdate AS ingestion_ts,
    date_trunc('month', l_shipdate)::DATE AS ingestion_date,
    l_partkey, l_suppkey
  FROM (SELECT *,
          floor(round(l_extendedprice * 100) / 20)::BIGINT AS cents,
          floor(round(l_extendedprice * 100) * (1 - l_discount) / 20)::BIGINT AS acents,
          DATE '2024-01-01' + (date_diff('day', DATE '1995-01-01', l_shipdate::DATE) % 366)::INT AS d
        FROM lineitem) l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

RAW_NAMES = ("claim_id, member_id, provider_npi, service_date, icd10_code, cpt_code, billed_amount, "
             "allowed_amount, paid_amount, claim_status, payer_id, line_of_business, network_flag")


def money(c: str) -> str:
    return f"TRY_CAST(regexp_replace({c}, '[$,\\s]', '', 'g') AS DOUBLE)"


def day(c: str) -> str:
    return (f"coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%m/%d/%Y'), "
            f"try_strptime({c}, '%Y%m%d'))::DATE")


def newest(source: str = "raw", name: str = "newest", null_keys: str = "keep", where: str = "true") -> str:
    keep = " OR claim_id IS NULL" if null_keys == "keep" else ""
    return f"""{name} AS (
  SELECT * FROM {source} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY claim_id
    ORDER BY ingestion_ts DESC, l_partkey DESC, l_suppkey DESC) = 1{keep}
)"""


def typed(source: str = "newest", name: str = "typed") -> str:
    return f"""{name} AS (
  SELECT *, round_rate AS payment_rate_pct,
    {rnd('billed_amount - paid_amount')} AS adjustment_amount,
    year(service_date)::INT AS service_year, month(service_date)::INT AS service_month,
    strftime(service_date, '%Y-%m') AS service_ym
  FROM (SELECT *, {rate('paid_amount', 'billed_amount')} AS round_rate FROM (
    SELECT claim_id, trim(member_id) AS member_id,
      CASE WHEN length(trim(provider_npi)) > 10 THEN left(trim(provider_npi), 10)
           ELSE lpad(trim(provider_npi), 10, '0') END AS provider_npi,
      coalesce(length(trim(provider_npi)), 0)::INT AS npi_text_length,
      {day('service_date')} AS service_date,
      upper(trim(icd10_code)) AS icd10_code, trim(cpt_code) AS cpt_code,
      {money('billed_amount')} AS billed_amount, {money('allowed_amount')} AS allowed_amount,
      {money('paid_amount')} AS paid_amount,
      upper(trim(claim_status)) AS claim_status, upper(trim(payer_id)) AS payer_id,
      upper(trim(line_of_business)) AS line_of_business, upper(trim(network_flag)) AS network_flag,
      ingestion_ts, ingestion_date
    FROM {source}))
)"""


STATUS_LIST = "('APPROVED', 'DENIED', 'PENDING', 'ADJUSTED', 'VOIDED')"
RULES = {
    "NULL_CLAIM_ID": "claim_id IS NULL",
    "NULL_MEMBER_ID": "member_id IS NULL",
    "INVALID_STATUS": f"(claim_status IS NULL OR claim_status NOT IN {STATUS_LIST})",
    "NEGATIVE_AMOUNT": "(billed_amount < 0 OR paid_amount < 0)",
    "FUTURE_DATE": f"service_date > {AS_OF}",
    "NULL_SERVICE_DATE": "service_date IS NULL",
    "PAID_EXCEEDS_BILLED": "paid_amount > billed_amount",
    "INVALID_NPI_LENGTH": "NOT (npi_text_length BETWEEN 1 AND 10)",
}
THREE_VALUED = {**RULES, "INVALID_STATUS": f"claim_status NOT IN {STATUS_LIST}",
                "INVALID_NPI_LENGTH": "length(provider_npi) <> 10"}


def checked(source: str = "typed", name: str = "checked") -> str:
    flags = ", ".join(f"CASE WHEN {test} THEN '{rule}' END" for rule, test in RULES.items())
    return f"""{name} AS (
  SELECT *, len(flags) = 0 AS is_valid, CAST(to_json(flags) AS VARCHAR) AS dq_flags
  FROM (SELECT *, list_filter([{flags}], lambda x: x IS NOT NULL) AS flags FROM {source})
)"""


_FLAGS3 = ", ".join(f"CASE WHEN {test} THEN '{rule}' END" for rule, test in THREE_VALUED.items())
_SUM3 = " + ".join(f"({test})::INT" for test in THREE_VALUED.values())
CHECKED3 = f"""checked AS (
  SELECT *, ({_SUM3}) = 0 AS is_valid,
    CAST(to_json(list_filter([{_FLAGS3}], lambda x: x IS NOT NULL)) AS VARCHAR) AS dq_flags
  FROM typed
)"""

VALID = "valid AS (SELECT * FROM checked WHERE is_valid)"
TO_CHECKED = ", ".join([RAW, newest(), typed(), checked()])
TO_VALID = f"{TO_CHECKED}, {VALID}"
TO_CHECKED3 = ", ".join([RAW, newest(null_keys="collapse"), typed(), CHECKED3])

DENIED = "count(*) FILTER (WHERE claim_status = 'DENIED')"
MEAN_PAID = f"{total('paid_amount')} / nullif(count(paid_amount), 0)::DOUBLE"


def kpi(report_date: str = AS_OF, name: str = "kpi") -> str:
    return f"""{name} AS (
  SELECT {report_date} AS report_date, payer_id, claim_status, line_of_business, network_flag,
    count(claim_id) AS claim_count, count(DISTINCT member_id) AS unique_members,
    count(DISTINCT provider_npi) AS unique_providers,
    {total('billed_amount')} AS total_billed, {total('allowed_amount')} AS total_allowed,
    {total('paid_amount')} AS total_paid, {MEAN_PAID} AS avg_paid_per_claim,
    quantile_disc(paid_amount, 0.5) AS median_paid, quantile_disc(paid_amount, 0.95) AS p95_paid,
    {DENIED} AS denied_count,
    {rate(DENIED, 'count(claim_id)')} AS denial_rate_pct,
    {rate(total('paid_amount'), total('billed_amount'))} AS payment_rate_pct
  FROM valid GROUP BY ALL
)"""


SCORECARD = f"""scorecard AS (
  SELECT *, CASE WHEN denial_rate_pct < 5 THEN 'PREFERRED' WHEN denial_rate_pct < 15 THEN 'STANDARD'
            ELSE 'REVIEW' END AS provider_tier
  FROM (
    SELECT provider_npi, service_year, service_month, payer_id,
      count(claim_id) AS total_claims, count(DISTINCT member_id) AS patients_served,
      {total('billed_amount')} AS total_billed, {total('paid_amount')} AS total_paid,
      {MEAN_PAID} AS avg_claim_value, {rate(DENIED, 'count(claim_id)')} AS denial_rate_pct,
      count(DISTINCT icd10_code) AS unique_diagnoses, count(DISTINCT cpt_code) AS unique_procedures,
      array_to_string(list_sort(list(DISTINCT icd10_code) FILTER (icd10_code IS NOT NULL)), ',') AS icd10_codes_used,
      {rate(total('paid_amount'), total('billed_amount'), 1)} AS cost_efficiency_score
    FROM valid GROUP BY ALL)
)"""

MEMBERS = f"""members AS (
  SELECT *, (last_service_date - first_service_date)::INT AS days_as_patient,
    {rnd('lifetime_paid / nullif(lifetime_claims, 0)')} AS avg_cost_per_episode,
    CASE WHEN lifetime_claims > 50 OR lifetime_paid > 100000 THEN 'HIGH'
         WHEN lifetime_claims > 20 OR lifetime_paid > 30000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
  FROM (
    SELECT member_id, payer_id, line_of_business, count(claim_id) AS lifetime_claims,
      {total('billed_amount')} AS lifetime_billed, {total('paid_amount')} AS lifetime_paid,
      min(service_date) AS first_service_date, max(service_date) AS last_service_date,
      count(DISTINCT provider_npi) AS unique_providers_seen,
      count(DISTINCT icd10_code) AS unique_diagnoses, {DENIED} AS denied_claims,
      array_to_string(list_sort(list(DISTINCT network_flag) FILTER (network_flag IS NOT NULL)), ',') AS network_usage
    FROM valid GROUP BY ALL)
)"""


def trending(code: str = "icd10_code", calendar: bool = False) -> str:
    index = "service_year * 12 + service_month"
    before = "lag(claim_count) OVER w"
    if calendar:
        before = f"CASE WHEN lag({index}) OVER w = {index} - 1 THEN {before} END"
    return f"""trending AS (
  SELECT *, {rate('claim_count - prev_month_claims', 'prev_month_claims')} AS mom_claim_growth_pct
  FROM (
    SELECT *, {rnd('total_paid / nullif(patients_affected, 0)')} AS cost_per_patient,
      {before} AS prev_month_claims
    FROM (
      SELECT {code} AS icd10_code, service_year, service_month, payer_id,
        count(claim_id) AS claim_count, count(DISTINCT member_id) AS patients_affected,
        {total('paid_amount')} AS total_paid, {MEAN_PAID} AS avg_cost_per_episode,
        {DENIED} AS denied_count
      FROM valid GROUP BY ALL)
    WINDOW w AS (PARTITION BY icd10_code, payer_id ORDER BY service_year, service_month))
)"""


EVENTS = """parsed AS (
  SELECT *, CASE WHEN ok THEN 'CLM' || user_id END AS claim_id,
    CASE WHEN ok THEN 'MBR' || user_id % 97 END AS member_id,
    CASE WHEN ok THEN lpad((user_id + 12345)::VARCHAR, 10, '0') END AS provider_npi,
    CASE WHEN ok THEN ts::DATE END AS service_date,
    CASE WHEN ok THEN value * 2 END AS billed_amount,
    CASE WHEN ok THEN value END AS paid_amount,
    CASE WHEN ok THEN 'APPROVED' END AS claim_status,
    CASE WHEN ok THEN 'PYR' || user_id % 5 END AS payer_id,
    CASE WHEN ok THEN CASE event_type WHEN 'signup' THEN 'SUBMIT' WHEN 'purchase' THEN 'ADJUDICATE'
                      ELSE 'UPDATE' END END AS kind,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
    (event_id % 4)::VARCHAR AS partition_id, event_id::VARCHAR AS eh_offset
  FROM (SELECT *, event_type <> 'error' AS ok FROM events)
)"""
EVENT_NAMES = ("claim_id, member_id, provider_npi, service_date, billed_amount, paid_amount, "
               "claim_status, payer_id, kind AS event_type, event_time, partition_id, eh_offset")
ALL_EVENTS = f"WITH {EVENTS} SELECT {EVENT_NAMES} FROM parsed"
LATEST_EVENTS = f"""WITH {EVENTS} SELECT {EVENT_NAMES} FROM parsed WHERE claim_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY ts DESC, event_id DESC) = 1"""

#: Raw claims and events as text, with what puts copies of a claim in order.


def both(name: str = "mixed", raw: str = "true", events: str = "true", hour: str = "03") -> str:
    return BOTH.replace("mixed AS", f"{name} AS").replace("FROM raw UNION", f"FROM raw WHERE {raw} UNION").replace(
        "WHERE true)", f"WHERE {events})").replace("12-15 03:", f"12-15 {hour}:")


BOTH = """mixed AS (
  SELECT * FROM raw UNION ALL BY NAME
  SELECT CASE WHEN ok THEN CASE WHEN user_id % 3 = 0 THEN 'CLM' || lpad(user_id::VARCHAR, 8, '0') || '-1'
                           ELSE 'CLM' || user_id END END AS claim_id,
    CASE WHEN ok THEN 'MBR' || user_id % 97 END AS member_id,
    CASE WHEN ok THEN CASE user_id % 10 WHEN 3 THEN (user_id + 10000000000)::VARCHAR WHEN 5 THEN '  '
                      ELSE (user_id + 12345)::VARCHAR END END AS provider_npi,
    CASE WHEN ok THEN strftime(ts, '%Y-%m-%d') END AS service_date,
    CASE WHEN ok THEN (value * 2)::VARCHAR END AS billed_amount, CASE WHEN ok THEN value::VARCHAR END AS paid_amount,
    CASE WHEN ok THEN 'APPROVED' END AS claim_status, CASE WHEN ok THEN 'PYR' || user_id % 5 END AS payer_id,
    TIMESTAMP '2024-12-15 03:00:00' AS ingestion_ts, epoch_us(ts) AS l_partkey, event_id AS l_suppkey
  FROM (SELECT *, event_type <> 'error' AS ok FROM events WHERE true)
)"""
SILVER_NAMES = ("claim_id, member_id, provider_npi, service_date, icd10_code, cpt_code, "
                "billed_amount, allowed_amount, paid_amount, claim_status, payer_id, "
                "line_of_business, network_flag, payment_rate_pct, adjustment_amount, service_year, "
                "service_month, service_ym, is_valid, dq_flags")


#: Valid claims of both loads; of a claim in both, the row of the second load. When the loads come
#: in the wrong order the second one is in the table already, and the rows are the same.
TWO_LOADS = f"""WITH {RAW},
{newest(name="newest_a", where=f"ingestion_date <= {FIRST}")}, {typed("newest_a", "typed_a")}, {checked("typed_a", "checked_a")},
{newest(name="newest_b", where=f"ingestion_date > {FIRST}")}, {typed("newest_b", "typed_b")}, {checked("typed_b", "checked_b")}
SELECT {SILVER_NAMES}, {SECOND} AS silver_batch_date FROM checked_b WHERE is_valid
UNION ALL
SELECT {SILVER_NAMES}, {FIRST} FROM checked_a a WHERE is_valid
  AND NOT EXISTS (SELECT 1 FROM checked_b b WHERE b.is_valid AND b.claim_id = a.claim_id)"""


EXTREME = "extreme AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN payer_id = 'PYR001' THEN floor({c}) * 1e16::DOUBLE ELSE {c} + 0.000004::DOUBLE END AS {c}"
    for c in ("billed_amount", "allowed_amount", "paid_amount")) + ") FROM valid)"

#: The raw claims with a sound value for each field that breaks a rule.
REPAIRED = f"""{RAW.replace("raw AS (", "dirty AS (", 1)},
raw AS (SELECT * REPLACE (
    coalesce(claim_id, 'NEW' || l_partkey || '-' || l_suppkey) AS claim_id, coalesce(member_id, 'MBR-NEW') AS member_id,
    coalesce(left(provider_npi, 10), '1000000000') AS provider_npi,
    CASE WHEN service_date = 'not-a-date' THEN '2024-02-29' ELSE service_date END AS service_date,
    CASE WHEN upper(trim(claim_status)) IN {STATUS_LIST} THEN claim_status ELSE 'approved' END AS claim_status,
    replace(billed_amount, '-', '') AS billed_amount,
    CASE WHEN l_partkey % 89 = 0 THEN '0.00' ELSE replace(paid_amount, '-', '') END AS paid_amount) FROM dirty)"""

# The load nothing is dropped from, and the measures of both kinds of load.
ALL_LOADED = ", ".join([RAW, typed("raw", "all_typed"), checked("all_typed", "loaded")])
_DISTINCT_RAW = "count(DISTINCT claim_id) + count(*) FILTER (WHERE claim_id IS NULL)"


def _verdict(loaded: bool) -> str:
    silver = "valid" if loaded else "loaded"
    seen = "(SELECT count(*) FROM checked)" if loaded else "(SELECT count(*) FROM loaded)"
    judged = "distinct_coverage_pct" if loaded else "silver_coverage_pct"
    return f"""WITH {TO_VALID}, {typed("raw", "all_typed")}, {checked("all_typed", "loaded")},
m AS (
  SELECT (SELECT count(*) FROM raw) AS bronze_count,
    (SELECT {_DISTINCT_RAW} FROM raw) AS bronze_distinct,
    (SELECT count(*) FROM {silver}) AS silver_count,
    (SELECT count(*) FROM {silver} WHERE is_valid) AS valid_count,
    {seen} AS seen,
    (SELECT count(*) FROM {silver} WHERE service_date > {AS_OF}) AS future_dates_count,
    (SELECT count(*) - count(DISTINCT claim_id) FROM {silver}) AS duplicate_claim_ids,
    (SELECT count(*) FROM {silver} s WHERE NOT EXISTS
       (SELECT 1 FROM valid v WHERE v.provider_npi = s.provider_npi)) AS orphan_provider_records
),
p AS (
  SELECT *, {rate('silver_count', 'greatest(bronze_count, 1)')} AS silver_coverage_pct,
    {rate('silver_count', 'greatest(bronze_distinct, 1)')} AS distinct_coverage_pct,
    coalesce({rate('valid_count', 'seen')}, 0.0) AS validity_pct
  FROM m
),
verdict AS (
  SELECT silver_coverage_pct, distinct_coverage_pct, validity_pct, future_dates_count,
    duplicate_claim_ids, orphan_provider_records,
    list_filter([
      CASE WHEN validity_pct < 95 THEN 'VALIDITY_BELOW_95: ' || validity_pct || '%' END,
      CASE WHEN future_dates_count > 0 THEN 'FUTURE_DATES: ' || future_dates_count END,
      CASE WHEN duplicate_claim_ids > 0 THEN 'DUPLICATES: ' || duplicate_claim_ids END,
      CASE WHEN {judged} < 90 THEN 'LOW_COVERAGE: ' || {judged} || '%' END
    ], lambda x: x IS NOT NULL) AS broken
  FROM p
)"""


_VERDICT_COLUMNS = """silver_coverage_pct, distinct_coverage_pct, validity_pct, future_dates_count,
  duplicate_claim_ids, orphan_provider_records, CAST(to_json(broken) AS VARCHAR) AS sla_violations,
  CASE WHEN len(broken) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status"""
_AUDIT_COLUMNS = """CASE WHEN len(broken) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status,
  validity_pct, {} AS silver_coverage_pct, future_dates_count, duplicate_claim_ids AS duplicate_count,
  CAST(to_json(broken) AS VARCHAR) AS sla_violations"""

_SHORT = "(claim_status IS NOT DISTINCT FROM 'voided' AND network_flag = 'out')"
_LONG = "(claim_status IS NOT DISTINCT FROM 'Adjusted' AND network_flag = 'out')"
_KPI_BY_PAYER = "payer_id, claim_status, line_of_business, network_flag, claim_count"
_SILVER_PART = "claim_id, payer_id, service_date, claim_status, member_id, paid_amount, service_year, service_month"
_TRENDING = "icd10_code, service_year, service_month, payer_id, claim_count, patients_affected, total_paid, " \
            "avg_cost_per_episode, denied_count, cost_per_patient, prev_month_claims, mom_claim_growth_pct"
_BRONZE_NAMES = f"{RAW_NAMES}, ingestion_date, 'batch_' || strftime(ingestion_date, '%Y%m%d') AS batch_id, false AS is_corrupt"

ORACLE: dict[str, str] = {
    "parse_dates": f"WITH {RAW} SELECT service_date AS service_date_text, {day('service_date')} AS service_date FROM raw",
    "parse_amounts": f"""WITH {RAW} SELECT billed_amount AS billed_amount_text, allowed_amount AS allowed_amount_text,
      paid_amount AS paid_amount_text, {money('billed_amount')} AS billed_amount,
      {money('allowed_amount')} AS allowed_amount, {money('paid_amount')} AS paid_amount FROM raw""",
    "normalise_codes": f"""WITH {RAW} SELECT upper(trim(claim_status)) AS claim_status, upper(trim(icd10_code)) AS icd10_code,
      trim(cpt_code) AS cpt_code, upper(trim(payer_id)) AS payer_id, upper(trim(line_of_business)) AS line_of_business,
      upper(trim(network_flag)) AS network_flag, trim(member_id) AS member_id FROM raw""",
    "pad_npi": f"""WITH {RAW}, {typed("raw")} SELECT r.provider_npi AS npi_text,
      CASE WHEN length(trim(r.provider_npi)) > 10 THEN left(trim(r.provider_npi), 10)
           ELSE lpad(trim(r.provider_npi), 10, '0') END AS provider_npi,
      length(trim(r.provider_npi))::INT AS npi_text_length FROM raw r""",
    "derived_amounts": f"""WITH {RAW}, {typed("raw")} SELECT claim_id, billed_amount, paid_amount, payment_rate_pct,
      adjustment_amount, service_year, service_month, service_ym FROM typed""",
    "bronze_provenance": f"WITH {RAW} SELECT {_BRONZE_NAMES} FROM raw",
    "incremental_batch": f"WITH {RAW} SELECT {RAW_NAMES}, ingestion_date FROM raw WHERE ingestion_date = {FIRST}",
    "bronze_union": f"""WITH {RAW}, {typed("raw")}, {EVENTS}
      SELECT from_batch, claim_status, payer_id, count(*) AS n, {total('paid_amount')} AS paid FROM (
        SELECT true AS from_batch, claim_status, payer_id, paid_amount FROM typed
        UNION ALL SELECT false, claim_status, payer_id, paid_amount FROM parsed)
      GROUP BY ALL""",
    "dedup_latest": f"WITH {RAW}, {newest()} SELECT {RAW_NAMES} FROM newest",
    "dedup_null_collapsed": f"WITH {RAW}, {newest(null_keys='collapse')} SELECT {RAW_NAMES} FROM newest",
    "dedup_removed_count": f"""WITH {RAW}, {newest()} SELECT a AS rows_before, b AS rows_after, a - b AS rows_removed
      FROM (SELECT (SELECT count(*) FROM raw) AS a, (SELECT count(*) FROM newest) AS b)""",
    "rule_counts": f"WITH {RAW}, {newest()}, {typed()} " + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {test}) AS broken_rows FROM typed" for rule, test in RULES.items()),
    "rule_flags_json": f"WITH {TO_CHECKED} SELECT claim_id, member_id, is_valid, dq_flags FROM checked",
    "rule_flags_three_valued": f"WITH {TO_CHECKED3} SELECT is_valid, dq_flags, count(*) AS n FROM checked GROUP BY ALL",
    "validity_rate": f"""WITH {TO_CHECKED}, v AS (SELECT count(*) AS total, count(*) FILTER (WHERE is_valid) AS valid FROM checked)
      SELECT total, valid, total - valid AS invalid, {rate('valid', 'total')} AS validity_pct,
        CASE WHEN {rate('valid', 'total')} < 95 THEN 'DQ_WARNING' ELSE 'SUCCESS' END AS status FROM v""",
    "quarantine_rows": f"""WITH {TO_CHECKED} SELECT claim_id, member_id, provider_npi, service_date, billed_amount,
      paid_amount, claim_status, dq_flags AS quarantine_reason FROM checked WHERE NOT is_valid""",
    "lost_rows_reference_policy": f"WITH {TO_CHECKED3} SELECT claim_id, service_date, claim_status, provider_npi FROM checked WHERE is_valid IS NULL",
    "silver_claims": f"WITH {TO_VALID} SELECT {SILVER_NAMES}, {AS_OF} AS silver_batch_date FROM valid",
    "gold_daily_kpi": f"WITH {TO_VALID}, {kpi()} SELECT * FROM kpi",
    "gold_kpi_by_service_date": f"WITH {TO_VALID}, {kpi('service_date')} SELECT * FROM kpi",
    "gold_provider_scorecard": f"WITH {TO_VALID}, {SCORECARD} SELECT * FROM scorecard",
    "gold_member_360": f"WITH {TO_VALID}, {MEMBERS} SELECT * FROM members",
    "gold_diagnosis_trending": f"WITH {TO_VALID}, {trending()} SELECT {_TRENDING} FROM trending",
    "mom_calendar": f"WITH {TO_VALID}, {trending(chr(39).join(['icd10_code || ', '/', ' || provider_npi']), True)} SELECT {_TRENDING} FROM trending",
    "view_exec_dashboard": f"""WITH {TO_VALID}, {kpi('service_date')}
      SELECT report_date, payer_id, line_of_business, sum(claim_count)::BIGINT AS total_claims,
        sum(unique_members)::BIGINT AS unique_members, {total('total_billed')} AS total_billed, {total('total_paid')} AS total_paid,
        {share(total('total_paid'), total('total_billed'))} AS overall_payment_rate_pct,
        sum(denied_count)::BIGINT AS total_denied,
        {share('sum(denied_count)', 'sum(claim_count)')} AS overall_denial_rate_pct,
        {mean('avg_paid_per_claim')} AS avg_paid_per_claim
      FROM kpi GROUP BY ALL""",
    "view_exec_exact_members": f"""WITH {TO_VALID} SELECT service_date AS report_date, payer_id, line_of_business,
      count(claim_id) AS total_claims, count(DISTINCT member_id) AS unique_members_exact,
      {total('paid_amount')} / count(paid_amount) AS avg_paid_per_claim_exact FROM valid GROUP BY ALL""",
    "view_exec_sketched": f"""WITH {TO_VALID} SELECT service_date AS report_date, payer_id, line_of_business, count(claim_id) AS total_claims,
      count(DISTINCT member_id) AS unique_members, count(DISTINCT provider_npi) AS unique_providers,
      true AS members_close, true AS providers_close, true AS median_close FROM valid GROUP BY ALL""",
    "cluster_interleaved": f"WITH {TO_VALID} SELECT {_SILVER_PART} FROM valid",
    "row_access_by_role": f"""WITH {TO_VALID}, {kpi()} SELECT 'payer' AS role, {_KPI_BY_PAYER} FROM kpi WHERE payer_id = 'PYR002'
      UNION ALL SELECT 'admin', {_KPI_BY_PAYER} FROM kpi""",
    "view_provider_tier": f"""WITH {TO_VALID}, {SCORECARD}
      SELECT provider_npi, service_year, max(provider_tier) AS current_tier, sum(total_claims)::BIGINT AS ytd_claims,
        sum(patients_served)::BIGINT AS ytd_patients, {total('total_paid')} AS ytd_paid,
        {mean('denial_rate_pct')} AS avg_denial_rate_pct, {mean('cost_efficiency_score')} AS avg_cost_efficiency,
        count(DISTINCT payer_id) AS payer_count
      FROM scorecard GROUP BY ALL""",
    "provider_latest_tier": f"""WITH {TO_VALID}, {SCORECARD}
      SELECT provider_npi, service_year, service_month AS latest_month, provider_tier AS latest_tier FROM scorecard
      QUALIFY row_number() OVER (PARTITION BY provider_npi, service_year ORDER BY service_month DESC, provider_tier DESC) = 1""",
    "view_high_risk_members": f"""WITH {TO_VALID}, {MEMBERS}
      SELECT member_id, payer_id, line_of_business, risk_tier, lifetime_claims, lifetime_paid, lifetime_billed,
        {share('lifetime_paid', 'lifetime_billed')} AS lifetime_payment_rate, unique_providers_seen, unique_diagnoses,
        denied_claims, {share('denied_claims', 'lifetime_claims')} AS member_denial_rate, first_service_date,
        last_service_date, days_as_patient, avg_cost_per_episode
      FROM members WHERE risk_tier IN ('HIGH', 'MEDIUM') AND lifetime_claims > 5""",
    "view_top50_diagnoses": f"""WITH {TO_VALID}, {trending()}
      SELECT icd10_code, payer_id, service_year, service_month, claim_count, patients_affected, total_paid, cost_per_patient,
        mom_claim_growth_pct, row_number() OVER (PARTITION BY service_year, service_month
          ORDER BY claim_count DESC, icd10_code, payer_id)::INT AS rank_by_volume
      FROM trending QUALIFY rank_by_volume <= 50""",
    "upsert_claims": TWO_LOADS,
    "upsert_claims_indexed": TWO_LOADS,
    "upsert_claims_old_batch": TWO_LOADS,
    "upsert_corrected_batch": TWO_LOADS.replace("FROM checked_a a WHERE is_valid", "FROM checked_a a WHERE is_valid AND payer_id <> 'PYR003'"),
    "upsert_kpi_snapshot": f"""WITH {TO_VALID}, {kpi('service_date')}
      SELECT report_date AS snapshot_date, payer_id, sum(claim_count)::BIGINT AS total_claims, {total('total_billed')} AS total_billed,
        {total('total_paid')} AS total_paid, {mean('denial_rate_pct')} AS avg_denial_rate
      FROM kpi WHERE report_date IS NOT NULL GROUP BY ALL""",
    "upsert_kpi_all_days": f"""WITH {TO_VALID}, {kpi('service_date')}
      SELECT report_date AS snapshot_date, payer_id, sum(claim_count)::BIGINT AS total_claims, {total('total_billed')} AS total_billed,
        {total('total_paid')} AS total_paid, {mean('denial_rate_pct')} AS avg_denial_rate
      FROM kpi WHERE report_date IS NOT NULL GROUP BY ALL""",
    "append_partitioned": f"""WITH {RAW} SELECT claim_id, member_id, paid_amount, ingestion_date,
      CASE WHEN ingestion_date > {FIRST} THEN 'batch_' || strftime(ingestion_date, '%Y%m%d') END AS batch_id FROM raw""",
    "replace_batches": f"WITH {RAW} SELECT claim_id, member_id, paid_amount, ingestion_date FROM raw",
    "overwrite_refresh": f"WITH {TO_VALID}, {trending()} SELECT {_TRENDING} FROM trending",
    "compact": f"WITH {TO_VALID} SELECT {_SILVER_PART} FROM valid",
    "sized_write": f"WITH {TO_VALID} SELECT {_SILVER_PART}, true AS several_files FROM valid",
    "schema_only_clone": """SELECT c AS "column", t AS type, 0::BIGINT AS n_rows FROM (VALUES ('claim_id', 'string'),
      ('payer_id', 'string'), ('service_date', 'date'), ('claim_status', 'string'), ('member_id', 'string'),
      ('paid_amount', 'double'), ('service_year', 'int'), ('service_month', 'int')) AS v(c, t)""",
    "cluster_rewrite": f"WITH {TO_VALID} SELECT {_SILVER_PART} FROM valid",
    "check_coverage": f"""WITH {ALL_LOADED}, m AS (
        SELECT count(*) AS bronze_count, {_DISTINCT_RAW} AS bronze_distinct, count(*) FILTER (WHERE is_valid) AS silver_count FROM loaded)
      SELECT bronze_count, bronze_distinct, silver_count, {rate('silver_count', 'bronze_count')} AS silver_coverage_pct,
        {rate('silver_count', 'bronze_distinct')} AS distinct_coverage_pct FROM m""",
    "check_validity": f"""WITH {ALL_LOADED} SELECT count(*) AS silver_count, count(*) FILTER (WHERE is_valid) AS valid_count,
      {rate('count(*) FILTER (WHERE is_valid)', 'count(*)')} AS validity_pct FROM loaded""",
    "check_future": f"""WITH {ALL_LOADED} SELECT count(*) AS silver_count,
      count(*) FILTER (WHERE service_date > {AS_OF}) AS future_dates_count FROM loaded""",
    "check_duplicates": f"WITH {ALL_LOADED} SELECT count(*) AS silver_count, count(*) - count(DISTINCT claim_id) AS duplicate_claim_ids FROM loaded",
    "check_orphans": f"""WITH {TO_VALID}, {typed("raw", "all_typed")}
      SELECT count(*) AS orphan_provider_records FROM all_typed s
      WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.provider_npi = s.provider_npi)""",
    "check_verdict": f"{_verdict(False)} SELECT {_VERDICT_COLUMNS} FROM verdict",
    "check_verdict_silver": f"{_verdict(True)} SELECT {_VERDICT_COLUMNS} FROM verdict",
    "check_rows": f"""{_verdict(False)}
      SELECT 'coverage' AS "check", silver_coverage_pct AS value, silver_coverage_pct >= 90 AS passed FROM verdict
      UNION ALL SELECT 'validity', validity_pct, validity_pct >= 95 FROM verdict
      UNION ALL SELECT 'future_dates', future_dates_count::DOUBLE, future_dates_count = 0 FROM verdict
      UNION ALL SELECT 'duplicates', duplicate_claim_ids::DOUBLE, duplicate_claim_ids = 0 FROM verdict
      UNION ALL SELECT 'orphan_providers', orphan_provider_records::DOUBLE, orphan_provider_records = 0 FROM verdict""",
    "check_gold_freshness": f"""SELECT * FROM (@ROWS@) UNION ALL
      SELECT * FROM (VALUES ('freshness_gold_daily_claims_kpi', 30.0::DOUBLE, true), ('freshness_gold_provider_scorecard', 120.0, true),
        ('freshness_gold_member_360', 1440.0, true), ('freshness_gold_diagnosis_trending', 0.0, true))""",
    "check_freshness": f"""SELECT event_type AS table_name,
        {rnd("(epoch_us(TIMESTAMP '2024-12-15 06:00:00') - epoch_us(max(ts)))::DOUBLE / 60000000.0", 1)} AS age_minutes
      FROM events GROUP BY 1
      UNION ALL SELECT 'empty', 9999.0 UNION ALL SELECT 'missing', -1.0""",
    "audit_log": f"""SELECT '1998-06-01' AS batch_date, * FROM ({_verdict(False)} SELECT {_AUDIT_COLUMNS.format('silver_coverage_pct')} FROM verdict)
      UNION ALL SELECT '2001-12-01', * FROM ({_verdict(True)} SELECT {_AUDIT_COLUMNS.format('distinct_coverage_pct')} FROM verdict)""",
    "restrict_payer": f"WITH {TO_VALID}, {kpi()} SELECT {_KPI_BY_PAYER} FROM kpi WHERE payer_id = 'PYR002'",
    "restrict_admin": f"WITH {TO_VALID}, {kpi()} SELECT {_KPI_BY_PAYER} FROM kpi",
    "mask_ids": f"""WITH {RAW} SELECT regexp_replace(regexp_replace(member_id, '[A-Z]', 'X', 'g'), '[0-9]', 'n', 'g') AS member_id,
      regexp_replace(provider_npi, '[0-9]', 'n', 'g') AS provider_npi,
      sha256('s' || member_id) AS member_id_hash, sha256('s' || provider_npi) AS provider_npi_hash FROM raw""",
    "event_parse": ALL_EVENTS,
    "event_upsert_latest": LATEST_EVENTS,
    "stream_ingest": ALL_EVENTS,
    "compact_stream_table": ALL_EVENTS,
    "stream_restart": ALL_EVENTS,
    "stream_latest_state": LATEST_EVENTS,
    "stream_state_compaction": LATEST_EVENTS,
    "stream_resent_events": ALL_EVENTS,
    "stream_dead_letters": f"""WITH {EVENTS} SELECT partition_id, eh_offset, claim_id,
      CASE WHEN NOT ok THEN '{{broken' END AS payload FROM parsed""",
    "silver_late_stream": f"""WITH {RAW},
{both("mixed_a", f"ingestion_date <= {FIRST}", "event_id % 3 = 0")}, {newest("mixed_a", "newest_a")}, {typed("newest_a", "typed_a")},
{checked("typed_a", "checked_a")}, {both("mixed_b", f"ingestion_date > {FIRST}", "event_id % 3 = 1", "02")},
{both("mixed_c", "false", "event_id % 3 = 2", "05")}, later AS (SELECT * FROM mixed_b UNION ALL BY NAME SELECT * FROM mixed_c),
{newest("later", "newest_b")}, {typed("newest_b", "typed_b")}, {checked("typed_b", "checked_b")}
SELECT {SILVER_NAMES}, {SECOND} AS silver_batch_date FROM checked_b WHERE is_valid
UNION ALL SELECT {SILVER_NAMES}, {FIRST} FROM checked_a a WHERE is_valid
  AND NOT EXISTS (SELECT 1 FROM checked_b b WHERE b.is_valid AND b.claim_id = a.claim_id)""",
    "silver_with_stream": f"""WITH {RAW}, {BOTH}, {newest("mixed")}, {typed()}, {checked()}, {VALID}
      SELECT {SILVER_NAMES}, {AS_OF} AS silver_batch_date FROM valid""",
    "gold_extreme_amounts": f"""WITH {TO_VALID}, {EXTREME}
      SELECT member_id, payer_id, line_of_business, count(claim_id) AS lifetime_claims,
        {big('billed_amount')} AS lifetime_billed, {big('paid_amount')} AS lifetime_paid FROM extreme GROUP BY ALL""",
    "view_extreme_amounts": f"""WITH {TO_VALID}, {EXTREME}, k AS (
        SELECT service_date AS report_date, payer_id, claim_status, line_of_business, network_flag, count(claim_id) AS claim_count,
          count(DISTINCT member_id) AS unique_members, {big('billed_amount')} AS total_billed, {big('paid_amount')} AS total_paid,
          {big_mean('paid_amount')} AS avg_paid_per_claim, {DENIED} AS denied_count FROM extreme GROUP BY ALL)
      SELECT report_date, payer_id, line_of_business, sum(claim_count)::BIGINT AS total_claims,
        sum(unique_members)::BIGINT AS unique_members, {big('total_billed')} AS total_billed, {big('total_paid')} AS total_paid,
        {share(big('total_paid'), big('total_billed'))} AS overall_payment_rate_pct, sum(denied_count)::BIGINT AS total_denied,
        {share('sum(denied_count)', 'sum(claim_count)')} AS overall_denial_rate_pct,
        {big_mean('avg_paid_per_claim')} AS avg_paid_per_claim
      FROM k GROUP BY ALL""",
    "view_extreme_tiers": f"""WITH {TO_VALID}, {EXTREME}, t AS (SELECT * REPLACE (
        CASE WHEN payer_id = 'PYR002' THEN 1e-9::DOUBLE ELSE billed_amount END AS billed_amount) FROM extreme), s AS (
        SELECT *, CASE WHEN denial_rate_pct < 5 THEN 'PREFERRED' WHEN denial_rate_pct < 15 THEN 'STANDARD' ELSE 'REVIEW' END AS tier
        FROM (SELECT provider_npi, service_year, service_month, payer_id, count(claim_id) AS total_claims,
            count(DISTINCT member_id) AS patients_served, {big('billed_amount')} AS billed, {big('paid_amount')} AS paid,
            {rate(DENIED, 'count(claim_id)')} AS denial_rate_pct,
            {rate(big('paid_amount'), big('billed_amount'), 1)} AS cost_efficiency_score FROM t GROUP BY ALL))
      SELECT provider_npi, service_year, max(tier) AS current_tier, sum(total_claims)::BIGINT AS ytd_claims,
        sum(patients_served)::BIGINT AS ytd_patients, {big('paid')} AS ytd_paid, {mean('denial_rate_pct')} AS avg_denial_rate_pct,
        {big_mean('cost_efficiency_score')} AS avg_cost_efficiency, count(DISTINCT payer_id) AS payer_count FROM s GROUP BY ALL""",
    "source_files": f"""WITH {RAW} SELECT batch_date AS folder, batch_date, {_SHORT} OR {_LONG} AS is_corrupt, count(*) AS n
      FROM (SELECT *, CASE WHEN ingestion_date <= {FIRST} THEN '1998-06-01' ELSE '2001-12-01' END AS batch_date FROM raw) GROUP BY ALL""",
    "run_log": f"""WITH {RAW} SELECT batch_date, count(*) AS records_ingested,
        count(*) FILTER (WHERE {_SHORT} OR {_LONG}) AS corrupt_records, 'SUCCESS' AS status
      FROM (SELECT *, CASE WHEN ingestion_date <= {FIRST} THEN '1998-06-01' ELSE '2001-12-01' END AS batch_date FROM raw)
      GROUP BY ALL""",
    "csv_roundtrip_corrupt": f"""WITH {RAW} SELECT * REPLACE (
        CASE WHEN {_SHORT} THEN NULL ELSE line_of_business END AS line_of_business,
        CASE WHEN {_SHORT} THEN NULL ELSE network_flag END AS network_flag)
      FROM (SELECT {RAW_NAMES}, {_SHORT} OR {_LONG} AS is_corrupt, 'batch_20241215' AS batch_id FROM raw)""",
}

_LOAD_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "billed_amount", "allowed_amount", "paid_amount", "service_date", "claim_status", "member_id", "provider_npi",
    "icd10_code", "cpt_code", "payer_id", "line_of_business", "network_flag"))


def _one_load(x: str, where: str) -> str:
    """One load's raw rows, newest claims and outcome, under names that end in ``x``."""
    return f"""raw_{x} AS (SELECT * FROM raw WHERE {where}), {typed(f"raw_{x}", f"typed_{x}")},
newest_{x} AS (SELECT * FROM typed_{x}
  QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY {_LOAD_ORDER}) = 1 OR claim_id IS NULL),
{checked(f"newest_{x}", f"checked_{x}")}, valid_{x} AS (SELECT * FROM checked_{x} WHERE is_valid)"""


def _summary(step: int, day: str, x: str, silver: str, snapshot: bool = False) -> str:
    """The rows of one load's stages; ``silver`` has all valid claims after it."""
    groups = {"gold_daily_claims_kpi": "payer_id, claim_status, line_of_business, network_flag",
              "gold_provider_scorecard": "provider_npi, service_year, service_month, payer_id",
              "gold_member_360": "member_id, payer_id, line_of_business",
              "gold_diagnosis_trending": "icd10_code, service_year, service_month, payer_id"}
    if snapshot and silver == "after_b":  # rows of both load days
        groups["gold_daily_claims_kpi"] += ", load_no"
    gold = ", ".join(f"(SELECT count(*) FROM (SELECT DISTINCT {g} FROM {silver})) AS {t}" for t, g in groups.items())
    figures = f"""(SELECT *, {rate('silver_count', 'greatest(bronze_count, 1)')} AS silver_coverage_pct,
        {rate('silver_count', 'greatest(bronze_distinct, 1)')} AS distinct_coverage_pct,
        {rate('valid', 'total')} AS validity_pct FROM (SELECT
        (SELECT count(*) FROM raw_{x}) AS bronze_count, (SELECT {_DISTINCT_RAW} FROM raw_{x}) AS bronze_distinct,
        (SELECT count(*) FROM valid_{x}) AS silver_count, (SELECT count(*) FROM checked_{x}) AS total,
        (SELECT count(*) FROM valid_{x}) AS valid, {gold}))"""
    low_v = "CASE WHEN validity_pct < 95 THEN 'VALIDITY_BELOW_95: ' || validity_pct || '%' END"
    low_c = "CASE WHEN distinct_coverage_pct < 90 THEN 'LOW_COVERAGE: ' || distinct_coverage_pct || '%' END"
    broken = f"CAST(to_json(list_filter([{low_v}, {low_c}], lambda y: y IS NOT NULL)) AS VARCHAR)"
    day_row = ("batch_date", f"'{day}'")
    stages = [
        ("bronze", "'SUCCESS'", [day_row, ("records_ingested", "bronze_count"), ("corrupt_records", "0")]),
        ("silver", "CASE WHEN validity_pct < 95 THEN 'DQ_WARNING' ELSE 'SUCCESS' END", [
            day_row, ("total", "total"), ("valid", "valid"), ("invalid", "total - valid"),
            ("validity_pct", "validity_pct"), ("dupes_removed", "bronze_count - total")]),
        ("gold", "'SUCCESS'", [day_row, *((t, t) for t in groups)]),
        ("checks", f"CASE WHEN {broken} = '[]' THEN 'PASS' ELSE 'FAIL' END", [
            day_row, *((c, c) for c in ("bronze_count", "bronze_distinct", "silver_count", "silver_coverage_pct",
                                        "distinct_coverage_pct", "validity_pct")),
            ("valid_count", "valid"), ("quarantined_count", "total - valid"), ("judged_coverage_pct", "distinct_coverage_pct"),
            *((c, "0") for c in ("future_dates_count", "duplicate_claim_ids", "orphan_provider_records")),
            ("sla_violations", broken)]),
        *([("snapshot", "'SUCCESS'", [day_row, ("rows_affected", f"(SELECT count(DISTINCT payer_id) FROM valid_{x})")])]
          if snapshot else [])]
    return " UNION ALL ".join(
        f"SELECT {step + i} AS step, '{stage}' AS stage, {status} AS status, '{metric}' AS metric, ({value})::VARCHAR AS value "
        f"FROM {figures}" for i, (stage, status, metrics) in enumerate(stages) for metric, value in metrics)


ORACLE["run_batch_summary"] = f"""WITH {RAW}, {_one_load("a", f"ingestion_date <= {FIRST}")},
{_one_load("b", f"ingestion_date > {FIRST}")},
after_b AS (SELECT * FROM valid_b UNION ALL
  SELECT * FROM valid_a a WHERE NOT EXISTS (SELECT 1 FROM valid_b b WHERE b.claim_id = a.claim_id))
{_summary(0, "1998-06-01", "a", "valid_a")} UNION ALL {_summary(4, "2001-12-01", "b", "after_b")}"""

_TWO_RUNS = f"""{_one_load("a", f"ingestion_date <= {FIRST}")}, {_one_load("b", f"ingestion_date > {FIRST}")},
after_b AS (SELECT *, 2 AS load_no FROM valid_b UNION ALL
  SELECT *, 1 FROM valid_a a WHERE NOT EXISTS (SELECT 1 FROM valid_b b WHERE b.claim_id = a.claim_id))"""
ORACLE["run_batch_passing"] = f"""WITH {REPAIRED}, {_TWO_RUNS} {_summary(0, "1998-06-01", "a", "valid_a", True)}
UNION ALL {_summary(5, "2001-12-01", "b", "after_b", True)}"""
ORACLE["kpi_snapshot_after_loads"] = f"WITH {REPAIRED}, {_TWO_RUNS}, " + ", ".join(
    kpi(day, f"kpi_{x}").replace("FROM valid", f"FROM valid_{x}") for x, day in (("a", FIRST), ("b", SECOND))) + f"""
  SELECT report_date AS snapshot_date, payer_id, sum(claim_count)::BIGINT AS total_claims, {total('total_billed')} AS total_billed,
    {total('total_paid')} AS total_paid, {mean('denial_rate_pct')} AS avg_denial_rate
  FROM (SELECT * FROM kpi_a UNION ALL SELECT * FROM kpi_b) GROUP BY ALL"""
_AFTER_LOADS = f"WITH {RAW}, {_TWO_RUNS}, valid AS (SELECT * FROM after_b)"
ORACLE["gold_incremental_scorecard"] = f"{_AFTER_LOADS}, {SCORECARD} SELECT * FROM scorecard"
ORACLE["gold_incremental_trending"] = f"{_AFTER_LOADS}, {trending()} SELECT {_TRENDING} FROM trending"
ORACLE["check_gold_freshness"] = ORACLE["check_gold_freshness"].replace("@ROWS@", ORACLE["check_rows"])

_RULE_COLUMNS = {
    "NULL_CLAIM_ID": "claim_id",
    "NULL_MEMBER_ID": "claim_id, member_id",
    "INVALID_STATUS": "claim_id, claim_status",
    "NEGATIVE_AMOUNT": "claim_id, billed_amount, paid_amount",
    "FUTURE_DATE": "claim_id, service_date",
    "NULL_SERVICE_DATE": "claim_id, service_date",
    "PAID_EXCEEDS_BILLED": "claim_id, billed_amount, paid_amount",
    "INVALID_NPI_LENGTH": "claim_id, provider_npi",
}
for _rule, _columns in _RULE_COLUMNS.items():
    ORACLE[f"rule_{_rule.lower()}"] = (
        f"WITH {RAW}, {newest()}, {typed()} SELECT {_columns} FROM typed WHERE {RULES[_rule]}")
