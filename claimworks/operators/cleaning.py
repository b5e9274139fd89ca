"""Raw text columns to typed, normalised claim columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.constants import AMOUNT_COLUMNS
from claimworks.functions import norm_code, pad_npi, parse_date, parse_money, rate_pct

#: Length of the identifier before padding; the row rules need it, tables do not.
NPI_LENGTH = "npi_text_length"

_CODES = ("claim_status", "icd10_code", "payer_id", "line_of_business", "network_flag")
_TRIMMED = ("cpt_code", "member_id")


def cleaned_columns() -> dict[str, Column]:
    """Replacement expression of each raw column; ``claim_id`` stays as it is."""
    return {
        "service_date": parse_date("service_date"),
        "provider_npi": pad_npi("provider_npi"),
        **{c: parse_money(c) for c in AMOUNT_COLUMNS},
        **{c: norm_code(c) for c in _CODES},
        **{c: F.trim(c) for c in _TRIMMED},
    }


def to_typed(df: DataFrame) -> DataFrame:
    """Raw text columns replaced by typed ones; other columns stay. One projection."""
    typed = cleaned_columns()
    length = F.coalesce(F.length(F.trim("provider_npi")), F.lit(0)).alias(NPI_LENGTH)
    return df.select(*[typed[c].alias(c) if c in typed else c for c in df.columns], length)


def add_derived(df: DataFrame) -> DataFrame:
    """Payment rate, adjustment and service year, month and year-month of typed claims; one that
    nobody reads is pruned away."""
    paid, billed, day = F.col("paid_amount"), F.col("billed_amount"), F.col("service_date")
    return df.withColumns({
        "payment_rate_pct": rate_pct(paid, billed),
        "adjustment_amount": F.round(billed - paid, 2),
        "service_year": F.year(day),
        "service_month": F.month(day),
        "service_ym": F.date_format(day, "yyyy-MM"),
    })


def clean(df: DataFrame) -> DataFrame:
    return add_derived(to_typed(df))
