"""Column expressions; every one runs inside the JVM."""

from claimworks.functions.money import (
    amount_mean, amount_sum, beyond_cents, cents_sum, mean_amount, rate_pct, share_pct,
)
from claimworks.functions.text import norm_code, pad_npi, parse_date, parse_money

__all__ = [
    "amount_mean", "amount_sum", "beyond_cents", "cents_sum", "mean_amount", "norm_code", "pad_npi", "parse_date",
    "parse_money", "rate_pct", "share_pct",
]
