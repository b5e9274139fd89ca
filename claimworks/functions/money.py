"""Amount aggregates whose result does not depend on row order.

Sums of doubles change with the order rows arrive in, so two runs of one job differ. Amounts are
therefore summed as decimals with ten places. Amounts from 1e18 on, whose doubles are whole numbers
128 and more apart, are summed as whole decimals, and those from 1e28 on, of which no decimal holds
a sum, as doubles; the parts are added at the end. So one absurd line in a feed neither stops a load
nor gets lost.

Each part is a buffer of the aggregate, and an aggregate with several distinct counts carries all
buffers through one row per count and input row. Where all amounts are known to be cents, one long does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT, _WHOLE = "decimal(28,10)", "decimal(28,0)"
_EXACT_BELOW, _WHOLE_BELOW = 1e18, 1e28
_CENTS_BELOW = 1e8  # a long holds the sum of 92 billion such numbers
_EXACT_DOUBLE_BELOW = 1 << 53


def amount_sum(c: Column | str) -> Column:
    """Aggregate: the sum as a double, exact to ten decimals; NULL when there is no amount."""
    c = F.col(c) if isinstance(c, str) else c
    small, whole = F.abs(c) < _EXACT_BELOW, F.abs(c) < _WHOLE_BELOW
    exact = F.sum(F.when(small, c).cast(_EXACT)).cast("double")
    large = F.sum(F.when(~small & whole, c).cast(_WHOLE)).cast("double")
    huge = F.sum(F.when(~whole, c))
    some = F.coalesce(exact, large, huge).isNotNull()
    none = F.lit(0.0)
    return F.when(some, F.coalesce(exact, none) + F.coalesce(large, none) + F.coalesce(huge, none))


def beyond_cents(c: Column | str) -> Column:
    """Whether an amount is no whole number of cents, or one of a million and more."""
    c = F.col(c) if isinstance(c, str) else c
    cents = F.rint(c * F.lit(100.0))
    return c.isNotNull() & ~((F.abs(cents) < _CENTS_BELOW) & (cents / F.lit(100.0) == c))


def cents_sum(c: Column | str) -> Column:
    """Aggregate: what ``amount_sum`` gives, for amounts none of which is ``beyond_cents``."""
    c = F.col(c) if isinstance(c, str) else c
    cents = F.sum(F.rint(c * F.lit(100.0)).cast("bigint"))
    return (F.when(F.abs(cents) < _EXACT_DOUBLE_BELOW, cents.cast("double") / F.lit(100.0))
            .otherwise(F.concat(cents.cast("string"), F.lit("E-2")).cast("double")))


def amount_mean(c: Column | str) -> Column:
    """Aggregate: the mean, summed as ``amount_sum`` does; NULL when there is no amount."""
    return mean_amount(amount_sum(c), F.count(c))


def mean_amount(total: Column, count: Column) -> Column:
    return total / F.nullif(count, F.lit(0)).cast("double")


def rate_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; NULL when the whole is zero or NULL."""
    whole = whole.cast("double")
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0.0)) * F.lit(100.0), digits)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """As ``rate_pct`` but scaled before the division, as the reporting views do."""
    whole = whole.cast("double")
    return F.round(part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0.0)), digits)
