"""Raw text to typed values. Bad text gives NULL, never an error, with ANSI mode on."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimworks.constants import DATE_FORMATS, MONEY_NOISE, NPI_WIDTH


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First format that fits.

    A format that does not fit costs the parser an exception per row, so each one is tried only
    on text that has its separators, and a zero-padded format is left out when the same format
    without padding, which takes the same text too, is in the list.
    """
    c = _col(c)
    return F.coalesce(*[F.when(_may_fit(c, f), F.try_to_date(c, f)) for f in _needed(formats)])


def _needed(formats: tuple[str, ...]) -> list[str]:
    kept = []
    for fmt in formats:
        unpadded = fmt.replace("MM", "M").replace("dd", "d")
        if unpadded == fmt or unpadded not in formats:
            kept.append(fmt)
    return kept


def _may_fit(c: Column, fmt: str) -> Column:
    separators = set(re.sub(r"[a-zA-Z]", "", fmt))
    if not separators:
        return c.rlike("^[0-9]+$")
    guard = F.lit(True)
    for sep in sorted(separators):
        guard = guard & c.contains(sep)
    return guard


def parse_money(c: Column | str) -> Column:
    """Amount text without currency sign, commas and white space as a double.

    Text for infinity or not-a-number is no amount and gives NULL.
    """
    value = F.translate(_col(c), MONEY_NOISE, "").try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def norm_code(c: Column | str) -> Column:
    """Trimmed, in capitals."""
    return F.upper(F.trim(_col(c)))


def pad_npi(c: Column | str) -> Column:
    """Provider identifier, zero-padded on the left; longer text is cut, so test the raw length."""
    return F.lpad(F.trim(_col(c)), NPI_WIDTH, "0")
