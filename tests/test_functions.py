from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimworks.constants import DATE_FORMATS
from claimworks.functions import (
    amount_sum, norm_code, pad_npi, parse_date, parse_money, rate_pct, share_pct,
)


def values(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("text, day", [
    ("2025-01-10", date(2025, 1, 10)), ("01/05/2025", date(2025, 1, 5)),
    ("1/5/2025", date(2025, 1, 5)), ("20250105", date(2025, 1, 5)),
    ("2025-1-5", None), ("2025-02-30", None), ("02/29/2023", None), ("13/01/2025", None),
    ("not-a-date", None), ("", None), (None, None), (" 2025-01-10", None),
])
def test_parse_date(spark, text, day):
    assert values(spark, parse_date("s"), [text]) == [day]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789-/ ", max_size=11), min_size=40, max_size=40))
def test_parse_date_is_first_format_that_fits(spark, texts):
    plain = F.coalesce(*[F.try_to_date("s", f) for f in DATE_FORMATS])
    assert values(spark, parse_date("s"), texts) == values(spark, plain, texts)


def test_parse_money(spark):
    texts = ["$1500.00", "1,234.5", " - 7 ", "-100", "(5)", "", None, "abc", "NaN", "Infinity", "$\t3"]
    assert values(spark, parse_money("s"), texts) == [
        1500.0, 1234.5, -7.0, -100.0, None, None, None, None, None, None, 3.0]


def test_codes_and_identifiers(spark):
    assert values(spark, norm_code("s"), [" approved ", None]) == ["APPROVED", None]
    assert values(spark, pad_npi("s"), ["12345", " 1234567890 ", "12345678901", None]) == [
        "0000012345", "1234567890", "1234567890", None]


def test_rates_without_a_whole_are_null(spark):
    row = spark.range(1).select(
        rate_pct(F.lit(1), F.lit(3)), rate_pct(F.lit(1), F.lit(0)), share_pct(F.lit(1), F.lit(8)),
        rate_pct(F.lit(2), F.lit(3), 1)).first()
    assert list(row) == [33.33, None, 12.5, 66.7]


def test_amount_sum_is_exact(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("a"))
    assert df.agg(amount_sum("a")).first()[0] == 100.0
    assert df.agg(F.sum("a")).first()[0] != 100.0


def test_amount_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert df.agg(amount_sum("a")).first()[0] is None


def test_amount_sum_keeps_small_parts_and_takes_any_size(spark):
    df = spark.createDataFrame([(0.00004,), (0.00004,), (0.00004,), (None,)], "a double")
    assert df.agg(amount_sum("a")).first()[0] == 0.00012
    df = spark.createDataFrame([(1e16,), (0.1,), (0.2,)], "a double")
    assert df.agg(amount_sum("a")).first()[0] == 1e16
    df = spark.createDataFrame([(1e300,), (-1e300,), (0.1,)] + [(9.9e17,)] * 50, "a double")
    assert df.agg(amount_sum("a")).first()[0] == 4.95e19
