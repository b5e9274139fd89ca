"""Row access by payer and masking of identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Session variables that say who asks: a payer, and whether the caller is an administrator.
CALLER_PAYER, CALLER_IS_ADMIN = "caller_payer_id", "caller_is_admin"


def restrict_rows(
    df: DataFrame, payer_id: str | None = None, is_admin: bool = False, column: str = "payer_id"
) -> DataFrame:
    """Administrators see every row, others their own payer's; without a payer, none."""
    if is_admin:
        return df
    return df.filter(F.lit(False) if payer_id is None else F.col(column) == F.lit(payer_id))


def set_caller(spark: SparkSession, payer_id: str | None = None, is_admin: bool = False) -> None:
    """Say who asks in this session. Row functions called from now on show what the caller may see."""
    known = {CALLER_PAYER: ("string", payer_id), CALLER_IS_ADMIN: ("boolean", is_admin)}
    for name, (kind, value) in known.items():
        spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind}")
        spark.sql(f"SET VARIABLE {name} = :value", args={"value": value})


def row_function(spark: SparkSession, source: str, function: str, column: str = "payer_id") -> None:
    """A SQL table function over a table or view that shows the caller's rows: all of them to an
    administrator, those of the payer to others, none without a payer.

    ``SELECT ... FROM function()`` is then the way to read ``source``. The caller is looked up when a
    query is analysed; before ``set_caller`` nobody sees anything.
    """
    if not spark.sql(f"SHOW USER FUNCTIONS LIKE '{function}'").isEmpty():
        spark.sql(f"DROP TEMPORARY FUNCTION {function}")
    try:
        spark.sql(f"SELECT session.{CALLER_PAYER}, session.{CALLER_IS_ADMIN}").schema
    except AnalysisException:
        set_caller(spark)
    fields = spark.table(source).schema
    returned = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    columns = ", ".join(f"`{f.name}`" for f in fields)
    spark.sql(f"CREATE TEMPORARY FUNCTION {function}() RETURNS TABLE ({returned}) RETURN SELECT {columns} FROM {source} "
              f"WHERE session.{CALLER_IS_ADMIN} OR `{column}` = session.{CALLER_PAYER}")


def mask_columns(
    df: DataFrame,
    columns: Sequence[str] = ("member_id", "provider_npi"),
    method: str = "pattern",
    salt: str | None = None,
) -> DataFrame:
    """``"pattern"`` hides letters and digits, ``"hash"`` gives a SHA-256 that still joins. A hash
    needs a salt that is kept secret: identifiers are short enough to try them all."""
    if method == "pattern":
        masked = {c: F.mask(F.col(c)) for c in columns}
    elif method == "hash":
        if not salt:
            raise ValueError("a hash needs a salt")
        masked = {c: F.sha2(F.concat(F.lit(salt), F.col(c)), 256) for c in columns}
    else:
        raise ValueError(f"method: {method!r}")
    return df.withColumns(masked)
