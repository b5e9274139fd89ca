"""Claims derived from the order tables: every kind of dirt the operators deal with, by rule.

Raw text columns as a claims feed would send them, from line items and their order, customer,
nation and part. Only the joins a column needs are made, so a query on dates alone reads one
table. Joins carry no broadcast hint: Spark broadcasts a side when its size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.constants import RAW_COLUMNS

#: The day all compared results are computed for.
AS_OF = "2024-12-15"

_FROM_ORDERS = {"member_id", "payer_id", "line_of_business"}
_FROM_CUSTOMER = {"payer_id", "line_of_business"}
_FROM_NATION = {"payer_id"}
_FROM_PART = {"icd10_code", "cpt_code"}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _expressions() -> dict[str, Column]:
    c = F.col

    def every(column: str, n: int, r: int = 0) -> Column:
        return c(column) % n == r

    price = F.rint(c("l_extendedprice") * 100)
    cents = F.floor(price / 20)
    allowed = F.floor(price * (1 - c("l_discount")) / 20)
    paid = allowed + F.when(every("l_partkey", 89), cents).otherwise(F.lit(0))

    def text(amount: Column) -> Column:
        whole = F.floor(amount / 100).cast("string")
        return F.concat(whole, F.lit("."), F.lpad((amount % 100).cast("string"), 2, "0"))

    sign = F.when(every("l_partkey", 83), "-")
    npi = (F.when(every("l_suppkey", 50, 7), F.lit(None).cast("bigint"))
           .when(every("l_suppkey", 10, 3), c("l_suppkey") + 12345)
           .when(every("l_suppkey", 50, 9), c("l_suppkey") + 10_000_000_000)
           .otherwise(c("l_suppkey") + 1_000_000_000))
    shipped = c("l_shipdate").cast("date")
    day = F.date_add(F.lit("2024-01-01").cast("date"),
                     F.datediff(shipped, F.lit("1995-01-01").cast("date")) % 366)
    slot = c("l_partkey") % 20
    return {
        "claim_id": F.when(~every("l_orderkey", 997), F.concat(
            F.lit("CLM"), F.lpad(c("l_orderkey").cast("string"), 8, "0"), F.lit("-"),
            c("l_linenumber").cast("string"))),
        "member_id": F.when(~every("o_custkey", 97), F.concat(
            F.lit(" MBR"), F.lpad(c("o_custkey").cast("string"), 7, "0"))),
        "provider_npi": npi.cast("string"),
        "service_date": F.when(every("l_orderkey", 211), F.lit("not-a-date"))
        .when(every("l_orderkey", 4, 0), F.date_format(day, "yyyy-MM-dd"))
        .when(every("l_orderkey", 4, 1), F.date_format(day, "MM/dd/yyyy"))
        .when(every("l_orderkey", 4, 2), F.date_format(day, "M/d/yyyy"))
        .otherwise(F.date_format(day, "yyyyMMdd")),
        "icd10_code": F.concat(F.lower("p_brand"), F.lit(" ")),
        "cpt_code": c("p_type"),
        "billed_amount": F.concat(F.coalesce(sign, F.lit("$")), text(cents)),
        "allowed_amount": text(allowed),
        "paid_amount": F.concat(F.coalesce(sign, F.lit("")), text(paid)),
        "claim_status": F.when(every("l_partkey", 101), "UNKNOWN")
        .when(every("l_partkey", 103), F.lit(None).cast("string"))
        .when(slot <= 1, "denied").when(slot <= 3, " PENDING").when(slot == 4, "Adjusted")
        .when(slot == 5, "voided").otherwise("approved "),
        "payer_id": F.concat(F.lit("pyr00"), c("n_regionkey").cast("string")),
        "line_of_business": F.lower("c_mktsegment"),
        "network_flag": F.when(c("l_returnflag") == "R", "out").otherwise("in "),
        # Not raw columns: load time and date, and what breaks ties between copies of a claim.
        "ingestion_ts": c("l_shipdate").cast("timestamp"),
        "ingestion_date": F.trunc(shipped, "month"),
        "tie_part": c("l_partkey"),
        "tie_supplier": c("l_suppkey"),
    }


def claims_raw(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = RAW_COLUMNS
) -> DataFrame:
    """One raw claim per line item, with the columns asked for."""
    wanted = set(columns)
    df = load(spark, sf_dir, "lineitem")
    if wanted & _FROM_PART:
        part = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"))
    # The given file has one row group, whose texts one task would make by itself. Dealt by the key of the
    # orders, line items are shuffled once for both; no count is given, so partitions grow in number with the rows.
    df = df.repartition("l_orderkey")
    if wanted & _FROM_ORDERS:
        # The small tables meet the orders first, so line items are shuffled once for all of them.
        orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        if wanted & _FROM_CUSTOMER:
            customer = load(spark, sf_dir, "customer").select(
                "c_custkey", "c_nationkey", "c_mktsegment")
            if wanted & _FROM_NATION:
                nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
                customer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    expressions = _expressions()
    return df.select(*[expressions[c].alias(c) for c in columns])


def newest_first() -> list[Column]:
    """Order among copies of a claim in this data."""
    return [F.col("ingestion_ts").desc(), F.col("tie_part").desc(), F.col("tie_supplier").desc()]


def bronze_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw claims with the columns the silver plan needs besides; one batch per month."""
    return claims_raw(spark, sf_dir, [
        *RAW_COLUMNS, "ingestion_ts", "ingestion_date", "tie_part", "tie_supplier"])


def repaired(claims: DataFrame) -> DataFrame:
    """The raw claims as a clean feed would send them: each field that breaks a rule gets a sound
    value. Needs the tie columns."""
    c = F.col
    positive = {a: F.replace(a, F.lit("-"), F.lit("")) for a in ("billed_amount", "paid_amount")}
    known = F.upper(F.trim("claim_status")).isin("APPROVED", "DENIED", "PENDING", "ADJUSTED", "VOIDED")
    return claims.withColumns({
        "claim_id": F.coalesce("claim_id", F.concat(F.lit("NEW"), c("tie_part").cast("string"), F.lit("-"), c("tie_supplier").cast("string"))),
        "member_id": F.coalesce("member_id", F.lit("MBR-NEW")),
        "provider_npi": F.coalesce(F.substring("provider_npi", 1, 10), F.lit("1000000000")),
        "service_date": F.when(c("service_date") == "not-a-date", "2024-02-29").otherwise(c("service_date")),
        "claim_status": F.when(known, c("claim_status")).otherwise(F.lit("approved")),
        "billed_amount": positive["billed_amount"],
        "paid_amount": F.when(c("tie_part") % 89 == 0, "0.00").otherwise(positive["paid_amount"])})
