"""Stored counts per month, merchant and customer, from which the standing figures are added up.

A changed month is counted again alone; the others are not read from the transactions. Counts and money
add up over months, and since a pair stands once per month, distinct counts are exact.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions import columns as c
from tillscope.sources.lake import read_table, replace_partition

MONEY = "decimal(38,2)"
COUNTS = ("n", "success", "refunded", "fraud")
SCHEMA = T.StructType(
    [
        *(T.StructField(x, T.StringType()) for x in ("merchant_id", "customer_id")),
        *(T.StructField(x, T.LongType()) for x in COUNTS),
        T.StructField("revenue", T.DecimalType(38, 2)),
        T.StructField("last_txn", T.TimestampNTZType()),
        T.StructField("txn_month", T.DateType()),
    ]
)


def counted(tx: DataFrame) -> DataFrame:
    """One row per month, merchant and customer; NULL keys are keys, a NULL amount adds nothing."""
    paid = F.when(c.success(), F.col("amount")).cast(MONEY)
    return tx.groupBy("merchant_id", "customer_id", "txn_month").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(c.success()).alias("success"),
        F.count_if(c.refunded()).alias("refunded"),
        F.count_if(c.fraud()).alias("fraud"),
        F.coalesce(F.sum(paid), F.lit(0)).cast(MONEY).alias("revenue"),
        F.max("timestamp").alias("last_txn"),
    ).select(*SCHEMA.fieldNames())


def refresh(tx: DataFrame, path: str, months: list[date] | None = None) -> None:
    """Count ``months`` (None: all) of ``tx`` again and replace them in the table at ``path``.

    Each month named gets a row of zeros besides, so that one which has lost all rows is emptied.
    With no month named nothing is read. Rows without a month are counted only when all months are.
    """
    if months is not None:
        if not months:
            return
        tx = tx.where(F.col("txn_month").isin(months))
    rows = counted(tx)
    if months is not None:
        zeros = [(None, None, 0, 0, 0, 0, Decimal(0), None, m) for m in sorted(set(months))]
        rows = rows.unionByName(tx.sparkSession.createDataFrame(zeros, SCHEMA))
    replace_partition(rows, path, "txn_month")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the table, without those of zeros."""
    return read_table(spark, path, SCHEMA).where("n > 0")


def _totals(pairs: DataFrame, key: str, other: str, distinct: str) -> DataFrame:
    n = F.sum("n")

    def share(part: str):
        return c.rounded(c.percent(F.sum(part), n), 4)

    # Months are added up per pair first, so a hot key is spread over its pairs.
    whole = pairs.groupBy(key, other).agg(
        *(F.sum(x).alias(x) for x in (*COUNTS, "revenue")), F.max("last_txn").alias("last_txn")
    )
    return whole.groupBy(key).agg(
        n.alias("total_txns"),
        c.rounded(F.sum("revenue").cast("double")).alias("revenue"),
        F.count(other).alias(distinct),
        share("success").alias("success_pct"),
        share("refunded").alias("refund_pct"),
        share("fraud").alias("fraud_pct"),
        F.max("last_txn").alias("last_txn"),
    )


def merchants(pairs: DataFrame) -> DataFrame:
    """Standing figures per merchant of the transactions, from the stored counts."""
    return _totals(pairs, "merchant_id", "customer_id", "unique_customers")


def customers(pairs: DataFrame) -> DataFrame:
    """Standing figures per customer."""
    return _totals(pairs, "customer_id", "merchant_id", "unique_merchants")
