"""The three standing views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.operators.star import star


def fraud_alerts(tx: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """Fraud rows with both dimensions. The consumer sorts."""
    return star(
        tx.where(c.fraud()), customers, merchants,
        ["customer_name", F.col("device_preference").alias("customer_device")],
        ["merchant_name", F.col("risk_score").alias("merchant_risk_score")],
    ).select(
        "transaction_id", "timestamp", "amount", "payment_method", "category", "city", "status",
        "device_type", "fraud_score", "risk_level", "customer_merchant_distance",
        "transaction_hour", "weekend_flag", "customer_name", "customer_device",
        "merchant_name", "merchant_risk_score",
    )


def merchant_stats(tx: DataFrame) -> DataFrame:
    """Per merchant with transactions. Revenue and average are those of Success rows."""
    n = F.count(F.lit(1))
    return tx.groupBy("merchant_id").agg(
        n.alias("total_txns"),
        c.rounded(c.sum_where(c.success(), "amount")).alias("revenue"),
        c.rounded(c.avg_where(c.success(), "amount")).alias("avg_txn_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
        c.rounded(c.percent(F.count_if(c.fraud()), n), 4).alias("fraud_pct"),
        c.rounded(c.percent(F.count_if(c.refunded()), n), 4).alias("refund_pct"),
        c.rounded(c.percent(F.count_if(c.success()), n), 4).alias("success_pct"),
    )


def merchant_rates(tx: DataFrame, merchants: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Every merchant. The fact is aggregated before the join: one row per merchant moves."""
    directory = merchants.select(
        "merchant_id", "merchant_name", "category", "city", "state", "risk_score", "status", *extra
    )
    return (
        directory.join(merchant_stats(tx), "merchant_id", "left")
        .fillna(0, ["total_txns", "unique_customers"])
        .fillna(0.0, ["revenue", "avg_txn_value", "fraud_pct", "refund_pct", "success_pct"])
    )


def merchant_performance(tx: DataFrame, merchants: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return merchant_rates(tx, merchants, extra).drop("success_pct")


def customer_stats(tx: DataFrame) -> DataFrame:
    """Per customer with transactions. Spend and average are those of Success rows."""
    return tx.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_txns"),
        c.rounded(c.sum_where(c.success(), "amount")).alias("total_spend"),
        c.rounded(c.avg_where(c.success(), "amount")).alias("avg_txn_value"),
        F.max("timestamp").alias("last_txn"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
        F.count_if(c.fraud()).alias("fraud_txn_count"),
    )


def customer_summary(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Every customer; last_txn stays NULL without transactions."""
    directory = customers.select(
        "customer_id", "customer_name", "city", "state", "registration_date", "device_preference"
    )
    return (
        directory.join(customer_stats(tx), "customer_id", "left")
        .fillna(0, ["total_txns", "unique_merchants", "fraud_txn_count"])
        .fillna(0.0, ["total_spend", "avg_txn_value"])
    )
