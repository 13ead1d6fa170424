"""Aggregate tables. "Revenue" here counts all statuses unless a docstring says Success."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.operators.ordered import percent_rank
from tillscope.plans import views
from tillscope.sources.lake import stage


# ------------------------------------------------------------- lakehouse gold
def daily_revenue(tx: DataFrame) -> DataFrame:
    return tx.groupBy(c.day().alias("date")).agg(
        c.rounded(c.money_sum("amount")).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(c.fraud()).alias("fraud_transactions"),
        c.rounded(c.money_avg("amount")).alias("avg_transaction_value"),
    )


def merchant_kpis(tx: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return tx.groupBy("merchant_id").agg(
        c.rounded(c.money_sum("amount")).alias("merchant_revenue"),
        n.alias("txn_count"),
        c.rounded(c.money_avg("amount")).alias("avg_txn_value"),
        c.rounded(c.percent(F.count_if(c.fraud()), n)).alias("fraud_rate_pct"),
        c.rounded(c.percent(F.count_if(c.success()), n)).alias("success_rate_pct"),
    )


def payment_trends(tx: DataFrame) -> DataFrame:
    return tx.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        c.rounded(c.money_sum("amount")).alias("total_volume"),
    )


def fraud_summary(tx: DataFrame) -> DataFrame:
    return tx.groupBy("risk_level", "payment_method").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(c.fraud()).alias("fraud_count"),
        c.rounded(F.avg("fraud_score")).alias("avg_fraud_score"),
    )


def customer_spend(tx: DataFrame) -> DataFrame:
    return tx.groupBy("customer_id").agg(
        c.rounded(c.money_sum("amount")).alias("total_spent"),
        F.count(F.lit(1)).alias("txn_count"),
        c.rounded(c.money_avg("amount")).alias("avg_spend"),
    )


def support_metrics(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("issue_type", "priority", "status").agg(
        F.count(F.lit(1)).alias("ticket_count")
    )


# ------------------------------------------------------------ warehouse tables
def agg_daily_revenue(tx: DataFrame) -> DataFrame:
    return tx.groupBy(c.day().alias("txn_date")).agg(
        c.rounded(c.money_sum("amount")).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(c.success()).alias("success_count"),
        F.count_if(c.failed()).alias("failed_count"),
        F.count_if(c.refunded()).alias("refunded_count"),
        c.rounded(c.money_avg("amount")).alias("avg_transaction_value"),
        F.count_if(c.fraud()).alias("fraud_count"),
        c.rounded(c.or_zero(c.sum_where(c.fraud(), "amount"))).alias("fraud_amount"),
    )


def merchant_score(rates: DataFrame) -> DataFrame:
    """0 to 100 per merchant: 40 for revenue against the category leader, 30 for
    successful, 15 for not refunded and 15 for not fraudulent transactions.

    Built from aggregates only, so that no ranking over all merchants is needed;
    ``rates`` is read twice and should be a written table. A merchant without
    transactions scores 0.
    """
    leader = rates.groupBy(F.col("category").alias("_category")).agg(F.max("revenue").alias("_best"))
    leader = stage(leader, "category-leaders")
    share = c.or_zero(F.try_divide(F.col("revenue"), F.col("_best")))
    points = (
        40 * share
        + 0.3 * F.col("success_pct")
        + 0.15 * (100 - F.col("refund_pct"))
        + 0.15 * (100 - F.col("fraud_pct"))
    )
    return (
        rates.join(leader, F.col("category").eqNullSafe(F.col("_category")), "left")
        .withColumn("merchant_score", F.when(F.col("total_txns") > 0, c.rounded(points)).otherwise(0.0))
        .drop("_best", "_category")
    )


def merchant_percentiles(rates: DataFrame) -> DataFrame:
    """0 to 100 per merchant by its place among all: 40 points for revenue, 30 for successful, 15 for
    not refunded and 15 for not fraudulent transactions, each times the share of the other merchants
    that do worse.

    Merchants without transactions score 0 and count among the others. ``rates`` is read several times
    and should be a written table.
    """
    figures = {
        "revenue": (F.col("revenue"), 40),
        "success": (F.col("success_pct"), 30),
        "kept": (100 - F.col("refund_pct"), 15),
        "honest": (100 - F.col("fraud_pct"), 15),
    }
    scored = stage(rates.select("merchant_id", "total_txns", *(x.alias(n) for n, (x, _) in figures.items())), "merchant-figures")
    for name in figures:
        scored = scored.join(percent_rank(scored.select(name), [], name, f"{name}_rank"), name, "left")
    points = sum(most * F.col(f"{name}_rank") for name, (_, most) in figures.items())
    return scored.select(
        "merchant_id",
        *(c.rounded(F.col(f"{name}_rank"), 4).alias(f"{name}_rank") for name in figures),
        F.when(F.col("total_txns") > 0, c.rounded(points)).otherwise(0.0).alias("merchant_score"),
    )


def agg_merchant_kpis(tx: DataFrame, merchants: DataFrame, as_of: date) -> DataFrame:
    """One snapshot row per merchant, dated ``as_of``. Revenue is that of Success rows."""
    rates = stage(views.merchant_rates(tx, merchants), "merchant-rates")
    return merchant_score(rates).select(
        "merchant_id",
        F.lit(as_of).alias("metric_date"),
        F.col("revenue").alias("total_revenue"),
        F.col("total_txns").alias("transaction_count"),
        "unique_customers",
        F.col("refund_pct").alias("refund_rate"),
        F.col("fraud_pct").alias("fraud_rate"),
        "merchant_score",
    )


def agg_fraud_summary(tx: DataFrame) -> DataFrame:
    n, hit = F.count(F.lit(1)), F.count_if(c.fraud())
    return tx.groupBy(c.day().alias("txn_date")).agg(
        n.alias("total_transactions"),
        hit.alias("fraud_transactions"),
        c.rounded(c.percent(hit, n)).alias("fraud_rate"),
        c.rounded(c.or_zero(c.sum_where(c.fraud(), "amount"))).alias("fraud_amount"),
        c.rounded(c.money_sum("amount")).alias("total_amount"),
        *[
            F.count_if(F.col("risk_level") == level).alias(f"{level.lower()}_risk_count")
            for level in ("High", "Medium", "Low")
        ],
    )


def agg_customer_segments(segments: DataFrame) -> DataFrame:
    """Numbered segments, best average spend first, from one row per segment."""
    order = Window.orderBy(F.desc("avg_spend"), "segment")
    return segments.select(
        F.row_number().over(order).alias("segment_id"),
        F.col("segment").alias("segment_name"),
        "customer_count",
        "avg_spend",
        "avg_transactions",
        "total_revenue",
    )


def agg_payment_trends(tx: DataFrame) -> DataFrame:
    return tx.groupBy("payment_method", c.month().alias("month")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        c.rounded(c.money_sum("amount")).alias("total_amount"),
    )


def agg_support_metrics(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("issue_type").agg(
        F.count(F.lit(1)).alias("ticket_count"),
        *[
            F.count_if(F.col("status") == status).alias(f"{status.lower()}_count")
            for status in ("Open", "Resolved", "Escalated")
        ],
        F.count_if(F.col("priority") == "High").alias("high_priority_count"),
    )
