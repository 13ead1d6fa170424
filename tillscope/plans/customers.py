"""Customer directory, profile and segments."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.operators import paging
from tillscope.plans import views


@dataclass(frozen=True)
class SegmentCuts:
    """Thresholds of the six-way segment rule."""

    spend: float = 50_000
    spend_txns: int = 100
    frequent_txns: int = 50
    dormant_days: int = 90
    luxury_value: float = 500
    diverse_merchants: int = 20


def segment_of(cuts: SegmentCuts, as_of: date):
    """First match wins. Without a transaction no date test holds."""
    quiet_since = c.ntz(as_of - timedelta(days=cuts.dormant_days))
    big = (F.col("total_spend") >= cuts.spend) & (F.col("total_txns") >= cuts.spend_txns)
    return (
        F.when(big, "high_value")
        .when(F.col("total_txns") >= cuts.frequent_txns, "frequent")
        .when(F.col("last_txn") < quiet_since, "dormant")
        .when(F.col("avg_txn_value") >= cuts.luxury_value, "luxury_spender")
        .when(F.col("unique_merchants") >= cuts.diverse_merchants, "diverse_shopper")
        .otherwise("casual")
    )


def segments_heuristic(summary: DataFrame, as_of: date, cuts: SegmentCuts = SegmentCuts()) -> DataFrame:
    return (
        summary.groupBy(segment_of(cuts, as_of).alias("segment"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            c.rounded(F.avg("total_spend")).alias("avg_spend"),
            c.rounded(F.avg("total_txns"), 1).alias("avg_transactions"),
            c.rounded(c.money_sum("total_spend")).alias("total_revenue"),
        )
        .orderBy(F.desc("avg_spend"), "segment")
    )


def segments_ml(assigned: DataFrame) -> DataFrame:
    return (
        assigned.groupBy("segment_name")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            c.rounded(F.avg("total_spend")).alias("avg_spend"),
            c.rounded(F.avg("total_txns"), 1).alias("avg_transactions"),
            c.rounded(F.avg("unique_merchants"), 1).alias("avg_merchants"),
            c.rounded(F.avg("days_since_last_txn"), 1).alias("avg_recency_days"),
        )
        .orderBy(F.desc("avg_spend"), "segment_name")
    )


def filtered(customers: DataFrame, *, city=None, search=None) -> DataFrame:
    return paging.where_contains(paging.where_equal(customers, city=city), "customer_name", search)


def page(tx: DataFrame, customers: DataFrame, *, page: int = 1, limit: int = 25, **filters) -> DataFrame:
    summary = views.customer_summary(tx, filtered(customers, **filters))
    return paging.far_page(summary, "total_spend", "customer_id", page, limit)


def page_total(customers: DataFrame, **filters) -> DataFrame:
    return paging.total_of(filtered(customers, **filters))


def recent(tx: DataFrame, merchants: DataFrame, customer_id: str | None = None, n: int = 20) -> DataFrame:
    """The last n transactions of one customer, or of every customer.

    The filter on the row number keeps n rows per customer before the shuffle.
    """
    tx = paging.where_equal(tx, customer_id=customer_id).where(
        "customer_id IS NOT NULL AND merchant_id IS NOT NULL"
    )
    newest = Window.partitionBy("customer_id").orderBy(F.desc("timestamp"), "transaction_id")
    last = tx.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= n)
    return last.join(merchants.select("merchant_id", "merchant_name"), "merchant_id")


def monthly(tx: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Months of one customer, or of every customer. Spend is that of Success rows."""
    return (
        paging.where_equal(tx, customer_id=customer_id)
        .groupBy("customer_id", c.month().alias("month"))
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            c.rounded(c.sum_where(c.success(), "amount")).alias("spend"),
            F.count_if(c.fraud()).alias("fraud_count"),
        )
    )


def profile(
    tx: DataFrame, customers: DataFrame, merchants: DataFrame, customer_id: str | None = None
) -> DataFrame:
    """Details and statistics with the last 20 transactions and the months as lists."""
    mine = paging.where_equal(tx, customer_id=customer_id)
    who = paging.where_equal(customers, customer_id=customer_id)
    last = recent(mine, merchants).groupBy("customer_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "position", "transaction_id", "timestamp", "amount", "status",
                    "payment_method", "category", "merchant_id", "merchant_name",
                )
            )
        ).alias("recent_transactions")
    )
    months = monthly(mine).groupBy("customer_id").agg(
        F.sort_array(
            F.collect_list(F.struct("month", "transactions", "spend", "fraud_count"))
        ).alias("monthly_spend")
    )
    details = who.join(
        views.customer_stats(mine), "customer_id", "left"
    ).fillna(0, ["total_txns", "unique_merchants", "fraud_txn_count"]).fillna(0.0, ["total_spend", "avg_txn_value"])
    return details.join(last, "customer_id", "left").join(months, "customer_id", "left")
