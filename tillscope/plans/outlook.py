"""Merchant, customer and fraud figures beyond the standing views.

Definitions are our own where only a name was given. "Revenue" is that of
Success rows.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.operators.ordered import with_previous
from tillscope.plans import views
from tillscope.sources.lake import stage


def merchant_growth(tx: DataFrame) -> DataFrame:
    """Revenue per merchant and month against the month before; NULL where that had no sales.

    A merchant has one row per month, so its window is bounded by the calendar.
    """
    months = (
        tx.where(c.success())
        .groupBy("merchant_id", c.month().alias("month"))
        .agg(c.rounded(c.money_sum("amount")).alias("revenue"))
    )
    earlier = Window.partitionBy("merchant_id").orderBy("month")
    adjacent = F.lag("month").over(earlier) == F.add_months("month", -1)
    before = F.when(adjacent, F.lag("revenue").over(earlier))
    change = F.try_divide(F.col("revenue") - F.col("previous_revenue"), F.col("previous_revenue"))
    return months.withColumn("previous_revenue", before).withColumn("growth_pct", c.rounded(change * 100))


def revenue_contribution(tx: DataFrame, merchants: DataFrame) -> DataFrame:
    """A merchant's share of all revenue and of its category's, in percent."""
    performance = views.merchant_performance(tx, merchants)
    revenue = stage(performance.select("merchant_id", "category", "revenue"), "merchant-revenue")
    whole = revenue.agg(c.money_sum("revenue").alias("all_revenue"))
    by_category = revenue.groupBy(F.col("category").alias("_category")).agg(
        c.money_sum("revenue").alias("_category_revenue")
    )
    by_category = stage(by_category, "category-revenue")
    joined = revenue.join(by_category, F.col("category").eqNullSafe(F.col("_category")))
    return joined.select(
        "merchant_id",
        "category",
        "revenue",
        c.rounded(c.percent(F.col("revenue"), whole.scalar()), 4).alias("share_pct"),
        c.rounded(c.percent(F.col("revenue"), F.col("_category_revenue")), 4).alias("category_share_pct"),
    )


def churn_risk_merchants(tx: DataFrame, merchants: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Active merchants with less than half the transactions of the period before."""
    start = as_of - timedelta(days=days)
    recent = F.col("timestamp") >= c.ntz(start)
    window = c.in_range(tx, since=start - timedelta(days=days), before=as_of + timedelta(days=1))
    volume = window.groupBy("merchant_id").agg(
        F.count_if(recent).alias("recent_txns"), F.count_if(~recent).alias("prior_txns")
    )
    active = merchants.where("status = 'Active'").select("merchant_id", "merchant_name")
    return active.join(volume, "merchant_id").where(F.col("recent_txns") * 2 < F.col("prior_txns"))


def rapid_repeat_payments(tx: DataFrame, minutes: int = 1440) -> DataFrame:
    """Payments of a customer to the same merchant within ``minutes`` of the one before.

    Every payment looks at the one before, not at all others. A pair that holds much of the
    data, on one day even, is split into ranges (``operators/ordered.py``).
    """
    pair = ["customer_id", "merchant_id"]
    known = tx.where("customer_id IS NOT NULL AND merchant_id IS NOT NULL").select(
        "transaction_id", *pair, "timestamp", "amount"
    )
    followed = with_previous(known, pair, ["timestamp", "transaction_id"], "timestamp", "previous")
    gap = F.timestamp_diff("SECOND", F.col("previous"), F.col("timestamp"))
    return followed.where(gap <= minutes * 60).select(
        "transaction_id", *pair, "timestamp", "amount", c.rounded(gap / 60).alias("gap_minutes")
    )


def geo_mismatch(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer city: transactions made in another city."""
    home = customers.select("customer_id", F.col("city").alias("home_city"))
    visits = tx.groupBy("customer_id", "city").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(c.fraud()).alias("fraud")
    )
    away = F.col("city") != F.col("home_city")

    def total(x: str, where=None):
        return F.coalesce(F.sum(F.col(x) if where is None else F.when(where, F.col(x))), F.lit(0))

    return (
        visits.join(home, "customer_id")
        .groupBy("home_city")
        .agg(
            total("n").alias("transactions"),
            total("n", away).alias("away"),
            c.rounded(c.percent(total("n", away), total("n"))).alias("away_pct"),
            total("fraud", away).alias("away_fraud"),
        )
    )


def repeat_transactions(tx: DataFrame, least: int = 2) -> DataFrame:
    """Per merchant: customers with at least ``least`` Success purchases, and those purchases."""
    pairs = (
        tx.where(c.success())
        .groupBy("merchant_id", "customer_id")
        .agg(F.count(F.lit(1)).alias("purchases"))
    )
    again = F.col("purchases") >= least
    return pairs.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(again).alias("repeat_customers"),
        F.coalesce(F.sum(F.when(again, F.col("purchases"))), F.lit(0)).alias("repeat_purchases"),
    )


def hour_weekday_heatmap(tx: DataFrame) -> DataFrame:
    """Fraud counts by hour, one column per weekday from Sunday."""
    names = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]
    return (
        tx.where(c.fraud())
        .groupBy("transaction_hour")
        .agg(*[F.count_if(F.dayofweek("timestamp") == i).alias(n) for i, n in enumerate(names, 1)])
    )


def regional_summary(tx: DataFrame) -> DataFrame:
    """Volume and success rate per state and city, with a row per state and for all."""
    n = F.count(F.lit(1))
    return (
        tx.rollup("state", "city")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            n.alias("transactions"),
            c.rounded(c.money_sum("amount")).alias("volume"),
            c.rounded(c.percent(F.count_if(c.success()), n)).alias("success_rate"),
        )
    )


def high_risk_merchants(tx: DataFrame, least: int = 20, z: float = 2.0) -> DataFrame:
    """Merchants whose fraud rate lies ``z`` deviations above the mean of merchants with
    at least ``least`` transactions."""
    return _outliers(tx, "merchant_id", c.percent(F.count_if(c.fraud()), F.count(F.lit(1))), least, z)


def unusual_customers(tx: DataFrame, least: int = 5, z: float = 2.0) -> DataFrame:
    """Customers whose mean amount lies ``z`` deviations above the mean of customers."""
    return _outliers(tx, "customer_id", c.money_avg("amount"), least, z)


def _outliers(tx: DataFrame, key: str, measure, least: int, z: float) -> DataFrame:
    rows = (
        tx.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("transactions"), c.rounded(measure, 4).alias("value"))
        .where(F.col("transactions") >= least)
    )
    rows = stage(rows, "outlier-measure")
    level = rows.agg(F.struct(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")))
    scored = rows.withColumn("level", level.scalar())
    distance = F.try_divide(F.col("value") - F.col("level.mean"), F.col("level.std"))
    return (
        scored.withColumn("z_score", c.rounded(distance, 4))
        .where(F.col("z_score") >= z)
        .drop("level")
    )


def outlier_treatment(tx: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Amounts cut at the exact quantiles of their category.

    Rows are counted per amount first, so a category's window holds one row per amount
    in cents, however many transactions there are.
    """
    upto = Window.partitionBy("category").orderBy("amount")
    every = Window.partitionBy("category")
    ranked = (
        tx.where("amount IS NOT NULL")
        .groupBy("category", "amount")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"upto": F.sum("n").over(upto), "rows": F.sum("n").over(every)})
    )

    def quantile(share: float):
        return F.min(F.when(F.col("upto") >= F.ceil(F.col("rows") * F.lit(share)), F.col("amount")))

    cuts = ranked.groupBy(F.col("category").alias("_category")).agg(
        F.array(quantile(low), quantile(high)).alias("cut")
    )
    # Written first: its known size lets the fact be joined without a shuffle on few keys.
    cuts = stage(cuts, "amount-cuts")
    joined = tx.join(cuts, F.col("category").eqNullSafe(F.col("_category")))
    inside = F.least(F.greatest(F.col("amount"), F.col("cut")[0]), F.col("cut")[1])
    return joined.select("transaction_id", "category", "amount", inside.alias("amount_treated"))
