"""Merchant directory, profile, ranking and sentiment."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.operators import paging
from tillscope.plans import views


def filtered(merchants: DataFrame, *, category=None, city=None, status=None, search=None) -> DataFrame:
    merchants = paging.where_equal(merchants, category=category, city=city, status=status)
    return paging.where_contains(merchants, "merchant_name", search)


def directory(tx: DataFrame, merchants: DataFrame, **filters) -> DataFrame:
    """Every wanted merchant with its statistics."""
    wanted = filtered(merchants, **filters)
    return views.merchant_performance(tx, wanted, ("avg_transaction_value", "registration_date")).drop(
        "avg_txn_value"
    )


def page(tx: DataFrame, merchants: DataFrame, *, page: int = 1, limit: int = 25, **filters) -> DataFrame:
    return paging.far_page(directory(tx, merchants, **filters), "revenue", "merchant_id", page, limit)


def page_total(merchants: DataFrame, **filters) -> DataFrame:
    return paging.total_of(filtered(merchants, **filters))


def top(tx: DataFrame, merchants: DataFrame, limit: int = 10, category: str | None = None) -> DataFrame:
    """Top merchants by Success revenue."""
    paging.check_limit(limit, 50)
    return (
        directory(tx, merchants, category=category)
        .select(
            "merchant_id", "merchant_name", "category", "city", "revenue", "total_txns",
            "unique_customers", "fraud_pct",
        )
        .orderBy(F.desc("revenue"), "merchant_id")
        .limit(limit)
    )


def daily(tx: DataFrame, as_of: date, merchant_id: str | None = None, days: int = 30) -> DataFrame:
    """Trailing days of one merchant, or of all. Revenue of all statuses."""
    tx = paging.where_equal(c.trailing(tx, as_of, days), merchant_id=merchant_id)
    return tx.groupBy("merchant_id", c.day().alias("date")).agg(
        F.count(F.lit(1)).alias("transactions"),
        c.rounded(c.money_sum("amount")).alias("revenue"),
        F.count_if(c.failed()).alias("failed"),
        F.count_if(c.fraud()).alias("fraud"),
    )


def profile(tx: DataFrame, merchants: DataFrame, as_of: date, merchant_id: str | None = None) -> DataFrame:
    """Details and statistics with the trailing days as a sorted list of at most 31 rows."""
    mine = paging.where_equal(tx, merchant_id=merchant_id)
    days = daily(tx, as_of, merchant_id)
    trend = days.groupBy("merchant_id").agg(
        F.sort_array(
            F.collect_list(F.struct("date", "transactions", "revenue", "failed", "fraud"))
        ).alias("daily_trend")
    )
    return (
        directory(mine, paging.where_equal(merchants, merchant_id=merchant_id))
        .join(trend, "merchant_id", "left")
    )


def sentiment_page(sentiment: DataFrame, merchants: DataFrame, page: int = 1, limit: int = 25) -> DataFrame:
    named = sentiment.join(
        merchants.select("merchant_id", "merchant_name", "category", "city"), "merchant_id"
    )
    return paging.far_page(named, "avg_polarity", "merchant_id", page, limit)


def sentiment_extremes(sentiment: DataFrame, n: int = 3) -> DataFrame:
    """The n best and n worst merchants by mean polarity."""
    ends = [
        sentiment.orderBy(order, "merchant_id").limit(n).select(
            F.lit(kind).alias("kind"), "merchant_id", "avg_polarity"
        )
        for kind, order in (("best", F.desc("avg_polarity")), ("worst", F.asc("avg_polarity")))
    ]
    return ends[0].unionByName(ends[1])
