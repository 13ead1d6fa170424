"""Executive summary."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions import columns as c


def executive_kpis(tx: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """One row from one pass over the fact; the dimension counts are scalar subqueries."""
    n, hit = F.count(F.lit(1)), F.count_if(c.fraud())
    people = customers.agg(F.count(F.lit(1)).alias("n"))
    active = merchants.where("status = 'Active'").agg(F.count(F.lit(1)).alias("n"))
    return tx.agg(
        n.alias("total_transactions"),
        c.rounded(c.or_zero(c.sum_where(c.success(), "amount"))).alias("total_revenue"),
        hit.alias("fraud_count"),
        c.rounded(c.or_zero(c.sum_where(c.fraud(), "amount"))).alias("fraud_amount"),
        c.rounded(c.percent(F.count_if(c.success()), n)).alias("success_rate"),
        c.rounded(c.percent(hit, n)).alias("fraud_rate"),
    ).withColumns({"total_customers": people.scalar(), "total_merchants": active.scalar()})


def executive_today(tx: DataFrame, as_of: date) -> DataFrame:
    today = c.in_range(tx, since=as_of, before=as_of + timedelta(days=1))
    return today.agg(
        c.rounded(c.or_zero(c.sum_where(c.success(), "amount"))).alias("revenue"),
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(c.fraud()).alias("fraud"),
    )


def daily_trend(tx: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Revenue of all statuses."""
    return (
        c.trailing(tx, as_of, days)
        .groupBy(c.day().alias("date"))
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            c.rounded(c.money_sum("amount")).alias("revenue"),
            F.count_if(c.success()).alias("success"),
            F.count_if(c.failed()).alias("failed"),
            F.count_if(c.fraud()).alias("fraud"),
        )
        .orderBy("date")
    )


def payment_distribution(tx: DataFrame) -> DataFrame:
    """Success rows per method. The share's denominator is summed from the few
    aggregated rows, not from a second scan."""
    whole = F.sum("txn_count").over(Window.partitionBy())
    return (
        tx.where(c.success())
        .groupBy("payment_method")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            c.rounded(c.money_sum("amount")).alias("total_amount"),
        )
        .withColumn("percentage", c.rounded(c.percent(F.col("txn_count"), whole)))
        .orderBy(F.desc("txn_count"), "payment_method")
    )


def category_distribution(tx: DataFrame) -> DataFrame:
    return (
        tx.where(c.success())
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("txn_count"), c.rounded(c.money_sum("amount")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
    )


# The eight cards (label, source column, prefix, suffix).
CARDS = [
    ("Total Revenue", "total_revenue", "₹", None),
    ("Transactions", "total_transactions", None, None),
    ("Active Customers", "total_customers", None, None),
    ("Active Merchants", "total_merchants", None, None),
    ("Fraud Count", "fraud_count", None, None),
    ("Fraud Amount", "fraud_amount", "₹", None),
    ("Success Rate", "success_rate", None, "%"),
    ("Fraud Rate", "fraud_rate", None, "%"),
]


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """The wide KPI row as eight labelled rows."""
    long = kpis.select([F.col(source).cast("double").alias(label) for label, source, _, _ in CARDS])
    cards = long.unpivot([], [label for label, *_ in CARDS], "label", "value")

    def mark(position: int):
        column = F.lit(None).cast("string")
        for card in CARDS:
            if card[position]:
                column = F.when(F.col("label") == card[0], card[position]).otherwise(column)
        return column

    return cards.withColumns({"prefix": mark(2), "suffix": mark(3)})
