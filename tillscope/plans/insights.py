"""Insight figures and the template paragraphs over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c


def kpis(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.count(F.lit(1)).alias("total_txns"),
        c.rounded(c.or_zero(c.sum_where(c.success(), "amount"))).alias("total_revenue"),
        F.count_if(c.fraud()).alias("fraud_count"),
        c.rounded(c.or_zero(c.avg_where(c.success(), "amount"))).alias("avg_txn_value"),
    )


def top_category(tx: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Category of highest trailing Success revenue; one without any never wins."""
    return (
        c.trailing(tx, as_of, days)
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("txns"),
            c.rounded(c.sum_where(c.success(), "amount")).alias("revenue"),
        )
        .orderBy(F.desc_nulls_last("revenue"), "category")
        .limit(1)
    )


def weekend_lift(tx: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Weekend against weekday Success revenue in percent: raw totals (a flat week reads
    -60), and per day of each kind."""
    weekend = F.col("weekend_flag") == 1
    sums = c.trailing(tx, as_of, days).agg(
        c.rounded(c.or_zero(c.sum_where(c.success() & weekend, "amount"))).alias("weekend_revenue"),
        c.rounded(c.or_zero(c.sum_where(c.success() & ~weekend, "amount"))).alias("weekday_revenue"),
    )

    def lift(a, b):
        return c.rounded((a / F.greatest(b, F.lit(1.0)) - 1) * 100)

    we, wd = F.col("weekend_revenue"), F.col("weekday_revenue")
    return sums.withColumns({"weekend_lift": lift(we, wd), "weekend_lift_per_day": lift(we / 2, wd / 5)})


def top_payment(tx: DataFrame) -> DataFrame:
    return (
        tx.where(c.success())
        .groupBy("payment_method")
        .agg(F.count(F.lit(1)).alias("txns"), c.rounded(c.money_sum("amount")).alias("amount"))
        .orderBy(F.desc("txns"), "payment_method")
        .limit(1)
    )


def refund_rate(tx: DataFrame) -> DataFrame:
    return tx.agg(c.rounded(c.percent(F.count_if(c.refunded()), F.count(F.lit(1)))).alias("refund_rate"))


def sentiment(merchant_sentiment: DataFrame) -> DataFrame:
    """Unweighted mean of the merchants' polarity and the review counts."""
    return merchant_sentiment.agg(
        c.rounded(c.or_zero(F.avg("avg_polarity")), 3).alias("avg_polarity"),
        F.coalesce(F.sum("positive_count"), F.lit(0)).alias("positive"),
        F.coalesce(F.sum("negative_count"), F.lit(0)).alias("negative"),
    )


def top_segment(segments: DataFrame, name: str = "segment_name") -> DataFrame:
    """Segment of highest average spend and its size, from one row per segment."""
    return (
        segments.select(F.col(name).alias("segment"), "customer_count", "avg_spend")
        .orderBy(F.desc_nulls_last("avg_spend"), "segment")
        .limit(1)
    )


def _row(df: DataFrame):
    """The single row of a frame as a struct column, for use in another frame."""
    return df.select(F.struct("*").alias("row")).scalar()


# The paragraphs, in order.
_TEMPLATES = {
    "revenue_overview": (
        "Total platform revenue stands at ₹%sM across %s transactions, with an average ticket size of ₹%s. "
        "The %s category continues to drive the highest share of revenue at ₹%sK."
    ),
    "fraud_risk": (
        "Fraud detection flagged %s transactions (%s%%). The ML model (Isolation Forest) shows %s%% alignment "
        "with heuristic rules, providing robust dual-layer protection. High-risk hours remain concentrated in "
        "the 00:00–04:00 window."
    ),
    "weekend_behavior": (
        "Weekend transaction volume %s by %s%% compared to weekdays over the trailing 30-day period, "
        "indicating %s."
    ),
    "payment_trends": (
        "%s remains the dominant payment method. UPI continues rapid adoption among mobile-first users, while "
        "credit card usage is concentrated in high-ticket Electronics and Travel categories."
    ),
    "merchant_health": (
        "Platform-wide refund rate is %s%%. NLP sentiment analysis across merchant reviews reveals an average "
        "polarity of %s, with %s negative reviews flagged for follow-up."
    ),
    "customer_segments": (
        "The '%s' segment leads in value, comprising %s customers. Dormant user reactivation and "
        "luxury-spender retention remain the highest-ROI levers for revenue growth."
    ),
}


def executive_summaries(
    tx: DataFrame, as_of: date, agreement: DataFrame, merchant_sentiment: DataFrame, segments: DataFrame
) -> DataFrame:
    """(id, topic, summary): six paragraphs. The other figures enter the KPI row as
    single-row subqueries."""
    facts = kpis(tx).withColumns(
        {
            "category": _row(top_category(tx, as_of)),
            "weekend": _row(weekend_lift(tx, as_of)),
            "payment": _row(top_payment(tx)),
            "refund": _row(refund_rate(tx)),
            "mood": _row(sentiment(merchant_sentiment)),
            "segment": _row(top_segment(segments)),
            "agreement": _row(agreement),
        }
    )

    def fixed(x, places: int):
        return F.format_string(f"%.{places}f", c.or_zero(x))

    def counted(x):
        return F.format_number(F.coalesce(x, F.lit(0)), 0)

    def named(x):
        return F.coalesce(x, F.lit("N/A"))

    # Printed figures start from unrounded values: rounding twice could move a digit.
    weekday = F.greatest(F.col("weekend.weekday_revenue"), F.lit(1.0))
    lift = c.or_zero((F.col("weekend.weekend_revenue") / weekday - 1) * 100)
    agreed = c.percent(F.col("agreement.agreed"), F.col("agreement.total"))
    up = lift > 0
    values = {
        "revenue_overview": [
            fixed(F.col("total_revenue") / 1e6, 2),
            counted(F.col("total_txns")),
            fixed(F.col("avg_txn_value"), 2),
            named(F.col("category.category")),
            fixed(F.col("category.revenue") / 1e3, 1),
        ],
        "fraud_risk": [
            counted(F.col("fraud_count")),
            fixed(c.percent(F.col("fraud_count"), F.col("total_txns")), 2),
            fixed(agreed, 1),
        ],
        "weekend_behavior": [
            F.when(up, "increased").otherwise("decreased"),
            fixed(F.abs(lift), 1),
            F.when(up, "strong leisure-driven spending").otherwise("weaker weekend engagement"),
        ],
        "payment_trends": [named(F.col("payment.payment_method"))],
        "merchant_health": [
            fixed(F.col("refund.refund_rate"), 2),
            c.signed(c.or_zero(F.col("mood.avg_polarity")), 3),
            F.coalesce(F.col("mood.negative"), F.lit(0)).cast("string"),
        ],
        "customer_segments": [named(F.col("segment.segment")), counted(F.col("segment.customer_count"))],
    }
    wide = facts.select(
        *[F.format_string(text, *values[topic]).alias(topic) for topic, text in _TEMPLATES.items()]
    )
    order = F.array(*[F.lit(topic) for topic in _TEMPLATES])
    return wide.unpivot([], list(_TEMPLATES), "topic", "summary").select(
        F.array_position(order, F.col("topic")).cast("int").alias("id"), "topic", "summary"
    )
