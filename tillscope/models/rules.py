"""Rule score of a transaction and the label of the top fraction.

Scores are whole points: as floats, two ways to reach 0.45 land on different
sides of the cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.operators.rank_select import kth_smallest_key, text_key

# Points and cuts of the rules.
AMOUNT_POINTS, AMOUNT_FACTOR = 30, 3
NIGHT_POINTS, NIGHT_UNTIL = 20, 4
FAR_POINTS, FAR_FROM = 25, 50.0
RISKY_POINTS, RISKY_FROM = 15, 70
MEDIUM_FROM, HIGH_FROM = 20, 45
FRAUD_FRACTION = 0.015


def _points(condition, points: int):
    return F.when(condition, points).otherwise(0)


def score(enriched: DataFrame) -> DataFrame:
    """Adds fraud_points, fraud_score, risk_level and the rounded distance."""
    points = (
        _points(F.col("amount") > AMOUNT_FACTOR * F.col("mean_amount"), AMOUNT_POINTS)
        + _points(F.col("txn_hour") <= NIGHT_UNTIL, NIGHT_POINTS)
        + _points(F.col("raw_distance") > FAR_FROM, FAR_POINTS)
        + _points(F.col("merchant_risk") > RISKY_FROM, RISKY_POINTS)
    )
    return (
        graded(enriched.withColumn("fraud_points", points))
        .withColumn("customer_merchant_distance", c.rounded(F.col("raw_distance")))
        .drop("raw_distance", "mean_amount", "merchant_risk")
    )


def graded(tx: DataFrame) -> DataFrame:
    """Adds what follows from the points and the flags: fraud_score, risk_level, transaction_hour, weekend_flag."""
    return tx.withColumns(
        {
            "fraud_score": F.col("fraud_points") / F.lit(100.0),
            "risk_level": F.when(F.col("fraud_points") < MEDIUM_FROM, "Low")
            .when(F.col("fraud_points") < HIGH_FROM, "Medium")
            .otherwise("High"),
            "transaction_hour": F.col("txn_hour"),
            "weekend_flag": F.col("is_weekend"),
        }
    )


@dataclass(frozen=True)
class TopFraction:
    """Rows above ``points``, and those at ``points`` up to ``last_id``."""

    points: int
    last_id: str

    def label(self, scored: DataFrame) -> DataFrame:
        points = F.col("fraud_points")
        inside = (points > self.points) | (
            (points == self.points) & (F.col("transaction_id") <= self.last_id)
        )
        return scored.withColumn("is_fraud", F.when(inside, 1).otherwise(0))


def fit_top_fraction(scored: DataFrame, fraction: float = FRAUD_FRACTION) -> TopFraction:
    """The cut that labels exactly max(1, int(fraction * rows)) rows.

    Score counts first (one row per distinct score); only inside the score that
    straddles the cut does the transaction id decide.
    """
    counts = scored.groupBy("fraud_points").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return TopFraction(0, "")
    wanted = max(1, int(fraction * sum(r.n for r in counts)))
    for row in sorted(counts, key=lambda r: -r.fraud_points):
        if row.n >= wanted:
            break
        wanted -= row.n
    bucket = scored.where(F.col("fraud_points") == row.fraud_points)
    last = kth_smallest_key(bucket, text_key(F.col("transaction_id")), wanted)
    return TopFraction(row.fraud_points, bytes.fromhex(last).decode())
