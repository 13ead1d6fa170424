"""Feature table of the anomaly model, category codes and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.operators.star import star
from tillscope.sources.lake import stage

CATEGORICAL = ["payment_method", "device_type", "category", "status"]

# The features of the anomaly model, in order.
FRAUD_FEATURES = [
    "amount",
    "transaction_hour",
    "weekend_flag",
    "customer_merchant_distance",
    "payment_method_enc",
    "device_type_enc",
    "category_enc",
    "status_enc",
    "customer_mean",
    "customer_std",
    "customer_tx_rate",
    "merchant_risk",
    "amount_vs_customer_mean",
]


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, code): 0-based rank of each value in text order, one pass over ``df``.

    The distinct values are combined before the shuffle, so only the vocabulary moves.
    """
    pairs = df.select(columns).unpivot([], columns, "field", "value")
    order = Window.partitionBy("field").orderBy("value")
    return (
        pairs.where(F.col("value").isNotNull())
        .distinct()
        .withColumn("code", F.row_number().over(order) - 1)
    )


def with_codes(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """Adds <column>_enc; -1 where the value is missing or unknown."""
    for name in columns:
        mine = codes.where(F.col("field") == name).select(
            F.col("value").alias(name), F.col("code").alias(f"{name}_enc")
        )
        df = df.join(mine, name, "left").fillna(-1, [f"{name}_enc"])
    return df


def fraud_features(tx: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """transaction_id and the 13 features, missing numbers as 0."""
    joined = star(
        tx, customers, merchants,
        [
            F.col("mean_amount").alias("customer_mean"),
            F.col("std_amount").alias("customer_std"),
            F.col("mean_nb_tx_per_day").alias("customer_tx_rate"),
        ],
        [F.col("risk_score").alias("merchant_risk")],
    )
    return joined_features(joined, tx)


def joined_features(joined: DataFrame, tx: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The features of rows that have met their customer and merchant; ``keep`` columns come along.

    The vocabulary is that of ``tx``. It is written first: its measured size decides whether the code
    joins broadcast it, and the fact is not shuffled by a handful of values.
    """
    codes = stage(category_codes(tx, CATEGORICAL), "codes")
    coded = with_codes(joined, codes, CATEGORICAL).withColumns(
        {
            "amount_vs_customer_mean": F.col("amount") / (F.col("customer_mean") + 1),
            "amount_vs_merchant_risk": F.col("amount") / (F.col("merchant_risk") + 1),
        }
    )
    return coded.select(
        "transaction_id",
        *[F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in FRAUD_FEATURES],
        *keep,
    )


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, std) with the population deviation, in one pass."""
    wide = df.agg(
        *[F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")).alias(x) for x in columns]
    )
    long = wide.unpivot([], columns, "feature", "m")
    return long.select("feature", "m.mean", "m.std")


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean, unit population deviation; a constant column becomes 0.

    The 2 x columns moments are fitted in one job and enter as literals.
    """
    fitted = {row.feature: row for row in moments(df, columns).collect()}

    def scaled(x: str):
        m = fitted[x]
        if m.mean is None:
            return F.lit(None).cast("double")
        return (F.col(x) - F.lit(m.mean)) / F.lit(m.std or 1.0)

    return df.withColumns({x: scaled(x) for x in columns})

