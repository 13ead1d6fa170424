"""Joins of the fact table with its dimensions.

No side is hinted: both dimensions grow with the business. Spark broadcasts a
dimension while its measured size allows it and otherwise sort-merges, with
hot keys split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c


def star(
    fact: DataFrame, customers: DataFrame, merchants: DataFrame,
    customer_columns: list, merchant_columns: list,
) -> DataFrame:
    """Inner join with the wanted columns of both dimensions."""
    return fact.join(customers.select("customer_id", *customer_columns), "customer_id").join(
        merchants.select("merchant_id", *merchant_columns), "merchant_id"
    )


def with_names(fact: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    return star(fact, customers, merchants, ["customer_name"], ["merchant_name"])


def enrich(tx: DataFrame, customers: DataFrame, merchants: DataFrame, customer_columns: list = ()) -> DataFrame:
    """Attach what the rules need, in one pass over the dimensions.

    Unknown customers and merchants become NULL keys, the place and category of
    the merchant fill in where the row has none, and the distance is computed.
    ``customer_columns`` come along.
    """
    buyer = customers.select(
        F.col("customer_id").alias("_buyer"), "x_customer_id", "y_customer_id", "mean_amount", *customer_columns
    )
    seller = merchants.select(
        F.col("merchant_id").alias("_seller"),
        F.col("category").alias("_category"),
        F.col("city").alias("_city"),
        F.col("state").alias("_state"),
        "x_merchant_id",
        "y_merchant_id",
        F.col("risk_score").alias("merchant_risk"),
    )
    joined = tx.join(buyer, F.col("customer_id") == F.col("_buyer"), "left").join(
        seller, F.col("merchant_id") == F.col("_seller"), "left"
    )
    filled = {
        name: F.coalesce(F.col(name), F.col(f"_{name}")) if name in tx.columns else F.col(f"_{name}")
        for name in ("category", "city", "state")
    }
    return (
        joined.withColumns(filled)
        .withColumns({"customer_id": F.col("_buyer"), "merchant_id": F.col("_seller")})
        .withColumn("raw_distance", c.distance())
        .drop("_buyer", "_seller", "_category", "_city", "_state")
        .drop("x_customer_id", "y_customer_id", "x_merchant_id", "y_merchant_id")
    )
