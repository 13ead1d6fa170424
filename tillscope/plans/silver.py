"""Raw tables to cleansed and featured tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope import schemas
from tillscope.functions import columns as c
from tillscope.operators.cleanse import dedup, require
from tillscope.tables import Tables

HIGH_VALUE = 5000.0
LATE_UNTIL = 4


def _cleansed(raw: DataFrame, entity: str, first_by: list[str] = ()) -> DataFrame:
    """Dedup first, then drop what is incomplete."""
    required = schemas.REQUIRED[entity]
    return require(dedup(raw, schemas.PRIMARY_KEYS[entity], required, first_by), required)


def _spaced(x: str):
    """A backslash followed by n, as two characters, becomes a blank."""
    return F.replace(F.col(x), F.lit("\\n"), F.lit(" "))


def customers(raw: DataFrame) -> DataFrame:
    return _cleansed(raw, "customers").withColumns(
        {"customer_name": F.trim("customer_name"), "email": F.lower(F.trim("email"))}
    )


def merchants(raw: DataFrame) -> DataFrame:
    return _cleansed(raw, "merchants").withColumns(
        {
            "merchant_name": F.trim("merchant_name"),
            "category": F.trim("category"),
            "risk_score": F.col("risk_score").try_cast("int"),
        }
    )


def typed_transactions(raw: DataFrame) -> DataFrame:
    """Cleansed, typed and normalised. What does not parse becomes NULL."""
    ts = F.col("timestamp")
    if dict(raw.dtypes)["timestamp"] == "string":
        ts = F.try_to_timestamp(ts)
    typed = {"timestamp": ts.cast("timestamp_ntz"), "amount": F.col("amount").try_cast("double")}
    if "fraud_score" in raw.columns:
        typed["fraud_score"] = F.col("fraud_score").try_cast("double")
    return (
        _cleansed(raw, "transactions", ["timestamp"])
        .withColumns(typed)
        .withColumns(
            {
                "payment_method": F.lower(F.trim("payment_method")),
                "device_type": F.lower(F.trim("device_type")),
            }
        )
    )


def flagged(tx: DataFrame) -> DataFrame:
    """Adds the flags that hang on a row's time and amount."""
    flags = {
        "txn_hour": F.hour("timestamp"),
        "is_weekend": c.weekend(F.col("timestamp")),
        "is_high_value": F.when(F.col("amount") > HIGH_VALUE, 1).otherwise(0),
    }
    return tx.withColumns(flags).withColumn("is_late_night", F.when(F.col("txn_hour") <= LATE_UNTIL, 1).otherwise(0))


def transactions(raw: DataFrame) -> DataFrame:
    """Typed, normalised and flagged. What does not parse becomes NULL."""
    return flagged(typed_transactions(raw))


def reviews(raw: DataFrame) -> DataFrame:
    return (
        _cleansed(raw, "reviews")
        .withColumn("review_text", _spaced("review_text"))
        .withColumn("review_length", F.length("review_text"))
    )


def tickets(raw: DataFrame) -> DataFrame:
    return (
        _cleansed(raw, "tickets")
        .withColumn("description", _spaced("description"))
        .withColumn("description_length", F.length("description"))
    )


def silver(bronze: Tables) -> Tables:
    return Tables(
        customers=customers(bronze.customers),
        merchants=merchants(bronze.merchants),
        transactions=transactions(bronze.transactions),
        reviews=reviews(bronze.reviews),
        tickets=tickets(bronze.tickets),
    )
