"""The given star-schema tables seen as the five raw payments entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope import schemas

# Own sentences: the given tables hold no reviews and no tickets. Three per rating, one per issue.
REVIEW_TEXTS = {
    1: [
        "An awful visit, {merchant} sold me broken goods.",
        "The worst day I had in {city}, and {merchant} is to blame.",
        "A bad deal from start to end. Poor service, poor {category}.",
    ],
    2: [
        "Slow help and a bad mood behind the counter of {merchant}.",
        "I left {merchant} disappointed, as the {category} part is not good.",
        "Prices are below their promise, but their work is poor.",
    ],
    3: [
        "A fine place if you are near {city}, otherwise average.",
        "{merchant} has {category} like anyone else. Nothing to add.",
        "Some days better, some days slow. Average on the whole.",
    ],
    4: [
        "A friendly team at {merchant} and a nice choice of {category}.",
        "Good value, easy to reach in {city}.",
        "I am happy with {merchant}, only parking is slow.",
    ],
    5: [
        "Great, simply great! {merchant} is the best of {city}.",
        "Perfect advice on {category}, very helpful people.",
        "I love this shop. Awesome {category}, fast and friendly.",
    ],
}
TICKET_TEXTS = {
    "Payment Failed": "The terminal declined my card, yet {amount} were deducted on {date}. Please look into it.",
    "Refund Issue": "It has been {days} days since I sent the goods back, no refund over {amount} so far.",
    "Fraud Alert": "Urgent: on {date} someone paid {amount} with my card, I suspect fraud.",
    "Account Access": "My password stopped working on {date}; how do I get access again?",
    "General Query": "Which reward do I get for my next offer, and how are points counted?",
}


def _id(prefix: str, number: Column, width: int) -> Column:
    """Prefix and zero-padded number; a longer number keeps all its digits."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def _pick(values: list[str], index: Column) -> Column:
    """values[index], from 0."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _fill(template: Column, **values: Column) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _placed(df: DataFrame, spark: SparkSession, sf_dir: str, nation_key: str) -> DataFrame:
    """Adds the nation as city and the region as state."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        df.join(nation, F.col(nation_key) == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .withColumns({"city": F.col("n_name"), "state": F.col("r_name")})
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    mean = (12000 + (key % 100) * 300).cast("double")
    return _placed(table(spark, sf_dir, "customer"), spark, sf_dir, "c_nationkey").select(
        _id("CUST", key, 5).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit("@Example.com ")).alias("email"),
        _id("9", key, 9).alias("phone"),
        "city",
        "state",
        ((key * 37) % 101).cast("double").alias("x_customer_id"),
        ((key * 53 + 11) % 101).cast("double").alias("y_customer_id"),
        mean.alias("mean_amount"),
        (mean / F.lit(2.0)).alias("std_amount"),
        ((key % 40).cast("double") / F.lit(10.0)).alias("mean_nb_tx_per_day"),
        F.date_add(F.lit("1993-01-01").cast("date"), (key % 700).cast("int")).alias("registration_date"),
        _pick(schemas.DEVICES, key % 3).alias("device_preference"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _placed(table(spark, sf_dir, "supplier"), spark, sf_dir, "s_nationkey").select(
        _id("MER", key, 5).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        _pick(schemas.CATEGORIES, key % 10).alias("category"),
        "city",
        "state",
        ((key * 61 + 7) % 101).cast("double").alias("x_merchant_id"),
        ((key * 29 + 3) % 101).cast("double").alias("y_merchant_id"),
        (10 + (key * 17) % 85).cast("int").alias("risk_score"),
        F.date_add(F.lit("1992-01-01").cast("date"), (key % 900).cast("int")).alias("registration_date"),
        (50 + (key * 13) % 950).cast("double").alias("avg_transaction_value"),
        F.when(key % 11 == 0, "Inactive").otherwise("Active").alias("status"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, duplicates included. Place and category come from the merchant later."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    hour = ((order * 7 + line * 5) % 24).cast("int")
    zero = F.lit(0)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    methods = [" Credit Card", "Debit Card ", "UPI", "Net Banking", "Wallet"]
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    return table(spark, sf_dir, "lineitem").join(orders, order == F.col("o_orderkey")).select(
        _id("TXN", order * 10 + line, 9).alias("transaction_id"),
        _id("CUST", F.col("o_custkey"), 5).alias("customer_id"),
        _id("MER", F.col("l_suppkey"), 5).alias("merchant_id"),
        F.col("l_extendedprice").alias("amount"),
        _pick(methods, priority - 1).alias("payment_method"),
        (F.col("l_shipdate") + F.make_dt_interval(zero, hour, zero, zero)).alias("timestamp"),
        F.when((order + line) % 50 == 0, "Refunded")
        .when((F.col("l_returnflag") == "A") & (line <= 2), "Failed")
        .otherwise("Success")
        .alias("status"),
        _pick(schemas.DEVICES, line % 3).alias("device_type"),
    )


def reviews(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """One review per order, about its transaction with the lowest line number."""
    number = F.substring("transaction_id", 4, 40).cast("bigint")
    order = F.col("order_key")
    first = (
        transactions.select(
            F.expr("cast(substring(transaction_id, 4) as bigint) div 10").alias("order_key"),
            number.alias("number"),
            "transaction_id", "customer_id", "merchant_id", "timestamp",
        )
        .groupBy("order_key")
        .agg(F.min_by(F.struct("transaction_id", "customer_id", "merchant_id", "timestamp"), "number").alias("t"))
        .select("order_key", "t.*")
    )
    names = merchants.select(
        F.col("merchant_id").alias("_seller"), "merchant_name", "category", F.col("city").alias("_city")
    )
    rating = (1 + order % 5).cast("int")
    texts = [text for stars in sorted(REVIEW_TEXTS) for text in REVIEW_TEXTS[stars]]
    variant = (order % 5) * 3 + F.expr("(order_key div 5) % 3")
    text = _fill(
        _pick(texts, variant),
        merchant=F.coalesce("merchant_name", F.lit("Unknown Merchant")),
        category=F.coalesce("category", F.lit("General")),
        city=F.coalesce("_city", F.lit("Unknown")),
    )
    return first.join(names, F.col("merchant_id") == F.col("_seller"), "left").select(
        _id("REV", order, 9).alias("review_id"),
        "transaction_id",
        "customer_id",
        "merchant_id",
        rating.alias("rating"),
        F.concat(text, F.lit("\\nRef "), order.cast("string")).alias("review_text"),
        "timestamp",
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per order."""
    key = F.col("o_orderkey")
    issue = key % 5
    description = _fill(
        _pick([TICKET_TEXTS[i] for i in schemas.ISSUES], issue),
        amount=F.col("o_totalprice").cast("bigint").cast("string"),
        date=F.date_format("o_orderdate", "yyyy-MM-dd"),
        days=(1 + key % 14).cast("string"),
    )
    return table(spark, sf_dir, "orders").select(
        _id("TKT", key, 9).alias("ticket_id"),
        _id("CUST", F.col("o_custkey"), 5).alias("customer_id"),
        _pick(schemas.ISSUES, issue).alias("issue_type"),
        F.concat(description, F.lit("\\nRef "), key.cast("string")).alias("description"),
        _pick(["Open", "Resolved", "Escalated"], key % 3).alias("status"),
        F.when(key % 7 == 0, "High").when(key % 7 <= 2, "Low").otherwise("Medium").alias("priority"),
        F.col("o_orderdate").alias("timestamp"),
    )
