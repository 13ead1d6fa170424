"""Report sections as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c


def kpis(tx: DataFrame) -> DataFrame:
    """One row; customers and merchants are those with transactions, the ticket is
    Success revenue over all transactions."""
    n = F.count(F.lit(1))
    counts = tx.agg(
        n.alias("total_txns"),
        c.or_zero(c.sum_where(c.success(), "amount")).alias("revenue"),
        F.count_if(c.fraud()).alias("fraud_count"),
    )
    # One distinct count per aggregation: together they would triple the rows.
    buyers = tx.agg(F.count_distinct("customer_id").alias("n"))
    sellers = tx.agg(F.count_distinct("merchant_id").alias("n"))
    whole = F.greatest(F.col("total_txns"), F.lit(1))
    return counts.select(
        "total_txns",
        c.rounded(F.col("revenue")).alias("total_revenue"),
        "fraud_count",
        buyers.scalar().alias("unique_customers"),
        sellers.scalar().alias("unique_merchants"),
        c.rounded(F.col("fraud_count") / whole * 100).alias("fraud_rate"),
        c.rounded(F.col("revenue") / whole).alias("avg_ticket"),
    )


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """(label, value): the KPI row as printed text."""

    def fixed(x):
        return F.format_string("%.2f", x)

    def counted(name: str):
        return F.format_number(name, 0)

    cards = {
        "Revenue": F.concat(F.lit("₹"), fixed(F.col("total_revenue") / 1e6), F.lit("M")),
        "Transactions": counted("total_txns"),
        "Customers": counted("unique_customers"),
        "Merchants": counted("unique_merchants"),
        "Fraud Rate": F.concat(fixed(F.col("fraud_rate")), F.lit("%")),
        "Fraud Count": counted("fraud_count"),
        "Avg Ticket": F.concat(F.lit("₹"), fixed(F.col("avg_ticket"))),
        "Active Today": F.lit("—"),
    }
    wide = kpis.select(*[text.alias(label) for label, text in cards.items()])
    return wide.unpivot([], list(cards), "label", "value")


def top_merchants(performance: DataFrame, n: int = 10) -> DataFrame:
    return (
        performance.select("merchant_name", "category", "city", "revenue", "total_txns", "fraud_pct", "merchant_id")
        .orderBy(F.desc("revenue"), "merchant_id")
        .limit(n)
        .drop("merchant_id")
    )


def segments(assigned: DataFrame) -> DataFrame:
    return (
        assigned.groupBy("segment_name")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            c.rounded(F.avg("total_spend")).alias("avg_spend"),
            c.rounded(F.avg("total_txns"), 1).alias("avg_transactions"),
        )
        .select(c.title(F.col("segment_name")).alias("segment"), "customer_count", "avg_spend", "avg_transactions")
        .orderBy(F.desc("avg_spend"), "segment")
    )


def tickets(nlp: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        nlp.groupBy("issue_type")
        .agg(
            n.alias("ticket_count"),
            c.rounded(F.avg("sentiment"), 3).alias("avg_sentiment"),
            c.rounded(c.percent(F.count_if(F.col("urgency") == "critical"), n), 1).alias("critical_pct"),
        )
        .orderBy(F.desc("ticket_count"), "issue_type")
    )


def insights(summaries: DataFrame) -> DataFrame:
    return summaries.orderBy("id").select("id", c.title(F.col("topic")).alias("topic"), "summary")


def write_sections(sections: dict[str, DataFrame], folder: str, fmt: str = "json") -> None:
    """One folder per section, as JSON lines or as CSV with a header."""
    options = {"json": {}, "csv": {"header": True, "escape": '"'}}[fmt]
    for name, df in sections.items():
        df.write.mode("overwrite").options(**options).format(fmt).save(f"{folder}/{name}")
