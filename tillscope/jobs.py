"""Batch jobs: files in, tables out. Each reads and writes folders under a lake root.

bronze/<entity>, silver/<entity>, gold/<table>, warehouse/<table>, models/<table>.
Run order: ingest, cleanse, aggregate, load_warehouse, then the model jobs, then
the report.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope import schemas
from tillscope.functions import columns as c
from tillscope.models import forecast, iforest, segments
from tillscope.models.features import FRAUD_FEATURES, fraud_features
from tillscope.operators.cleanse import nan_to_null, null_orphans, with_defaults
from tillscope.plans import customers, fraud, gold, insights, report, silver, views
from tillscope.sources.csv import FILES, read_csv, read_entities, split_corrupt
from tillscope.sources.lake import read_table, replace_partition, stage, with_audit, write_table
from tillscope.tables import Tables
from tillscope.text import sentiment, tickets

# Warehouse table of each file, dimensions before the fact.
WAREHOUSE = {
    "customers": "dim_customers",
    "merchants": "dim_merchants",
    "transactions": "fact_transactions",
}
DEFAULTS = {"transactions": {"is_fraud": 0, "weekend_flag": 0}}


def ingest(spark: SparkSession, folder: str, lake: str) -> None:
    """The five CSV files as raw tables, malformed lines included."""
    for name, df in read_entities(spark, folder).items():
        write_table(df, f"{lake}/bronze/{name}")


def _layer(spark: SparkSession, lake: str, layer: str) -> Tables:
    return Tables(**{name: read_table(spark, f"{lake}/{layer}/{name}") for name in schemas.ENTITIES})


def cleanse(spark: SparkSession, lake: str) -> None:
    """Raw to cleansed tables; transactions are laid out by month, malformed lines set apart."""
    good = {}
    for name, df in _layer(spark, lake, "bronze").items():
        good[name], bad = split_corrupt(df)
        write_table(bad, f"{lake}/quarantine/{name}")
    for name, df in silver.silver(Tables(**good)).items():
        if name == "transactions":
            write_table(df.withColumn("txn_month", c.month()), f"{lake}/silver/{name}", "txn_month", "customer_id")
        else:
            write_table(df, f"{lake}/silver/{name}")


def gold_tables(tables: Tables) -> dict[str, DataFrame]:
    tx = tables.transactions
    return {
        "daily_revenue": gold.daily_revenue(tx),
        "merchant_kpis": gold.merchant_kpis(tx),
        "payment_trends": gold.payment_trends(tx),
        "fraud_summary": gold.fraud_summary(tx),
        "customer_segments": gold.customer_spend(tx),
        "support_metrics": gold.support_metrics(tables.tickets),
    }


def aggregate(spark: SparkSession, lake: str) -> None:
    """The six aggregate tables of the lakehouse."""
    for name, df in gold_tables(_layer(spark, lake, "silver")).items():
        write_table(df, f"{lake}/gold/{name}")


def aggregate_warehouse(spark: SparkSession, lake: str, as_of: date) -> None:
    """The six declared aggregate tables of the warehouse."""
    t = _layer(spark, lake, "silver")
    tx = t.transactions
    rule_segments = customers.segments_heuristic(views.customer_summary(tx, t.customers), as_of)
    made = {
        "agg_daily_revenue": gold.agg_daily_revenue(tx),
        "agg_merchant_kpis": gold.agg_merchant_kpis(tx, t.merchants, as_of),
        "agg_fraud_summary": gold.agg_fraud_summary(tx),
        "agg_customer_segments": gold.agg_customer_segments(rule_segments),
        "agg_payment_trends": gold.agg_payment_trends(tx),
        "agg_support_metrics": gold.agg_support_metrics(t.tickets),
    }
    for name, df in made.items():
        write_table(df, f"{lake}/warehouse/{name}")


def load_warehouse(spark: SparkSession, folder: str, lake: str) -> DataFrame:
    """Full refresh of the star schema from CSV files; (load_order, table_name, row_count).

    Declared columns in declared order, NaN as NULL, defaults filled, keys unknown to
    their dimension set to NULL. A missing or empty file keeps the old table and
    reports 0 rows.
    """
    loaded: dict[str, DataFrame] = {}
    report_rows = []
    for order, (name, table) in enumerate(WAREHOUSE.items(), 1):
        schema = schemas.ENTITIES[name]
        try:
            df = split_corrupt(stage(read_csv(spark, f"{folder}/{FILES[name]}", schema), name))[0]
            rows = df.count()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = 0
        if rows:
            df = nan_to_null(with_defaults(df.select(*schema.names), DEFAULTS.get(name, {})))
            for key, dimension in (("customer_id", "customers"), ("merchant_id", "merchants")):
                if name == "transactions" and dimension in loaded:
                    df = null_orphans(df, loaded[dimension], key)
            path = f"{lake}/warehouse/{table}"
            write_table(with_audit(df), path)
            loaded[name] = read_table(spark, path)
            rows = loaded[name].count()
        report_rows.append((order, table, rows))
    return spark.createDataFrame(report_rows, "load_order int, table_name string, row_count bigint")


# ------------------------------------------------------------------ model jobs
def score_fraud(tables: Tables, lake: str) -> None:
    made = stage(fraud_features(tables.transactions, tables.customers, tables.merchants), "fraud-features")
    write_table(iforest.isolation_forest(made, FRAUD_FEATURES), f"{lake}/models/ml_fraud_predictions")


def segment_customers(tables: Tables, lake: str, as_of: date, restarts: int = 10) -> None:
    summary = views.customer_summary(tables.transactions, tables.customers)
    features = stage(segments.segment_features(summary, as_of), "segment-input")
    named = segments.name_segments(segments.kmeans(features, restarts=restarts))
    wanted = ["customer_id", "segment_id", "segment_name", *segments.SEGMENT_FEATURES]
    write_table(with_audit(named.select(*wanted)), f"{lake}/models/ml_customer_segments")


def score_reviews(tables: Tables, lake: str) -> None:
    scored = stage(sentiment.review_sentiment(tables.reviews), "review-sentiment")
    write_table(with_audit(scored), f"{lake}/models/ml_review_sentiment")
    per_merchant = sentiment.merchant_sentiment(scored).withColumn("updated_at", F.current_timestamp())
    write_table(per_merchant, f"{lake}/models/ml_merchant_sentiment")


def tag_tickets(tables: Tables, lake: str) -> None:
    write_table(with_audit(tickets.ticket_nlp(tables.tickets)), f"{lake}/models/ml_support_ticket_nlp")


def forecast_daily(tables: Tables, lake: str) -> None:
    """Replaces the forecasts of the metrics it has; others stay."""
    made = forecast.forecast(forecast.daily_series(tables.transactions))
    replace_partition(made, f"{lake}/models/ml_forecasts", "metric_name")


def summarise(tables: Tables, lake: str, as_of: date) -> None:
    """The executive paragraphs, from the model tables written before."""
    spark = tables.transactions.sparkSession

    def model(name: str) -> DataFrame:
        return read_table(spark, f"{lake}/models/{name}")

    made = insights.executive_summaries(
        tables.transactions,
        as_of,
        fraud.agreement(tables.transactions, model("ml_fraud_predictions")),
        model("ml_merchant_sentiment"),
        customers.segments_ml(model("ml_customer_segments")),
    )
    write_table(with_audit(made), f"{lake}/models/ml_executive_summaries")


def write_report(tables: Tables, lake: str, folder: str, fmt: str = "json") -> None:
    """The report sections as JSON lines or CSV."""
    spark = tables.transactions.sparkSession

    def model(name: str) -> DataFrame:
        return read_table(spark, f"{lake}/models/{name}")

    report.write_sections(
        {
            "kpis": report.kpi_cards(report.kpis(tables.transactions)),
            "fraud": fraud.totals(tables.transactions),
            "insights": report.insights(model("ml_executive_summaries")),
            "merchants": report.top_merchants(views.merchant_performance(tables.transactions, tables.merchants)),
            "segments": report.segments(model("ml_customer_segments")),
            "tickets": report.tickets(model("ml_support_ticket_nlp")),
        },
        folder,
        fmt,
    )
