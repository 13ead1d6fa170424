"""Name -> query over a lakehouse. Every query covers its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope import schemas
from tillscope.functions import columns as c
from tillscope.lakehouse import Lakehouse
from tillscope.models import evaluate, features, forecast, iforest, supervised
from tillscope.models import segments as clusters
from tillscope.operators import pair_months, quality
from tillscope.operators.cleanse import null_orphans
from tillscope.plans import (
    customers,
    executive,
    fraud,
    gold,
    insights,
    merchants,
    outlook,
    report,
    silver,
    transactions,
    views,
)
from tillscope.plans import forecast as series
from tillscope.sources.csv import read_csv, split_corrupt, write_csv
from tillscope.sources.lake import scratch_path, stage
from tillscope.text import induced, phrases, sentiment, tickets

Query = Callable[[Lakehouse], DataFrame]
QUERIES: dict[str, Query] = {}

# Segment thresholds that fit the amounts of the given tables.
CUTS = customers.SegmentCuts(
    spend=2_000_000, spend_txns=36, frequent_txns=36, dormant_days=90, luxury_value=58_000, diverse_merchants=26
)
PAGE_FILTERS = {"status": "Success", "risk_level": "High", "date_from": "1996-01-01", "date_to": "2001-06-30"}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _silver(name: str, columns: list[str] | None = None) -> None:
    def run(lh: Lakehouse) -> DataFrame:
        df = getattr(lh, name)
        return df.select(*columns) if columns else df

    QUERIES[f"silver_{name}"] = run


def _on_transactions(name: str, plan: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda lh: plan(lh.transactions)


# -------------------------------------------------------------- bronze, silver
for _name in ("customers", "merchants", "transactions", "reviews", "tickets"):
    _silver(_name)


@query
def bronze_csv_scan(lh: Lakehouse) -> DataFrame:
    """The raw transactions written as CSV and read back with the fixed schema."""
    path = scratch_path(lh.spark, "bronze-transactions-csv")
    names = lh.bronze.transactions.columns
    write_csv(lh.bronze.transactions, path)
    schema = type(schemas.TRANSACTIONS)([schemas.TRANSACTIONS[name] for name in names])
    return split_corrupt(stage(read_csv(lh.spark, path, schema), "bronze-transactions"))[0]


@query
def quality_report(lh: Lakehouse) -> DataFrame:
    return quality.quality_report(lh.bronze)


@query
def load_report(lh: Lakehouse) -> DataFrame:
    return quality.load_report(
        {"customers": lh.customers, "merchants": lh.merchants, "transactions": lh.transactions}
    )


# ------------------------------------------------------------------------ gold
_on_transactions("daily_revenue", gold.daily_revenue)
_on_transactions("merchant_kpis", gold.merchant_kpis)
_on_transactions("payment_trends", gold.payment_trends)
_on_transactions("fraud_summary", gold.fraud_summary)
_on_transactions("customer_spend", gold.customer_spend)
_on_transactions("agg_daily_revenue", gold.agg_daily_revenue)
_on_transactions("agg_fraud_summary", gold.agg_fraud_summary)
_on_transactions("agg_payment_trends", gold.agg_payment_trends)


@query
def support_metrics(lh):
    return gold.support_metrics(lh.tickets)


@query
def agg_support_metrics(lh):
    return gold.agg_support_metrics(lh.tickets)


@query
def agg_merchant_kpis(lh):
    return gold.agg_merchant_kpis(lh.transactions, lh.merchants, lh.as_of)


@query
def agg_customer_segments(lh):
    return gold.agg_customer_segments(customer_segments_heuristic(lh))


# ----------------------------------------------------------------------- views
@query
def v_fraud_alerts(lh):
    return views.fraud_alerts(lh.transactions, lh.customers, lh.merchants)


@query
def v_merchant_performance(lh):
    return views.merchant_performance(lh.transactions, lh.merchants)


@query
def v_customer_summary(lh):
    return views.customer_summary(lh.transactions, lh.customers)


# ------------------------------------------------------------------- executive
@query
def executive_kpis(lh):
    return executive.executive_kpis(lh.transactions, lh.customers, lh.merchants)


@query
def executive_today(lh):
    return executive.executive_today(lh.transactions, lh.as_of)


@query
def executive_daily_trend(lh):
    return executive.daily_trend(lh.transactions, lh.as_of)


@query
def kpi_cards(lh):
    return executive.kpi_cards(executive_kpis(lh))


_on_transactions("payment_distribution", executive.payment_distribution)
_on_transactions("category_distribution", executive.category_distribution)


# ---------------------------------------------------------------- transactions
@query
def transactions_page(lh):
    return transactions.page(
        lh.transactions, lh.customers, lh.merchants, page=2, limit=50, sort_by="amount", **PAGE_FILTERS
    )


@query
def transactions_far_page(lh):
    """A page far behind the start, cheapest first."""
    return transactions.page(
        lh.transactions, lh.customers, lh.merchants, page=300, limit=100, sort_by="amount", sort_order="asc"
    )


@query
def transactions_status_page(lh):
    """A far page sorted by a column of few values."""
    return transactions.page(
        lh.transactions, lh.customers, lh.merchants, page=120, limit=100, sort_by="status", sort_order="desc"
    )


@query
def transactions_latest_page(lh):
    """Newest first, from the months that the stored counts name."""
    return transactions.page(
        lh.transactions, lh.customers, lh.merchants, page=40, limit=50, index=lh.transaction_counts,
        status="Success", risk_level="High",
    )


@query
def transactions_counted_total(lh):
    """The total behind that page, from the stored counts alone."""
    return transactions.page_total(
        lh.transactions, index=lh.transaction_counts, status="Success", risk_level="High"
    )


@query
def transactions_page_total(lh):
    return transactions.page_total(lh.transactions, **PAGE_FILTERS)


@query
def transaction_get(lh):
    """The transactions the reviews name, in one bulk lookup."""
    return transactions.get_many(lh.transactions, lh.customers, lh.merchants, lh.reviews)


_on_transactions("transaction_stats", transactions.stats)


# ------------------------------------------------------------------- merchants
@query
def merchants_page(lh):
    return merchants.page(lh.transactions, lh.merchants, limit=25, status="Active", search="supplier")


@query
def merchants_page_total(lh):
    return merchants.page_total(lh.merchants, status="Active", search="supplier")


@query
def merchant_daily(lh):
    return merchants.daily(lh.transactions, lh.as_of)


@query
def merchant_profile(lh):
    """All profiles, one row per merchant and trailing day."""
    nested = merchants.profile(lh.transactions, lh.merchants, lh.as_of)
    return nested.select(
        "merchant_id", "merchant_name", "category", "status", "risk_score", "avg_transaction_value",
        "total_txns", "revenue", "unique_customers", "fraud_pct", "refund_pct",
        F.explode_outer("daily_trend").alias("day"),
    ).select("*", "day.date", "day.transactions", "day.failed", "day.fraud", F.col("day.revenue").alias("day_revenue")).drop("day")


@query
def top_merchants(lh):
    return merchants.top(lh.transactions, lh.merchants, limit=10)


# ------------------------------------------------------------------- customers
@query
def customers_page(lh):
    return customers.page(lh.transactions, lh.customers, page=2, limit=25, search="customer#")


@query
def customers_page_total(lh):
    return customers.page_total(lh.customers, search="customer#")


@query
def customer_recent(lh):
    return customers.recent(lh.transactions, lh.merchants).select(
        "customer_id", "position", "transaction_id", "timestamp", "amount", "status", "merchant_name"
    )


_on_transactions("customer_monthly", customers.monthly)


@query
def customer_profile(lh):
    """All profiles, one row per customer and month."""
    nested = customers.profile(lh.transactions, lh.customers, lh.merchants)
    return nested.select(
        "customer_id", "customer_name", "email", "total_txns", "total_spend", "avg_txn_value", "last_txn",
        "unique_merchants", "fraud_txn_count",
        F.size("recent_transactions").alias("n_recent"),
        F.explode_outer("monthly_spend").alias("m"),
    ).select("*", "m.month", "m.transactions", "m.spend", "m.fraud_count").drop("m")


@query
def customer_segments_heuristic(lh):
    summary = views.customer_summary(lh.transactions, lh.customers)
    return customers.segments_heuristic(summary, lh.as_of, CUTS)


# ----------------------------------------------------------------------- fraud
_on_transactions("fraud_totals", fraud.totals)
_on_transactions("risk_distribution", fraud.risk_distribution)
_on_transactions("fraud_by_hour", fraud.by_hour)
_on_transactions("fraud_by_category", fraud.by_category)


@query
def fraud_daily(lh):
    return fraud.daily(lh.transactions, lh.as_of, days=90)


@query
def fraud_alerts_page(lh):
    return fraud.alerts_page(
        lh.transactions, lh.customers, lh.merchants, risk_level="High", date_from="1997-01-01", limit=50
    )


@query
def fraud_alerts_total(lh):
    return fraud.alerts_total(
        lh.transactions, lh.customers, lh.merchants, risk_level="High", date_from="1997-01-01"
    )


@query
def fraud_rules(lh):
    return lh.transactions.select(
        "transaction_id", "fraud_points", "fraud_score", "risk_level", "customer_merchant_distance"
    )


@query
def fraud_top_fraction(lh):
    return lh.transactions.where(c.fraud()).select("transaction_id", "fraud_points")


def _stand_in(lh: Lakehouse) -> DataFrame:
    """A prediction that SQL can repeat: far away at night."""
    far = (F.col("customer_merchant_distance") > 75) & (F.col("txn_hour") <= 4)
    return lh.transactions.select(
        "transaction_id",
        F.when(far, 1).otherwise(0).alias("model_prediction"),
        F.col("customer_merchant_distance").alias("model_score"),
    )


def _rule_segments(lh: Lakehouse) -> DataFrame:
    """Customers under their rule-based segment, in the shape of the clusters."""
    made = clusters.segment_features(lh.customer_summary, lh.as_of)
    return made.withColumn("segment_name", customers.segment_of(CUTS, lh.as_of))


@query
def flagged_page(lh):
    """The page of flagged rows over the repeatable prediction."""
    return fraud.ml_predictions_page(_stand_in(lh), lh.transactions, lh.customers, lh.merchants)


@query
def flagged_total(lh):
    return fraud.ml_predictions_total(_stand_in(lh))


@query
def segment_profile(lh):
    """Segment averages over the rule-based segments."""
    return customers.segments_ml(_rule_segments(lh))


@query
def report_rule_segments(lh):
    return report.segments(_rule_segments(lh))


@query
def fraud_ml_comparison(lh):
    return fraud.ml_comparison(lh.transactions, _stand_in(lh))


@query
def fraud_flagged_share(lh):
    return fraud.flagged_share(_stand_in(lh))


@query
def fraud_agreement(lh):
    return fraud.agreement(lh.transactions, _stand_in(lh))


# ---------------------------------------------------------------------- models
@query
def fraud_features(lh):
    names = features.FRAUD_FEATURES
    return lh.features.select("transaction_id", *[c.rounded(F.col(x), 4).alias(x) for x in names])


@query
def category_codes(lh):
    return features.category_codes(lh.transactions, features.CATEGORICAL)


@query
def scale_moments(lh):
    return features.moments(lh.features, features.FRAUD_FEATURES).select(
        "feature", c.rounded(F.col("mean"), 4).alias("mean"), c.rounded(F.col("std"), 4).alias("std")
    )


@query
def standard_scale(lh):
    scaled = features.standard_scale(lh.features, features.FRAUD_FEATURES)
    return scaled.select("transaction_id", *[c.rounded(F.col(x), 3).alias(x) for x in features.FRAUD_FEATURES])


@query
def isolation_forest(lh):
    return lh.predictions.drop("created_at")


@query
def ml_predictions_page(lh):
    # The page needs no label and no months, so the scored rows do.
    return fraud.ml_predictions_page(lh.predictions, lh.scored, lh.customers, lh.merchants)


@query
def ml_fraud_comparison(lh):
    return fraud.judged_comparison(lh.judged)


@query
def customer_features(lh):
    made = clusters.segment_features(lh.customer_summary, lh.as_of)
    return made.select(
        "customer_id", "days_since_last_txn", c.rounded(F.col("spend_per_merchant"), 4).alias("spend_per_merchant")
    )


@query
def customer_kmeans(lh):
    return lh.segments.select("customer_id", "segment_id", "segment_name", "total_spend")


@query
def segment_naming(lh):
    return lh.segments.groupBy("segment_id", "segment_name").agg(
        c.rounded(F.avg("total_spend")).alias("mean_spend"), F.count(F.lit(1)).alias("customer_count")
    )


@query
def customer_segments_ml(lh):
    return customers.segments_ml(lh.segments)


@query
def daily_history(lh):
    return series.daily_history(lh.transactions)


@query
def daily_history_60(lh):
    return series.daily_history(lh.transactions, lh.as_of, 60)


@query
def forecast_gram(lh):
    return forecast.gram_ratios(forecast.gram(forecast.lagged_differences(lh.daily_series)))


@query
def forecast_ar(lh):
    return lh.forecasts.drop("created_at")


@query
def forecast_read(lh):
    return series.forecast_read(lh.forecasts, "revenue")


def _lag1(lh):
    """The forecast with one lag, whose likelihood has its only peak where SQL can find it."""
    made = forecast.forecast(lh.daily_series, lags=1).drop("created_at")
    return made.withColumns({x: c.rounded(F.col(x)) for x in ("forecast_value", "lower_bound", "upper_bound")})


@query
def forecast_lag1(lh):
    return _lag1(lh)


@query
def forecast_lag1_read(lh):
    return series.forecast_read(_lag1(lh), "revenue")


@query
def forecast_lag1_union(lh):
    return series.history_plus_forecast(series.daily_history(lh.transactions), _lag1(lh))


@query
def history_plus_forecast(lh):
    return series.history_plus_forecast(series.daily_history(lh.transactions), lh.forecasts)


# ------------------------------------------------------------------------ text
@query
def review_sentiment(lh):
    return lh.review_sentiment


@query
def merchant_sentiment(lh):
    return sentiment.merchant_sentiment(lh.review_sentiment)


@query
def merchant_sentiment_page(lh):
    return merchants.sentiment_page(lh.merchant_sentiment, lh.merchants)


@query
def sentiment_extremes(lh):
    return merchants.sentiment_extremes(lh.merchant_sentiment)


@query
def sentiment_counts(lh):
    return sentiment.value_counts(lh.review_sentiment, "sentiment")


@query
def ticket_urgency(lh):
    return tickets.ticket_urgency(lh.tickets)


@query
def ticket_topics(lh):
    return tickets.ticket_topics(lh.tickets)


@query
def ticket_keywords(lh):
    return tickets.ticket_keywords(lh.tickets)


@query
def ticket_nlp(lh):
    return lh.ticket_nlp


@query
def urgency_counts(lh):
    return sentiment.value_counts(lh.ticket_nlp, "urgency")


# -------------------------------------------------------------------- insights
_on_transactions("insight_kpis", insights.kpis)
_on_transactions("insight_top_payment", insights.top_payment)
_on_transactions("insight_refund_rate", insights.refund_rate)


@query
def insight_top_category(lh):
    return insights.top_category(lh.transactions, lh.as_of)


@query
def insight_weekend_lift(lh):
    return insights.weekend_lift(lh.transactions, lh.as_of)


@query
def insight_sentiment(lh):
    return insights.sentiment(lh.merchant_sentiment)


@query
def insight_top_segment(lh):
    """Top of the rule-based segments."""
    return insights.top_segment(customer_segments_heuristic(lh), "segment")


def _summaries(lh: Lakehouse) -> DataFrame:
    return insights.executive_summaries(
        lh.transactions,
        lh.as_of,
        fraud.judged_agreement(lh.judged),
        lh.merchant_sentiment,
        customers.segments_ml(lh.segments),
    )


@query
def executive_summaries(lh):
    return _summaries(lh)


@query
def executive_summaries_rules(lh):
    """The paragraphs over the repeatable prediction and the rule-based segments."""
    return insights.executive_summaries(
        lh.transactions,
        lh.as_of,
        fraud.agreement(lh.transactions, _stand_in(lh)),
        lh.merchant_sentiment,
        customers.segments_ml(_rule_segments(lh)),
    )


# ---------------------------------------------------------------------- report
_on_transactions("report_kpis", report.kpis)
_on_transactions("report_kpi_cards", lambda tx: report.kpi_cards(report.kpis(tx)))


@query
def report_merchants(lh):
    return report.top_merchants(views.merchant_performance(lh.transactions, lh.merchants))


@query
def report_segments(lh):
    return report.segments(lh.segments)


@query
def report_tickets(lh):
    return report.tickets(lh.ticket_nlp)


@query
def report_insights(lh):
    return report.insights(_summaries(lh))


# --------------------------------------------------------------------- outlook
_on_transactions("merchant_growth", outlook.merchant_growth)
_on_transactions("rapid_repeat_payments", outlook.rapid_repeat_payments)
_on_transactions("repeat_transactions", outlook.repeat_transactions)
_on_transactions("hour_weekday_heatmap", outlook.hour_weekday_heatmap)
_on_transactions("regional_summary", outlook.regional_summary)
_on_transactions("unusual_customers", outlook.unusual_customers)
_on_transactions("outlier_treatment", outlook.outlier_treatment)


@query
def high_risk_merchants(lh):
    return outlook.high_risk_merchants(lh.transactions, z=1.5)


@query
def revenue_contribution(lh):
    return outlook.revenue_contribution(lh.transactions, lh.merchants)


@query
def churn_risk_merchants(lh):
    return outlook.churn_risk_merchants(lh.transactions, lh.merchants, lh.as_of)


@query
def merchant_percentiles(lh):
    return gold.merchant_percentiles(stage(views.merchant_rates(lh.transactions, lh.merchants), "merchant-rates"))


@query
def refreshed_merchants(lh):
    """Merchant figures from stored counts after a refresh of the months that had other rows before."""
    return pair_months.merchants(lh.refreshed_pairs)


@query
def refreshed_customers(lh):
    return pair_months.customers(lh.refreshed_pairs)


@query
def geo_mismatch(lh):
    return outlook.geo_mismatch(lh.transactions, lh.customers)


@query
def category_forecast(lh):
    return forecast.forecast(forecast.daily_series(lh.transactions, "category")).drop("created_at")


# ------------------------------------------------------- texts of the given tables
@query
def document_sentiment(lh):
    return sentiment.text_sentiment(lh.given("documents"), ["doc_id"])


@query
def document_rules(lh):
    return tickets.text_rules(lh.given("documents"), ["doc_id"])


@query
def ticket_phrases(lh):
    return phrases.rounded(lh.ticket_phrases)


@query
def ticket_ranked_keywords(lh):
    return phrases.keywords(lh.tickets, "ticket_id", lh.ticket_phrases, "description")


@query
def document_phrases(lh):
    return phrases.rounded(lh.document_phrases)


@query
def document_ranked_keywords(lh):
    return phrases.keywords(lh.given("documents"), "doc_id", lh.document_phrases, longest=3)


@query
def quality_lexicon(lh):
    return lh.quality_lexicon.withColumn("weight", c.rounded(F.col("weight"), 6))


@query
def document_quality_sentiment(lh):
    return induced.score(lh.given("documents"), "doc_id", lh.quality_lexicon, lh.quality_midpoint)


@query
def quality_sentiment_agreement(lh):
    """Held-out documents: how often the score's sign agrees with the label."""
    held_out = lh.given("labels").where("doc_id % 5 = 0")
    asked = lh.given("documents").join(held_out.select("doc_id"), "doc_id", "left_semi")
    scored = induced.score(asked, "doc_id", lh.quality_lexicon, lh.quality_midpoint)
    return induced.agreement(scored, held_out, "doc_id", F.col("quality") == 1)


@query
def conversation_sentiment(lh):
    return sentiment.text_sentiment(lh.given("conversations"), ["conv_id", "turn", "role"])


@query
def conversation_rules(lh):
    return tickets.text_rules(lh.given("conversations"), ["conv_id", "turn"])


@query
def role_sentiment(lh):
    scored = sentiment.text_sentiment(lh.given("conversations"), ["role"])
    return scored.groupBy("role", "sentiment").agg(
        F.count(F.lit(1)).alias("n"), c.rounded(F.avg("polarity"), 4).alias("avg_polarity")
    )


@query
def document_terms(lh):
    return supervised.terms(lh.given("documents"))


@query
def topic_model(lh):
    return supervised.topic_model(lh.given("documents"))


@query
def complaint_classifier(lh):
    return supervised.text_classifier(lh.given("documents"), lh.given("labels"), "toxic")


@query
def complaint_split(lh):
    return supervised.split_counts(lh.given("labels"), "doc_id", "toxic")


# --------------------------------------------------------------- supervised fraud
@query
def supervised_fraud(lh):
    return supervised.supervised_fraud(lh.features, lh.transactions, features.FRAUD_FEATURES)


@query
def supervised_fraud_split(lh):
    return supervised.split_counts(lh.transactions, "transaction_id", "is_fraud")


@query
def supervised_fraud_confusion(lh):
    """The confusion table over a repeatable prediction: a risk level of High."""
    rule = lh.transactions.select(
        supervised.held_out("transaction_id").alias("held_out"), F.col("is_fraud").alias("label"),
        (F.col("risk_level") == "High").cast("int").alias("predicted"),
    )
    return supervised.confusion(rule)


def _given_scores(lh):
    """Rows with a repeatable score of many values and one of few, and the label."""
    return lh.transactions.select(
        supervised.held_out("transaction_id").alias("held_out"), F.col("is_fraud").alias("label"),
        F.col("amount").alias("probability"), (F.col("transaction_hour") / 100).alias("hour"),
    )


@query
def boosted_fraud(lh):
    return lh.boosted_fraud


@query
def boosted_fraud_quality(lh):
    """Ranking figures of the boosted trees on taught and held-out rows."""
    return evaluate.ranking(lh.boosted_fraud, ["held_out"])


@query
def ranking_given(lh):
    """Exact AUC and average precision of a given score, the amount."""
    return evaluate.ranking(_given_scores(lh), ["held_out"])


@query
def precision_recall_given(lh):
    """Precision and recall at every threshold of a given score."""
    at = evaluate.curve(_given_scores(lh), ["held_out"], "hour")
    return at.select(
        "held_out", "score", "tp", "fp", F.round(F.col("tp") / (F.col("tp") + F.col("fp")), 9).alias("precision"),
        F.round(F.try_divide("tp", "positives"), 9).alias("recall"),
    )


@query
def calibration_given(lh):
    """The calibration table of a given score, the hour."""
    return evaluate.calibration(_given_scores(lh), "hour").withColumn("calibrated", F.round("calibrated", 9))


@query
def issue_classifier(lh):
    """The issue type of every ticket from its description."""
    return supervised.class_classifier(lh.tickets, "issue_type", "ticket_id", "description")


@query
def role_classifier(lh):
    """Who speaks, for every turn of the conversations."""
    return lh.spoken_roles


@query
def role_confusion(lh):
    return lh.spoken_roles.groupBy("fold", "label", "predicted").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ single lookups
@query
def transaction_by_id(lh):
    return transactions.get(lh.transactions, lh.customers, lh.merchants, "TXN000000013")


@query
def merchant_by_id(lh):
    return merchants.directory(lh.transactions, lh.merchants).where("merchant_id = 'MER00001'")


@query
def customer_by_id(lh):
    return customers.recent(lh.transactions, lh.merchants, "CUST00001").select(
        "customer_id", "position", "transaction_id", "timestamp", "amount", "status", "merchant_name"
    )


# ----------------------------------------------------------------------- dirty rows
@query
def dirty_transactions(lh):
    """Cleansing of rows with copies, unknown keys, bad numbers and bad times, made from the given ones."""
    raw = lh.raw_transactions
    number = F.substring("transaction_id", 4, 40).cast("bigint")
    spoilt = raw.select(
        "transaction_id",
        F.when(number % 7 == 0, "CUST-none").otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(number % 11 == 0, None).otherwise(F.col("merchant_id")).alias("merchant_id"),
        F.when(number % 13 == 0, "n/a").otherwise(F.col("amount").cast("string")).alias("amount"),
        "payment_method",
        F.when(number % 17 == 0, "yesterday").otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        "status", "device_type",
    )
    again = spoilt.where(number % 5 == 0).withColumn("amount", F.lit(None).cast("string"))
    clean = silver.transactions(spoilt.unionByName(again))
    return clean.select(
        "transaction_id", "customer_id", "merchant_id", "amount", "payment_method", "timestamp", "status", "txn_hour"
    )


@query
def dirty_orphans(lh):
    """Unknown customers of the spoilt rows become NULL."""
    known = null_orphans(dirty_transactions(lh), lh.customers, "customer_id")
    return known.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("customer_id").isNull()).alias("orphans"),
        F.count_if(F.col("amount").isNull()).alias("no_amount"), F.count_if(F.col("timestamp").isNull()).alias("no_time"),
    )


# ------------------------------------------------ models over given nodes, centres, scores
#: A forest of two trees over amount (feature 0) and hour (feature 1).
NODES = [
    (0, 0, 0, 30000.0, 1, 2, 0.0), (0, 1, -1, 0.0, 1, 1, 2.0), (0, 2, 1, 11.5, 3, 4, 0.0),
    (0, 3, -1, 0.0, 3, 3, 3.5), (0, 4, -1, 0.0, 4, 4, 2.5),
    (1, 0, 1, 4.5, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, 1.0), (1, 2, -1, 0.0, 2, 2, 4.0),
]


def _forest_scores(lh):
    nodes = lh.spark.createDataFrame(NODES, iforest._NODES)
    return iforest.score(lh.features, nodes, ["amount", "transaction_hour"], "transaction_id", 256)


@query
def forest_scores_given(lh):
    """Anomaly scores by a forest given as a table."""
    return _forest_scores(lh).select("transaction_id", F.round("score", 9).alias("score"))


@query
def forest_threshold_given(lh):
    """The cut over a given score, and how many rows lie above it."""
    scores = lh.transactions.select((F.col("customer_merchant_distance") / 200).alias("score")).where("score > 0")
    cut = iforest.threshold(scores)
    return scores.agg(F.round(F.lit(cut), 9).alias("cut"), F.count_if(F.col("score") > cut).alias("flagged"))


@query
def segments_given_centres(lh):
    """Customers by the nearest of two given centres on unscaled spend in thousands."""
    points = lh.customer_summary.select(
        "customer_id", F.array(F.round(F.col("total_spend") / 1000).cast("bigint") * clusters.UNIT).alias("_point")
    )
    return clusters.assign(points, np.array([[500.0], [1500.0]]) * clusters.UNIT).drop("_point")


@query
def forecast_union_given(lh):
    """History joined with a forecast given as a table: the days 1 to 30 after the history, at 1000 each."""
    history = series.daily_history(lh.transactions)
    last = lh.transactions.agg(F.max(c.day()).alias("d"))
    day = F.explode(F.sequence(F.lit(1), F.lit(30))).alias("n")
    given = last.select("d", day).select(
        F.lit("revenue").alias("metric_name"), F.date_add("d", F.col("n")).alias("forecast_date"),
        F.lit(1000.0).alias("forecast_value"), F.lit(900.0).alias("lower_bound"), F.lit(1100.0).alias("upper_bound"),
        F.lit("given").alias("model_name"), F.current_timestamp().alias("created_at"),
    )
    return series.history_plus_forecast(history, given)
