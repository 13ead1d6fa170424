"""Fraud totals, breakdowns, alerts and the comparison with a model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.operators import paging
from tillscope.operators.star import star
from tillscope.plans import views


def totals(tx: DataFrame) -> DataFrame:
    hit, lost = F.count_if(c.fraud()), c.sum_where(c.fraud(), "amount")
    return tx.agg(
        hit.alias("fraud_transactions"),
        c.rounded(c.or_zero(lost)).alias("fraud_amount"),
        c.rounded(c.percent(hit, F.count(F.lit(1)))).alias("fraud_rate"),
        c.rounded(c.percent(lost, c.money_sum("amount"))).alias("fraud_amount_pct"),
    )


def risk_distribution(tx: DataFrame) -> DataFrame:
    return tx.agg(
        *[
            F.count_if(F.col("risk_level") == level).alias(level.lower())
            for level in ("High", "Medium", "Low")
        ]
    )


def _fraud_by(tx: DataFrame, key) -> DataFrame:
    return tx.where(c.fraud()).groupBy(key).agg(
        F.count(F.lit(1)).alias("fraud_count"),
        c.rounded(c.money_sum("amount")).alias("fraud_amount"),
    )


def by_hour(tx: DataFrame) -> DataFrame:
    return _fraud_by(tx, "transaction_hour").orderBy("transaction_hour")


def by_category(tx: DataFrame) -> DataFrame:
    return _fraud_by(tx, "category").orderBy(F.desc("fraud_count"), "category")


def daily(tx: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return _fraud_by(c.trailing(tx, as_of, days), c.day().alias("date")).orderBy("date")


def alerts(
    tx: DataFrame, customers: DataFrame, merchants: DataFrame, *,
    risk_level=None, date_from=None, date_to=None,
) -> DataFrame:
    tx = paging.where_equal(tx, risk_level=risk_level)
    tx = c.in_range(tx, since=date_from or None, until=date_to or None)
    return views.fraud_alerts(tx, customers, merchants)


def _alerted(tx: DataFrame, risk_level=None, date_from=None, date_to=None) -> DataFrame:
    """The facts behind the alerts; a known key always has its dimension row."""
    return c.in_range(
        paging.where_equal(tx, risk_level=risk_level), since=date_from or None, until=date_to or None
    ).where(c.fraud() & F.col("customer_id").isNotNull() & F.col("merchant_id").isNotNull())


def alerts_page(
    tx: DataFrame, customers: DataFrame, merchants: DataFrame, *,
    page: int = 1, limit: int = 25, risk_level=None, date_from=None, date_to=None,
) -> DataFrame:
    """Newest first. The page is cut on the fact alone, then enriched."""
    kept = _alerted(tx, risk_level, date_from, date_to)
    cut = paging.far_page(kept, "timestamp", "transaction_id", page, limit)
    order = paging.page_order("timestamp", True, "transaction_id")
    return views.fraud_alerts(cut, customers, merchants).orderBy(*order)


def alerts_total(tx: DataFrame, customers: DataFrame, merchants: DataFrame, **filters) -> DataFrame:
    return paging.total_of(_alerted(tx, **filters))


def ml_predictions_page(
    predictions: DataFrame, tx: DataFrame, customers: DataFrame, merchants: DataFrame, *,
    page: int = 1, limit: int = 25,
) -> DataFrame:
    """Flagged rows, highest score first, with transaction and names."""
    flagged = predictions.where("model_prediction = 1")
    # Every prediction has its transaction, so the page can be cut first.
    cut = paging.far_page(flagged, "model_score", "transaction_id", page, limit)
    order = paging.page_order("model_score", True, "transaction_id")
    facts = tx.select(
        "transaction_id", "customer_id", "merchant_id", "amount", "timestamp", "status", "risk_level"
    )
    return (
        star(cut.join(facts, "transaction_id"), customers, merchants, ["customer_name"], ["merchant_name"])
        .drop("customer_id", "merchant_id")
        .orderBy(*order)
    )


def ml_predictions_total(predictions: DataFrame) -> DataFrame:
    return paging.total_of(predictions.where("model_prediction = 1"))


def flagged_share(predictions: DataFrame) -> DataFrame:
    """How many rows the model flags, and their percentage."""
    n, hit = F.count(F.lit(1)), F.count_if(F.col("model_prediction") == 1)
    return predictions.agg(
        n.alias("total"), hit.alias("flagged"), c.rounded(c.percent(hit, n)).alias("flagged_pct")
    )


def _matched(tx: DataFrame, predictions: DataFrame) -> DataFrame:
    return tx.select("transaction_id", "is_fraud").join(
        predictions.select("transaction_id", "model_prediction"), "transaction_id"
    )


def ml_comparison(tx: DataFrame, predictions: DataFrame) -> DataFrame:
    """2 x 2 counts of rule label against model label."""
    return judged_comparison(_matched(tx, predictions))


def judged_comparison(judged: DataFrame) -> DataFrame:
    """The same of rows that carry both labels, is_fraud and model_prediction."""
    rule, model = F.col("is_fraud"), F.col("model_prediction")
    return judged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if((rule == 1) & (model == 1)).alias("both_flagged"),
        F.count_if((rule == 1) & (model == 0)).alias("heuristic_only"),
        F.count_if((rule == 0) & (model == 1)).alias("ml_only"),
        F.count_if((rule == 0) & (model == 0)).alias("neither"),
    )


def agreement(tx: DataFrame, predictions: DataFrame) -> DataFrame:
    """Percent of rows on which rule and model agree."""
    return judged_agreement(_matched(tx, predictions))


def judged_agreement(judged: DataFrame) -> DataFrame:
    """The same of rows that carry both labels."""
    same = F.count_if(F.col("is_fraud") == F.col("model_prediction"))
    return judged.agg(
        F.count(F.lit(1)).alias("total"),
        same.alias("agreed"),
        c.rounded(c.percent(same, F.count(F.lit(1)))).alias("agreement_pct"),
    )
