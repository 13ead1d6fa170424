"""Daily series and stored forecasts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c


def daily_history(tx: DataFrame, as_of: date | None = None, days: int = 60) -> DataFrame:
    """Per day; all days without ``as_of``. Revenue of Success rows, NULL when none."""
    if as_of is not None:
        tx = c.trailing(tx, as_of, days)
    return (
        tx.groupBy(c.day().alias("date"))
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            c.rounded(c.sum_where(c.success(), "amount")).alias("revenue"),
            F.count_if(c.failed()).alias("failed"),
            F.count_if(c.fraud()).alias("fraud"),
        )
        .orderBy("date")
    )


def forecast_read(forecasts: DataFrame, metric: str) -> DataFrame:
    return (
        forecasts.where(F.col("metric_name") == F.lit(metric))
        .select("forecast_date", "forecast_value", "lower_bound", "upper_bound")
        .orderBy("forecast_date")
    )


def history_plus_forecast(history: DataFrame, forecasts: DataFrame) -> DataFrame:
    """(metric, ds, y, kind): the daily history continued by the forecast."""
    past = [
        history.select(
            F.lit(metric).alias("metric"), F.col("date").alias("ds"),
            F.col(metric).cast("double").alias("y"), F.lit("history").alias("kind"),
        )
        for metric in ("transactions", "revenue")
    ]
    ahead = forecasts.select(
        F.col("metric_name").alias("metric"), F.col("forecast_date").alias("ds"),
        F.col("forecast_value").alias("y"), F.lit("forecast").alias("kind"),
    )
    return past[0].unionByName(past[1]).unionByName(ahead)
