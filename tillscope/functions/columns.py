"""Column helpers shared by the plans. All stay inside the JVM."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fraud() -> Column:
    return F.col("is_fraud") == 1


def success() -> Column:
    return F.col("status") == "Success"


def failed() -> Column:
    return F.col("status") == "Failed"


def refunded() -> Column:
    return F.col("status") == "Refunded"


def rounded(x: Column, places: int = 2) -> Column:
    """Half-away rounding that ignores float noise.

    A double sum depends on the order of its terms in the last digits, and so
    on the partitioning; going through a decimal first keeps that noise from
    flipping a tie. Non-finite input gives NULL.
    """
    return F.round(x.try_cast("decimal(30,8)"), places).cast("double")


def _cents(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).try_cast("decimal(18,2)")


def money_sum(x: Column | str) -> Column:
    """Sum of amounts with two decimals, exact and so the same for every order of the rows."""
    return F.sum(_cents(x))


def money_avg(x: Column | str) -> Column:
    """Mean of amounts from their exact sum."""
    return F.try_divide(money_sum(x).cast("double"), F.count(_cents(x)))


def sum_where(condition: Column, x: Column | str) -> Column:
    return money_sum(F.when(condition, F.col(x) if isinstance(x, str) else x))


def avg_where(condition: Column, x: Column | str) -> Column:
    return money_avg(F.when(condition, F.col(x) if isinstance(x, str) else x))


def or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent; 0 when there is nothing to divide by."""
    return or_zero(F.try_divide(part * 100.0, whole))


def day(ts: str = "timestamp") -> Column:
    return F.to_date(F.col(ts))


def month(ts: str = "timestamp") -> Column:
    return F.trunc(F.to_date(F.col(ts)), "month")


def weekend(ts: Column) -> Column:
    """1 on Saturday and Sunday."""
    return F.when(F.dayofweek(ts).isin(1, 7), 1).otherwise(0)


def distance() -> Column:
    """Euclidean distance between the customer's and the merchant's place."""
    dx = F.col("x_customer_id") - F.col("x_merchant_id")
    dy = F.col("y_customer_id") - F.col("y_merchant_id")
    return F.sqrt(dx * dx + dy * dy)


def label3(polarity: Column) -> Column:
    """positive above 0.1, negative below -0.1, else neutral (also NULL, NaN)."""
    known = ~F.isnan(polarity)
    return (
        F.when(known & (polarity > 0.1), "positive")
        .when(known & (polarity < -0.1), "negative")
        .otherwise("neutral")
    )


def title(label: Column) -> Column:
    return F.initcap(F.replace(label, F.lit("_"), F.lit(" ")))


def signed(x: Column, places: int) -> Column:
    """Number with its sign always shown."""
    return F.format_string(f"%+.{places}f", x)


# ---------------------------------------------------------------- time ranges
def _instant(value: date | datetime | str) -> datetime:
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip())
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value


def ntz(value: date | datetime | str) -> Column:
    """A literal that compares with a zone-less timestamp. A bare date is its midnight."""
    return F.lit(_instant(value).isoformat(sep=" ")).cast("timestamp_ntz")


def in_range(
    df: DataFrame,
    since: date | datetime | str | None = None,
    until: date | datetime | str | None = None,
    before: date | datetime | str | None = None,
) -> DataFrame:
    """Keep since <= timestamp <= until, and timestamp < before.

    On a table laid out by month the same bounds are put on the month, which
    the optimizer cannot derive, so that only those folders are read.
    """
    monthly = "txn_month" in df.columns
    ts = F.col("timestamp")
    if since is not None:
        df = df.where(ts >= ntz(since))
        if monthly:
            df = df.where(F.col("txn_month") >= F.lit(_instant(since).date().replace(day=1)))
    for bound, keep in ((until, ts.__le__), (before, ts.__lt__)):
        if bound is not None:
            df = df.where(keep(ntz(bound)))
            if monthly:
                df = df.where(F.col("txn_month") <= F.lit(_instant(bound).date().replace(day=1)))
    return df


def trailing(df: DataFrame, as_of: date, days: int) -> DataFrame:
    """The ``days`` days before ``as_of`` and ``as_of`` itself."""
    return in_range(df, since=as_of - timedelta(days=days), before=as_of + timedelta(days=1))
