"""Filters, whitelisted sorting and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.operators import refine


def where_equal(df: DataFrame, **wanted: object) -> DataFrame:
    """AND of equalities. None and empty text mean no filter; 0 is a value."""
    for name, value in wanted.items():
        if value is not None and value != "":
            df = df.where(F.col(name) == F.lit(value))
    return df


def where_contains(df: DataFrame, column: str, text: str | None) -> DataFrame:
    """Case-insensitive search. % and _ in the text act as wildcards."""
    return df.where(F.col(column).ilike(f"%{text}%")) if text else df


def check_page(page: int, limit: int) -> None:
    if page < 1:
        raise ValueError("page starts at 1")
    check_limit(limit, 100)


def check_limit(limit: int, most: int) -> None:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be 1 to {most}")


def page_order(by: str, descending: bool, key: str) -> list[Column]:
    """NULL last, ties by the unique key, so that pages never overlap."""
    first = F.col(by)
    return [first.desc_nulls_last() if descending else first.asc_nulls_last(), F.col(key)]


NEAR = 1_000  # rows up to the end of a page that is a plain top-n
_STEPS = 4096  # buckets per doubling of a value


def _bucket(df: DataFrame, by: str) -> Column:
    """A whole number that never falls as the sort column rises; NULL has none.

    Numbers and times go by the logarithm of their size, at most about half a million
    buckets, text by its first three bytes.
    """
    kind = df.schema[by].dataType
    x = F.col(by)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(x, "utf-8"), 1, 3)), 6, "0"), 16, 10).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        x = F.unix_seconds(x.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        x = F.unix_date(x)
    x = x.cast("double")
    steps = F.floor(F.signum(x) * F.log2(F.least(F.abs(x), F.lit(1e300)) + 1) * _STEPS).cast("bigint")
    return F.when(F.isnan(x), 2**40).otherwise(steps)  # NaN sorts above all numbers


def page_of(df: DataFrame, by: str, key: str, page: int, limit: int, descending: bool = True) -> DataFrame:
    """One page of ``df``, sorted; nothing runs while it is built.

    A page near the start is a top-n, for which a task hands on ``NEAR`` rows at the most. For
    others rows are counted per bucket of the sort column, running sums of the counts tell
    which buckets hold the page (at most ``limit`` of them), and only their rows are ranked;
    ``far_page`` narrows down further where many rows share a bucket.
    """
    check_page(page, limit)
    offset = (page - 1) * limit
    order = page_order(by, descending, key)
    if offset + limit <= NEAR:
        return df.orderBy(*order).offset(offset).limit(limit)
    rows = df.withColumn("_bucket", _bucket(df, by))
    first = F.col("_bucket").desc_nulls_last() if descending else F.col("_bucket").asc_nulls_last()
    sums = Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    here = (
        rows.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(sums), F.lit(0)))
        .where((F.col("_before") < offset + limit) & (F.col("_before") + F.col("_n") > offset))
        .select(F.col("_bucket").alias("_held"), "_before")
    )
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return (
        rows.join(F.broadcast(here), F.col("_bucket").eqNullSafe(F.col("_held")))  # at most limit rows
        .withColumn("_place", place)
        .where((F.col("_place") > offset) & (F.col("_place") <= offset + limit))
        .select(*df.columns)
        .orderBy(*order)
    )


def far_page(df: DataFrame, by: str, key: str, page: int, limit: int, descending: bool = True) -> DataFrame:
    """The same page; for one far from the start, counting jobs run while it is built.

    They read ``df`` once and end with the keys of the page, by which its rows are fetched,
    so that file statistics and Bloom filters of the key apply.
    """
    check_page(page, limit)
    return rows_from(df, by, key, (page - 1) * limit, limit, descending)


def rows_from(df: DataFrame, by: str, key: str, offset: int, limit: int, descending: bool = True) -> DataFrame:
    """``limit`` rows after the first ``offset``, as ``far_page`` finds them."""
    order = page_order(by, descending, key)
    if offset + limit <= NEAR:
        return df.orderBy(*order).offset(offset).limit(limit)
    found = refine.keys_at(df, by, key, offset, limit, descending)
    return df.where(F.col(key).isin(found)).orderBy(*order)


def total_of(df: DataFrame) -> DataFrame:
    """Row count of the filtered set behind a page."""
    return df.agg(F.count(F.lit(1)).alias("total"))
