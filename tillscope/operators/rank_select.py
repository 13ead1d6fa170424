"""The k-th smallest value of a column, exactly, without a global sort.

The value is narrowed down by its leading bytes: each round counts the rows
per next two bytes of the candidates (at most 65,536 counts, combined before
the shuffle), picks the bucket that holds rank k, and goes on inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = 4  # hex digits per round: two bytes


def text_key(x: Column) -> Column:
    """Hex text that sorts as the string does."""
    return F.hex(F.encode(x, "utf-8"))


def whole_key(x: Column) -> Column:
    """Hex text that sorts as the non-negative whole number does."""
    return F.lpad(F.hex(x.cast("bigint")), 16, "0")


def kth_smallest_key(df: DataFrame, key: Column, k: int) -> str:
    """Key of rank k (from 1) among the rows of ``df``."""
    keys = df.select(key.alias("k")).where(F.col("k").isNotNull())
    prefix, rank = "", k
    while True:
        width = len(prefix) + _DIGITS
        here = keys.where(F.col("k").startswith(prefix)) if prefix else keys
        counts = (
            here.groupBy(F.substring("k", 1, width).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        below = 0
        for row in sorted(counts, key=lambda r: r.bucket):
            if below + row.n >= rank:
                break
            below += row.n
        else:
            raise ValueError(f"rank {k} is beyond the number of rows")
        prefix, rank = row.bucket, rank - below
        if len(prefix) < width:
            return prefix  # all candidates are this one value
