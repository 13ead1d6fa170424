"""Rows of given ranks in a large table, by counting in ever smaller intervals.

The sort values and keys of the table are written once, narrow. Each round counts the
rows per bucket of the interval that holds the wanted rank and goes on inside one bucket:
first by value, and once only one value is left, by key. It stops when a bounded number of rows
remains, and only these are sorted.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.operators.rank_select import text_key
from tillscope.sources.lake import stage

BUCKETS = 4096  # counts that a round brings to the driver; for texts at most 65,536
RANKED = 10_000  # rows that may be sorted in the end

#: Places of the values that are no common number.
_LOWEST, _COMMON, _HIGHEST, _NAN, _NULL = range(5)


@dataclass
class Interval:
    """Rows between two places of the order, with the number of rows before them."""

    before: int
    rows: int
    kind: int
    low: tuple = ()  # (first value[, first key])
    high: tuple = ()


def sort_keys(df: DataFrame, by: str, key: str, descending: bool) -> DataFrame:
    """``kind``, ``value``, ``key`` of every row. The order is that of kind, value (maybe falling), key."""
    x, data = F.col(by), df.schema[by].dataType
    place = F.lit(_COMMON)
    if isinstance(data, (T.TimestampType, T.TimestampNTZType)):
        x = F.unix_micros(x.cast("timestamp"))
    elif isinstance(data, T.DateType):
        x = F.unix_date(x).cast("long")
    elif isinstance(data, (T.DoubleType, T.FloatType)):
        x = x.cast("double")
        place = F.when(F.isnan(x), _NAN).when(x == float("inf"), _HIGHEST).when(x == float("-inf"), _LOWEST).otherwise(place)
        if descending:
            place = _NAN - place
    elif isinstance(data, T.DecimalType):
        x = x.cast(T.DecimalType(38, data.scale))
    elif not isinstance(data, T.StringType):
        x = x.cast("long")
    place = F.when(F.col(by).isNull(), _NULL).otherwise(place)
    common = _NAN - _COMMON if descending and isinstance(data, (T.DoubleType, T.FloatType)) else _COMMON
    return df.select(place.alias("kind"), F.when(place == common, x).alias("value"), F.col(key).alias("key"))


def _bucket(name: str, data: T.DataType, low: Any, high: Any) -> Column:
    """Never falls as the column rises; the lowest and the highest value differ in it."""
    x = F.col(name)
    if isinstance(data, T.StringType):
        same = len(os.path.commonprefix([low.encode(), high.encode()]))
        return F.substring(text_key(x), 2 * same + 1, 4)
    if isinstance(data, T.DoubleType):
        share = (x / 2 - F.lit(low) / 2) / F.lit(high / 2 - low / 2)  # halves, as the whole width may be infinite
    else:
        share = ((x if isinstance(data, T.DecimalType) else x.cast("decimal(20,0)")) - F.lit(Decimal(low))).cast("double") / F.lit(float(high - low))
    return F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))


def _pick(counts: list, rank: int, descending: bool):
    """The group that holds the rank (from 0) among the groups, and how many rows come before it."""
    before = 0
    for row in sorted(counts, key=lambda r: r[0], reverse=descending):
        if before + row.n > rank:
            return row, before
        before += row.n
    return None, before


def locate(keys: DataFrame, rank: int, descending: bool, most: int = RANKED) -> Interval | None:
    """An interval of at most ``most`` rows that holds the row of ``rank`` (from 0); None past the end."""
    data = keys.schema
    spread = [F.count(F.lit(1)).alias("n")]
    spread += [f(c).alias(f"{e}_{c}") for c in ("value", "key") for e, f in (("low", F.min), ("high", F.max))]
    row, before = _pick(keys.groupBy("kind").agg(*spread).collect(), rank, False)
    if row is None:
        return None
    here = Interval(before, row.n, row.kind)
    rows = keys.where(F.col("kind") == row.kind)
    for name, falling in (("value", descending), ("key", False)):
        if here.rows <= most:
            break
        while row[f"low_{name}"] != row[f"high_{name}"] and here.rows > most:
            bucket = _bucket(name, data[name].dataType, row[f"low_{name}"], row[f"high_{name}"])
            counts = rows.groupBy(bucket.alias("bucket")).agg(*spread).collect()
            row, before = _pick(counts, rank - here.before, falling)
            low, high = row[f"low_{name}"], row[f"high_{name}"]
            here.before, here.rows = here.before + before, row.n
            rows = rows.where(F.col(name).between(F.lit(low), F.lit(high)))
        ends = (row[f"low_{name}"], row[f"high_{name}"])
        here.low, here.high = here.low + (ends[falling],), here.high + (ends[not falling],)
    return here


def _beyond(kind: int, ends: tuple, descending: bool, after: bool) -> Column:
    """Rows at a place of the order or after it (or before it)."""
    cond = F.lit(True)
    if len(ends) == 2:
        cond = F.col("key") >= F.lit(ends[1]) if after else F.col("key") <= F.lit(ends[1])
    if ends and ends[0] is not None:
        value, x = F.lit(ends[0]), F.col("value")
        cond = (x > value if after != descending else x < value) | ((x == value) & cond)
    elsewhere = F.col("kind") > kind if after else F.col("kind") < kind
    return elsewhere | ((F.col("kind") == kind) & F.coalesce(cond, F.lit(True)))


def keys_at(df: DataFrame, by: str, key: str, offset: int, limit: int, descending: bool, most: int = RANKED) -> list:
    """Keys of the rows from ``offset`` on, ``limit`` at the most, in order. Runs jobs; reads ``df`` once."""
    keys = stage(sort_keys(df, by, key, descending), "sort-keys")
    first = locate(keys, offset, descending, most)
    if first is None:
        return []
    last = first
    if first.before + first.rows < offset + limit:
        last = locate(keys, offset + limit - 1, descending, most)
    rows = keys.where(_beyond(first.kind, first.low, descending, True))
    if last is not None:
        rows = rows.where(_beyond(last.kind, last.high, descending, False))
    order = ["kind", F.col("value").desc() if descending else F.col("value"), "key"]
    page = rows.orderBy(*order).offset(offset - first.before).limit(limit)
    return [r.key for r in page.select("key").collect()]
