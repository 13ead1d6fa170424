"""Figures that depend on the rows before, for groups of any size.

A window function reads a whole group in one task, so a group that holds much of the data, or
no group at all, does not scale. Here the rows are written in range partitions of group and
order; a window stays inside one range, and what a range needs from those before it comes from
one summary row per range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.sources.lake import stage


def _group(columns: list[str]) -> Column:
    return F.struct(*columns) if columns else F.struct(F.lit(0).alias("all"))


def ranges(df: DataFrame, group: list[str], order: list[str], name: str = "ranges") -> DataFrame:
    """``df`` written in ranges of (group, order), with the number of the range in ``_part``.

    Only rows equal in all these columns are sure to share a range; let ``order`` end in a key.
    """
    by = [*group, *order]
    parted = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return stage(parted.withColumn("_part", F.spark_partition_id()), name)


def with_previous(df: DataFrame, group: list[str], order: list[str], value: str, alias: str) -> DataFrame:
    """Adds ``value`` of the row before in the group, NULL for the first row of a group.

    NULLs of the group are a group, NULLs of the order come first. Rows equal in group and
    order stand in any order. An empty table stays empty.
    """
    parts = ranges(df, group, order)
    last = F.struct(_group(group).alias("g"), F.col(value).alias("v"))
    ends = parts.groupBy("_part").agg(F.max_by(last, F.struct(*group, *order)).alias("_last"))
    # One row per range.
    ends = ends.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_above"))
    inside = Window.partitionBy("_part", *group).orderBy(*order)
    carried = F.when(F.col("_above.g").eqNullSafe(_group(group)), F.col("_above.v"))
    first = F.row_number().over(inside) == 1
    marked = parts.withColumn("_first", first).withColumn("_lag", F.lag(value).over(inside))
    joined = marked.join(ends, "_part")
    return joined.withColumn(alias, F.when(F.col("_first"), carried).otherwise(F.col("_lag"))).drop(
        "_part", "_first", "_lag", "_above"
    )


def with_running(df: DataFrame, group: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """Adds per ``sums`` {new: column} the sum over all rows before in the group, 0 for the first.

    ``order`` must tell the rows of a group apart: add up equal ones first. NULL adds nothing.
    """
    parts = ranges(df, group, order)
    kinds = {new: parts.schema[old].dataType for new, old in sums.items()}
    totals = parts.groupBy("_part", *group).agg(*(F.sum(old).alias(f"_{new}") for new, old in sums.items()))
    per_part = totals.groupBy("_part").agg(
        F.max_by(F.struct(_group(group).alias("g"), *(F.col(f"_{new}").alias(new) for new in sums)), _group(group)).alias("_last")
    )
    # One row per range: what the last group of the range has reached by its end.
    reached = Window.partitionBy("_last.g").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    end = F.struct(F.col("_last.g").alias("g"), *(F.sum(f"_last.{new}").over(reached).alias(new) for new in sums))
    ends = per_part.select("_part", end.alias("_end"))
    ends = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_above"))
    before = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = parts.withColumns({f"_in_{new}": F.sum(old).over(before) for new, old in sums.items()})
    same = F.col("_above.g").eqNullSafe(_group(group))

    def whole(new: str) -> Column:
        zero = F.lit(0).cast(kinds[new])
        return F.coalesce(f"_in_{new}", zero) + F.coalesce(F.when(same, F.col(f"_above.{new}")), zero)

    added = inside.join(ends, "_part").withColumns({new: whole(new) for new in sums})
    return added.drop("_part", "_above", *(f"_in_{new}" for new in sums))


def percent_rank(df: DataFrame, group: list[str], value: str, alias: str = "percent_rank") -> DataFrame:
    """(group, value, alias) per distinct value: the share of the group's other rows that lie below, 0 to 1.

    Rows with a NULL value take no part. A group of one row ranks 0.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = stage(with_running(counts, group, [value], {"_below": "_n"}), "placed")
    names = [f"_g{i}" for i in range(len(group))]
    sizes = placed.groupBy(*(F.col(g).alias(n) for g, n in zip(group, names))).agg((F.sum("_n") - 1).alias("_others"))
    same = reduce(Column.__and__, (F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names)), F.lit(True))
    share = F.coalesce(F.try_divide("_below", "_others"), F.lit(0.0))
    return placed.join(sizes, same).select(*group, value, share.alias(alias))
