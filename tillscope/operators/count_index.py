"""Row counts stored beside a table that is laid out by a partition column.

One row per partition value and combination of the columns that pages filter on. Such
columns have few values, so the index stays small whatever the table's size; it tells which
partitions hold a page, and the total behind it, without reading the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.operators.paging import where_equal
from tillscope.sources.lake import stage


@dataclass(frozen=True)
class CountIndex:
    counts: DataFrame
    part: str
    dims: tuple[str, ...]

    def covers(self, filters: dict) -> bool:
        """Whether the index knows every column that is filtered on."""
        return all(name in self.dims for name, value in filters.items() if value not in (None, ""))

    def matching(self, **filters) -> DataFrame:
        return where_equal(self.counts, **filters)

    def total(self, **filters) -> DataFrame:
        """Row count of the filtered table."""
        return self.matching(**filters).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))

    def parts_of(self, offset: int, limit: int, descending: bool, **filters) -> tuple[list, int]:
        """Partition values that hold the rows from ``offset`` on, and how many rows come before them.

        For an order that never leaves a partition before it is read to the end; rows
        without partition value come last.
        """
        sizes = self.matching(**filters).groupBy(self.part).agg(F.sum("n").alias("n")).collect()
        known = sorted((r for r in sizes if r[self.part] is not None), key=lambda r: r[self.part], reverse=descending)
        held, before, seen = [], 0, 0
        for row in [*known, *(r for r in sizes if r[self.part] is None)]:
            if seen + row.n <= offset:
                before += row.n
            elif seen < offset + limit:
                held.append(row[self.part])
            seen += row.n
        return held, before

    def only(self, df: DataFrame, parts: list) -> DataFrame:
        """The rows of these partitions; the others are not read."""
        cond: Column = F.col(self.part).isin([p for p in parts if p is not None])
        return df.where(cond | F.col(self.part).isNull() if None in parts else cond)


def count_index(df: DataFrame, part: str, dims: dict[str, Column]) -> CountIndex:
    """Count the rows of ``df`` once; ``dims`` names the columns or conditions to be filtered on."""
    named = [expr.alias(name) for name, expr in dims.items()]
    counts = df.groupBy(part, *named).agg(F.count(F.lit(1)).alias("n"))
    return CountIndex(stage(counts, "count-index"), part, tuple(dims))
