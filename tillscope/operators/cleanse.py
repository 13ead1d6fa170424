"""Deterministic deduplication, required columns, and the orphan policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, key: str, required: list[str], first_by: list[str] = ()) -> DataFrame:
    """One row per key, the same one on every run.

    Complete rows (no NULL in ``required``) win, then the smallest values of
    ``first_by`` and of all other columns. The filter on the row number makes
    Spark keep one row per key before the shuffle, so a key that holds much of
    the data sends one row per task.
    """
    complete = [F.col(c).isNull().asc() for c in required if c != key]
    rest = [c for c in df.columns if c != key and c not in first_by]
    order: list[Column] = complete + [F.col(c).asc_nulls_last() for c in [*first_by, *rest]]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows that lack one of the columns."""
    return df.dropna(how="any", subset=columns)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column."""
    changes = {
        name: F.when(~F.isnan(name), F.col(name))
        for name, kind in df.dtypes
        if kind in ("double", "float")
    }
    return df.withColumns(changes) if changes else df


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column defaults for NULLs; a column that is missing is added."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in defaults.items()
        }
    )


def null_orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keep every fact row; a key the dimension does not have becomes NULL."""
    known = dimension.select(F.col(key), F.lit(True).alias("_known"))
    joined = fact.join(known, key, "left")
    return joined.withColumn(key, F.when(F.col("_known"), F.col(key))).select(*fact.columns)


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-NULL key is unknown to the dimension."""
    return fact.where(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")
