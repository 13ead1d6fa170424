"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.sources.lake import stage

#: ASCII white space; words are the runs of anything else.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def need(df: DataFrame, *names: str) -> None:
    """Stop early, and by name, when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {', '.join(df.columns)}")


def numbered(df: DataFrame, name: str, *columns: Column | str) -> DataFrame:
    """``columns`` of ``df`` with a row number ``_rid``, written once so that it never changes."""
    return stage(df.select(F.monotonically_increasing_id().alias("_rid"), *columns), name)


def content_key(*columns: Column) -> Column:
    """64 bits that equal contents share."""
    return F.xxhash64(*columns)


def keyed_by_content(df: DataFrame, name: str, *columns: Column) -> DataFrame:
    """``df`` with a number ``name`` that rows share if, and but for 128-bit chance only if, ``columns`` are equal.

    Contents that share 64 bits but not another 64 are found by one aggregation of these
    numbers, and get their key from both hashes.
    """
    key, proof = content_key(*columns), F.xxhash64(F.lit(1), *columns)
    clash = (
        df.select(key.alias("_key"), proof.alias("_proof"))
        .groupBy("_key")
        .agg(F.min("_proof").alias("_least"), F.max("_proof").alias("_most"))
        .where("_least != _most")
        .select("_key")
    )
    clash = stage(clash, "clashes")
    if clash.isEmpty():
        return df.withColumn(name, key)
    told_apart = F.when(F.col("_clash").isNotNull(), F.xxhash64(F.lit(2), key, proof)).otherwise(key)
    return (
        df.withColumn("_key", key)
        .join(clash.withColumn("_clash", F.lit(True)), "_key", "left")
        .withColumn(name, told_apart)
        .drop("_key", "_clash")
    )


def slices(sizes, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to ``most`` at the most; one item may be larger."""
    start = total = 0
    sizes = list(sizes)
    for k, n in enumerate(sizes):
        if k > start and total + n > most:
            yield start, k
            start, total = k, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
