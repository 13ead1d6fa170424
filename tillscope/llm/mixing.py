"""Mixing sources to target weights.

Words are added up per source, targets and repetition rates follow from the sums, and
each document is emitted floor(rate) times plus once more with a probability equal to
the fraction, drawn from a hash of the seed and its identifier.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import WORD, need
from tillscope.sources.lake import stage

_UNITS = 16**13


def words(text: str) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame, name: str) -> DataFrame:
    """``sources`` with ``rank`` from 0 by code point, NULL last.

    Range partitions are numbered inside, then shifted by the sizes of those before
    them, so no task holds all sources.
    """
    order = F.col(name).asc_nulls_last()
    parts = stage(
        sources.orderBy(order).withColumn("_part", F.spark_partition_id()), "sources"
    ).withColumn("_nth", F.row_number().over(Window.partitionBy("_part").orderBy(order)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.groupBy("_part").agg(F.count("*").alias("_held")).select(
        "_part", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_shift")
    )
    return parts.join(shifts, "_part").withColumn("rank", F.col("_shift") + F.col("_nth") - 1).drop(
        "_part", "_nth", "_shift"
    )


def targets(
    sources: DataFrame,
    name: str = "source",
    size: str = "source_size",
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
) -> DataFrame:
    """``sources`` with ``target``.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share
    ``share`` (a fraction) of all words by weight. A target stops at ``most`` times its
    source; what lies above is shared again among the others until none is above. Sums
    are whole numbers and each target is one division, so reruns agree in every bit.
    """
    over, under = share
    if over > most * under:
        raise ValueError("the share is larger than the sources can give")
    turn = F.pmod("rank", F.lit(len(weights))).cast("int")
    table = stage(
        ranked(sources.select(name, size), name).withColumn(
            "weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long")
        ),
        "weights",
    )

    def is_full(rest: int, weight: int) -> Column:
        # Exact: size * most <= weight * rest / sum of weights.
        wide = F.col(size).cast("decimal(20,0)") * most
        return wide * F.lit(Decimal(weight)) <= F.col("weight") * F.lit(Decimal(rest))

    full = None
    while True:
        # A round: the full sources take most * size, the others share the rest by weight.
        done = F.lit(False) if full is None else is_full(*full[:2])
        state = table.agg(
            F.sum(size), F.sum(F.when(done, F.col(size))), F.sum(F.when(~done, F.col("weight"))), F.count_if(done)
        ).first()
        rest = over * (state[0] or 0) - under * most * (state[1] or 0)
        weight = under * (state[2] or 0)
        if full is not None and state[3] == full[2]:
            break
        full = (rest, weight, state[3])
        if not weight:
            break
    level = F.lit(float(full[0])) * F.col("weight") / F.lit(float(full[1] or 1))
    at_most = (F.col(size) * most).cast("double")
    return table.withColumn("target", F.when(is_full(*full[:2]), at_most).otherwise(level)).drop("rank", "weight")


def copies(key: Column, rate: Column, seed: int) -> Column:
    """floor(rate), plus one where the hash of the key falls below the fraction."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / _UNITS
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _planned(rows: DataFrame, source: str, seed: int, **shares) -> DataFrame:
    """``rows`` (_key, source, size, ...) with source_size, target, copies."""
    sums = rows.groupBy(source).agg(F.sum("size").alias("source_size"))
    plan = targets(sums, source, **shares).withColumnRenamed(source, "_source")
    return (
        rows.join(plan, rows[source].eqNullSafe(plan["_source"]))
        .drop("_source")
        .withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("copies", copies(F.col("_key"), F.col("_rate"), seed))
    )


def _key(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 17,
    **shares,
) -> DataFrame:
    """Per row of ``docs``: the identifier, size, source_size, target, copies, taken.

    NULL texts have size 0, NULL is a source of its own. A source without words has
    target 0 and no copies. Rows repeated under one identifier get the same number of
    copies; a row without identifier draws by the hash of its text. An empty table
    gives an empty result. ``shares`` goes to ``targets``.
    """
    need(docs, id_col, text_col, source_col)
    rows = stage(
        docs.select(
            F.col(id_col).alias("_id"), _key(id_col, text_col).alias("_key"), F.col(source_col).alias("_src"),
            words(text_col).alias("size"),
        ),
        "sizes",
    )
    return _planned(rows, "_src", seed, **shares).select(
        F.col("_id").alias(id_col), "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 17,
    **shares,
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_plan`` says, with all their columns."""
    need(docs, id_col, text_col, source_col)
    rows = docs.select(
        F.struct("*").alias("_row"), _key(id_col, text_col).alias("_key"), F.col(source_col).alias("_src"),
        words(text_col).alias("size"),
    )
    return (
        _planned(rows, "_src", seed, **shares)
        .select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_nth"))
        .select("_row.*")
    )
