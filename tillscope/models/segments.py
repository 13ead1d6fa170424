"""Customer clusters and their names."""

from __future__ import annotations

import sys
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.models.features import standard_scale
from tillscope.sources.lake import stage

# The functions below run on executors, where this package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Features of the clusters, and names from the highest spend down.
SEGMENT_FEATURES = [
    "total_txns",
    "total_spend",
    "avg_txn_value",
    "unique_merchants",
    "fraud_txn_count",
    "days_since_last_txn",
    "spend_per_merchant",
]
SEGMENT_NAMES = ["high_value", "luxury_spender", "frequent", "diverse_shopper", "casual"]
NEVER_DAYS = 999
UNIT = 1_000_000
_SLICE = 20_000  # customers a task works on at least, so that the rounds use every core


def segment_features(summary: DataFrame, as_of: date) -> DataFrame:
    """Customer summary with recency (999 without a transaction) and spend per merchant.

    Recency counts whole days up to the end of ``as_of``.
    """
    end = c.ntz(as_of + timedelta(days=1))
    seconds = F.timestamp_diff("SECOND", F.col("last_txn"), end)
    return summary.withColumns(
        {
            "days_since_last_txn": F.coalesce(F.floor(seconds / 86400), F.lit(NEVER_DAYS)).cast("int"),
            "spend_per_merchant": F.col("total_spend") / (F.col("unique_merchants") + 1),
        }
    )


def _points(features: DataFrame) -> DataFrame:
    """``features`` with ``_point``: the scaled features in millionths, whole numbers that add up exactly."""
    names = [f"_{x}" for x in SEGMENT_FEATURES]
    plain = features.withColumns({n: F.coalesce(F.col(x).cast("double"), F.lit(0.0)) for n, x in zip(names, SEGMENT_FEATURES)})
    scaled = standard_scale(plain, names)
    point = F.array(*(F.round(F.col(n) * UNIT).cast("bigint") for n in names))
    return scaled.withColumn("_point", point).drop(*names)


def _starts(points: DataFrame, k: int, seed: int, restarts: int) -> np.ndarray:
    """Per start the points of lowest hash, whatever the partitioning: restarts x k x features."""
    start = F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("start")
    rows = points.select(start, "customer_id", "_point")
    order = Window.partitionBy("start").orderBy(F.xxhash64(F.col("start") + seed, "customer_id"), "customer_id")
    first = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
    held = {(r.start, r.nth - 1): r["_point"] for r in first.collect()}
    # With fewer rows than clusters the last row stands in for the missing ones.
    most = max((n for _, n in held), default=-1)
    size = len(SEGMENT_FEATURES)
    return np.array([[held.get((r, min(n, most)), [0] * size) for n in range(k)] for r in range(restarts)], float)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre, the first of equally near ones, and its distance, for points in columns."""
    near, least = np.zeros(x.shape[1], np.int64), np.full(x.shape[1], np.inf)
    for j, centre in enumerate(centres):
        distance = np.zeros(x.shape[1])
        for column, at in zip(x, centre):  # feature by feature: no table of all gaps
            gap = (column - at) / UNIT
            distance += gap * gap
        closer = distance < least
        near[closer] = j
        np.minimum(least, distance, out=least)
    return near, least


def assign(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """Adds segment_id, the nearest of the centres (in millionths, as the points), the first of equally near ones."""

    @F.pandas_udf("int")
    def nearest(point: pd.Series) -> pd.Series:
        x = np.array(point.tolist(), float).reshape(len(point), centres.shape[1])
        return pd.Series(_nearest(np.ascontiguousarray(x.T), centres)[0].astype("int32"))

    return points.withColumn("segment_id", nearest("_point"))


def kmeans(features: DataFrame, k: int = 5, seed: int = 42, restarts: int = 10, rounds: int = 50) -> DataFrame:
    """Adds segment_id: k-means on the scaled features, the best of ``restarts`` starts.

    All starts move on together, one job a round that adds up whole numbers per cluster,
    until no centre moves. Neither the starts nor the sums depend on the partitioning. A start
    whose centres have come to rest keeps its figures and is not worked out again.
    """
    slices = features.count() // _SLICE + 1
    even = _points(features).repartition(min(slices, 4 * features.sparkSession.sparkContext.defaultParallelism), "customer_id")
    points = stage(even, "segment-points")
    centres = _starts(points, k, seed, restarts)
    size = centres.shape[2]
    best = 0
    moving, cost = list(range(restarts)), [0] * restarts
    for _ in range(rounds):

        def part(batches, centres=centres, moving=moving):
            sums, cost = np.zeros((restarts, k, size + 1), np.int64), np.zeros(restarts, np.int64)
            for batch in batches:
                whole = batch.column("_point").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)
                x = np.ascontiguousarray(whole.T)
                points = x.astype(float)
                for r in moving:
                    near, distance = _nearest(points, centres[r])
                    cost[r] += int(np.rint(distance * UNIT).astype(np.int64).sum())
                    for j in range(k):
                        mine = np.flatnonzero(near == j)
                        sums[r, j, :size] += np.take(x, mine, axis=1).sum(axis=1)
                        sums[r, j, size] += len(mine)
            yield pa.RecordBatch.from_arrays([pa.array([[*sums.ravel(), *cost]], pa.list_(pa.int64()))], ["v"])

        parts = points.select("_point").mapInArrow(part, "v array<bigint>").select(F.posexplode("v").alias("at", "x"))
        total = {r["at"]: int(r["x"]) for r in parts.groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()}
        flat = np.array([total.get(i, 0) for i in range(restarts * k * (size + 1))], object).reshape(restarts, k, size + 1)
        cost = [total.get(restarts * k * (size + 1) + r, 0) if r in moving else cost[r] for r in range(restarts)]
        best = min(range(restarts), key=lambda r: (cost[r], r))
        moved = np.array(
            [[[flat[r, j, i] / flat[r, j, size] if r in moving and flat[r, j, size] else centres[r, j, i] for i in range(size)]
              for j in range(k)] for r in range(restarts)], float,
        )
        moving = [r for r in moving if (moved[r] != centres[r]).any()]
        if not moving:
            break
        centres = moved
    return assign(points, centres[best]).drop("_point")


def name_segments(assigned: DataFrame) -> DataFrame:
    """Adds segment_name by the rank of the cluster's mean spend; ties by id.

    The mean of a cluster's members is its centroid, so k rows are ranked.
    """
    spend = assigned.groupBy("segment_id").agg(F.avg("total_spend").alias("mean_spend"))
    rank = F.rank().over(Window.orderBy(F.desc("mean_spend"), "segment_id"))
    names = F.array(*[F.lit(name) for name in SEGMENT_NAMES])
    labels = spend.withColumn("rank", rank).select(
        "segment_id",
        F.when(F.col("rank") <= len(SEGMENT_NAMES), F.try_element_at(names, F.col("rank")))
        .otherwise(F.concat(F.lit("segment_"), F.col("segment_id").cast("string")))
        .alias("segment_name"),
    )
    return assigned.join(F.broadcast(labels), "segment_id")  # k rows
