"""Isolation forest (Liu, Ting, Zhou 2008) over a feature table.

Each tree grows in its own task from at most 256 sampled rows; the node table
has a fixed size bound and is broadcast; scoring runs batch-wise over all rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.operators.rank_select import kth_smallest_key, whole_key
from tillscope.sources.lake import stage, with_audit

# The functions below run on executors, where this package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 200
SAMPLE = 256
CONTAMINATION = 0.015
SEED = 42
_SCORED = 1 << 14  # rows scored at a time, at least
_OVERDRAW = 2  # candidates per sampled row, so that no tree comes up short

_NODES = "tree int, node int, feature int, split double, left int, right int, path double"


def _mean_path(n: float) -> float:
    """Average path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _depth(rows: int) -> int:
    """Depth limit of a tree: that of a balanced one."""
    return max(1, math.ceil(math.log2(max(rows, 2))))


def sample(
    features: DataFrame, key: str, trees: int = TREES, size: int = SAMPLE, seed: int = SEED, rows: int | None = None
) -> DataFrame:
    """Rows with a ``tree`` column: per tree the ``size`` rows of lowest hash. ``rows``: their number, if known.

    The hash of the key decides, so the draw does not depend on the partitioning. A row
    serves as many trees as twice the needed draws come to per row: the whole part of
    that number, and one more with the probability of its fraction. From a first tree
    by hash on, a stride without common divisor spreads them over different trees.
    """
    rows = features.count() if rows is None else rows
    share = min(float(trees), _OVERDRAW * size * trees / max(rows, 1))
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(2**53)).cast("double") / 2.0**53
    draws = (F.floor(F.lit(share)) + F.when(unit < share - math.floor(share), 1).otherwise(0)).cast("int")
    stride = next(s for s in range(max(1, round(trees * 0.618)), trees + 2) if math.gcd(s, trees) == 1)
    start = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(trees))
    picks = F.transform(F.sequence(F.lit(1), draws), lambda j: F.pmod(start + j * stride, F.lit(trees)).cast("int"))
    drawn = features.where(draws > 0).withColumn("tree", F.explode(picks))
    order = F.xxhash64(F.lit(seed + 2), F.col(key), F.col("tree"))
    ranked = drawn.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy(order, key)))
    return ranked.where(F.col("_r") <= size).drop("_r")


def _grow(rows: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, feature, split, left, right, path) of one tree; leaves have feature -1
    and carry their path length."""
    limit = _depth(len(rows))
    nodes: list[tuple] = []
    todo = [(0, rows, 0)]
    count = 1
    while todo:
        node, part, depth = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or len(varying) == 0:
            nodes.append((node, -1, 0.0, node, node, depth + _mean_path(len(part))))
            continue
        feature = int(rng.choice(varying))
        split = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= split
        left, right = count, count + 1
        count += 2
        nodes.append((node, feature, split, left, right, 0.0))
        todo.append((left, part[goes_left], depth + 1))
        todo.append((right, part[~goes_left], depth + 1))
    return nodes


def grow(sampled: DataFrame, columns: list[str], key: str, seed: int = SEED) -> DataFrame:
    """The node table: at most trees x (2 x size - 1) rows."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        tree = int(pdf["tree"].iloc[0])
        nodes = _grow(pdf[columns].to_numpy(dtype=float), np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "path"])
        out.insert(0, "tree", tree)
        return out

    return sampled.groupBy("tree").applyInPandas(one, _NODES)


def _forest(table: pd.DataFrame, width: int) -> tuple[list[np.ndarray], list[tuple]]:
    """The distinct splits per feature in rising order, and the trees as (levels, paths).

    A level lists its inner nodes by their place among the children of the level above, with their splits'
    places among all splits. A path has the number made of a row's turns, 1 for left, the first turn highest.
    """
    inner = table[table["feature"] >= 0]
    splits = [np.unique(inner["split"][inner["feature"] == f]) for f in range(width)]
    offsets = np.cumsum([0, *map(len, splits)])
    trees = []
    for _, tree in table.sort_values(["tree", "node"]).groupby("tree", sort=True):
        feature, split, left, right, path = (tree[x].to_numpy() for x in ("feature", "split", "left", "right", "path"))
        levels, leaves, here = [], [], [(0, 0)]
        while here:
            leaves += [(turns, len(levels), path[node]) for node, turns in here if feature[node] < 0]
            places = [i for i, (node, _) in enumerate(here) if feature[node] >= 0]
            if not places:
                break
            parents = [here[i] for i in places]
            used = [offsets[feature[node]] + np.searchsorted(splits[feature[node]], split[node]) for node, _ in parents]
            levels.append((np.array(places), np.array(used)))
            here = [(left[node], 2 * turns + 1) for node, turns in parents] + [(right[node], 2 * turns) for node, turns in parents]
        paths = np.zeros(1 << len(levels))
        for turns, depth, value in leaves:
            paths[turns << (len(levels) - depth)] = value
        trees.append((levels, paths))
    return splits, trees


def _path_sums(splits: list[np.ndarray], trees: list[tuple], values: list[np.ndarray]) -> np.ndarray:
    """Per row the sum of its path lengths. All rows take all turns of a level at once, a bit per row and node.

    Splits between which the rows have no value part them alike, so their bits are made once.
    """
    n = len(values[0])
    width = -(-n // 8)
    masks, places, made = [np.empty((0, width), np.uint8)], [], 0
    for limits, column in zip(splits, values):
        rank = np.searchsorted(limits, column).astype(np.min_scalar_type(len(limits)))  # a NaN lies beyond all
        kinds = np.cumsum(np.bincount(rank, minlength=len(limits) + 1)[: len(limits)] > 0)
        firsts = np.flatnonzero(np.diff(kinds, prepend=-1))
        places.append(made + np.searchsorted(firsts, np.arange(len(limits)), side="right") - 1)
        made += len(firsts)
        for i in range(0, len(firsts), 64):
            masks.append(np.packbits(rank <= firsts[i : i + 64, None].astype(rank.dtype), axis=1))
    masks, places = np.concatenate(masks), np.concatenate(places)
    total = np.zeros(n)
    for levels, paths in trees:
        children, turns = np.full((1, width), 255, np.uint8), np.zeros(n, np.min_scalar_type(len(paths) - 1))
        for inner, used in levels:
            here = children if len(inner) == len(children) else children[inner]
            left = masks[places[used]]
            left &= here
            turns += turns
            turns += np.unpackbits(np.bitwise_or.reduce(left, axis=0), count=n)
            children = np.concatenate([left, here ^ left])
        total += paths.take(turns)
    return total


def score(
    features: DataFrame, nodes: DataFrame, columns: list[str], key: str, size: int, keep: list[str] = ()
) -> DataFrame:
    """(key, score[, keep]): 2 ** (-mean path / expected path), batch-wise on the executors."""
    shared = features.sparkSession.sparkContext.broadcast(_forest(nodes.toPandas(), len(columns)))
    expected = _mean_path(size) or 1.0

    def scored(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        total = _path_sums(*shared.value, [rows[x].to_numpy().astype(float) for x in columns])
        mean = total / max(len(shared.value[1]), 1)
        made = rows.select([key]).append_column("score", pa.array(np.power(2.0, -mean / expected)))
        for name in keep:
            made = made.append_column(name, rows[name])
        return made.to_batches()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in parts:
            held.append(batch)
            n += batch.num_rows
            if n >= _SCORED:
                yield from scored(held)
                held, n = [], 0
        if n:
            yield from scored(held)

    kept = "".join(f", {x} {features.schema[x].dataType.simpleString()}" for x in keep)
    return features.select(key, *columns, *keep).mapInArrow(batches, f"{key} string, score double{kept}")


def threshold(scored: DataFrame, contamination: float = CONTAMINATION) -> float:
    """The (1 - contamination) quantile of the scores, exact, linearly interpolated."""
    rows = scored.count()
    if rows == 0:
        return 0.0
    position = (rows - 1) * (1.0 - contamination)
    k = math.floor(position)
    scale = 2.0**60  # scores lie in (0, 1)
    low = int(kth_smallest_key(scored, whole_key(F.col("score") * F.lit(scale)), k + 1).ljust(16, "0"), 16) / scale
    next_ = scored.agg(
        F.count_if(F.col("score") <= low).alias("upto"),
        F.min(F.when(F.col("score") > low, F.col("score"))).alias("above"),
    ).first()
    high = low if next_.upto > k + 1 or next_.above is None else next_.above
    return low + (high - low) * (position - k)


def isolation_forest(
    features: DataFrame, columns: list[str], key: str = "transaction_id",
    trees: int = TREES, size: int = SAMPLE, contamination: float = CONTAMINATION, seed: int = SEED,
    keep: list[str] = (),
) -> DataFrame:
    """(key, model_prediction, model_score[, keep], model_name, created_at).

    ``features`` should be a written table or follow from one without a shuffle: it is read for the
    sample and for the scores. model_score is above 0 for exactly the flagged rows. The scores are
    written, the rest follows from them; created_at is the time of their writing.
    """
    rows = features.count()
    nodes = stage(grow(sample(features, key, trees, size, seed, rows), columns, key, seed), "forest")
    psi = min(size, rows)
    scored = stage(with_audit(score(features, nodes, columns, key, psi, keep), model_name="isolation_forest"), "anomaly-scores")
    cut = threshold(scored, contamination)
    return scored.select(
        key,
        F.when(F.col("score") > cut, 1).otherwise(0).alias("model_prediction"),
        (F.col("score") - F.lit(cut)).alias("model_score"),
        *keep, "model_name", "created_at",
    )
