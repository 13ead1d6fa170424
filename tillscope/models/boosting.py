"""Boosted trees for two classes (Friedman 2001, logistic loss) over rows of any number.

The rows are written once as blocks with one byte per feature, its bin. A tree grows level by level: each
level is one job, in which tasks add up weights and residuals per node, feature and bin over all rows, and only
these sums reach the driver, which picks the splits. Nothing is kept in memory between the jobs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.sources.lake import stage

# The functions below run on executors, where this package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 64
SAMPLED = 20_000  # rows that the limits of the bins are drawn from; every row is learnt from
BLOCK = 1 << 15  # rows
RATE = 0.1  # weight of every tree but the first
KEPT = 5  # rounds after which the sums of the trees so far are written beside the rows


def limits(rows: DataFrame, columns: list[str], key: str, size: int) -> list[np.ndarray]:
    """Per feature at most 63 rising limits; a value belongs to the first bin whose limit it does not exceed.

    Halfway between values that a sample by hash of the key holds: between all of them if they are few.
    """
    unit = F.pmod(F.xxhash64(F.lit(42), F.col(key)), F.lit(2**53)).cast("double") / 2.0**53
    drawn = rows.where(unit < min(1.0, SAMPLED / max(size, 1))).select(columns).toPandas()
    found = []
    for name in columns:
        values = np.sort(drawn[name].to_numpy(dtype=float))
        values = values[np.isfinite(values)]
        known = np.unique(values)
        if len(known) > BINS:
            firsts = np.unique(values[len(values) * np.arange(1, BINS) // BINS])
            at = np.searchsorted(known, firsts)
        else:
            at = np.arange(1, len(known))
        at = at[at > 0]
        found.append(known[at - 1] / 2 + known[at] / 2)
    return found


def _binned(batch: pa.RecordBatch, columns: list[str], cuts: list[np.ndarray]) -> np.ndarray:
    """One line of bytes per feature."""
    return np.stack([np.searchsorted(c, batch[x].to_numpy(zero_copy_only=False)) for x, c in zip(columns, cuts)]).astype(np.uint8)


def _blocks(rows: DataFrame, columns: list[str], cuts: list[np.ndarray], label: str) -> DataFrame:
    def packed(parts: list) -> pa.RecordBatch:
        bins, hits = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts])
        return pa.RecordBatch.from_pydict({"bins": [bins.tobytes()], "hits": [hits.tobytes()]})

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            parts.append((_binned(batch, columns, cuts), batch[label].to_numpy(zero_copy_only=False) == 1))
            n += batch.num_rows
            if n >= BLOCK:
                yield packed(parts)
                parts, n = [], 0
        if n:
            yield packed(parts)

    return rows.select(label, *columns).mapInArrow(blocks, "bins binary, hits binary")


def _place(splits: dict, slots: dict, bins: np.ndarray) -> np.ndarray:
    """The slot of every row's node. ``splits``: node -> (feature, highest bin on the left); children of i: 2 i, 2 i + 1."""
    n = bins.shape[1]
    at = np.zeros(n, np.min_scalar_type(max(slots.values())))
    todo = [(1, np.ones(n, bool))]
    while todo:
        node, here = todo.pop()
        if node in splits:
            feature, last = splits[node]
            left = bins[feature] <= last
            left &= here
            todo += [(2 * node, left), (2 * node + 1, here ^ left)]
        elif slots[node]:
            at |= here.view(np.uint8) * at.dtype.type(slots[node])
    return at


def _margin(trees: list, bins: np.ndarray, start: np.ndarray | None) -> np.ndarray:
    total = np.zeros(bins.shape[1]) if start is None else start.copy()
    for splits, slots, values in trees:
        total += values.take(_place(splits, slots, bins))
    return total


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        starts = batch["margin"] if "margin" in batch.schema.names else [None] * batch.num_rows
        for bins, hits, start in zip(batch["bins"], batch["hits"], starts):
            hit = np.frombuffer(hits.as_buffer(), bool)
            sums = None if start is None else np.frombuffer(start.as_buffer())
            yield np.frombuffer(bins.as_buffer(), np.uint8).reshape(-1, len(hit)), hit, sums


def _level_sums(blocks: DataFrame, trees: list, first: bool, splits: dict, slots: dict, width: int, weights: tuple) -> np.ndarray:
    """Rows, rows of label 1 and weighted residuals per feature, slot from 1 on, and bin."""
    cells = max(slots.values()) * BINS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((3, width, cells))
        for bins, hit, start in _unpacked(batches):
            at = _place(splits, slots, bins)
            wanted = np.flatnonzero(at)
            if len(wanted) < len(at):
                at, hit, bins = at[wanted], hit[wanted], bins.take(wanted, axis=1)
                start = None if start is None else start[wanted]
            sign = np.where(hit, 1.0, -1.0)
            residual = sign if first else 4 * sign / (1 + np.exp(2 * sign * _margin(trees, bins, start)))
            pulled = np.where(hit, weights[1], weights[0]) * residual
            at = (at.astype(np.intp) - 1) * BINS
            hits = np.flatnonzero(hit)
            for f in range(width):
                place = at + bins[f]
                found[0, f] += np.bincount(place, minlength=cells)
                found[1, f] += np.bincount(place[hits], minlength=cells)
                found[2, f] += np.bincount(place, pulled, cells)
        n, hits, s = found.reshape(3, -1)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"cell": used, "n": n[used].astype(np.int64), "hits": hits[used].astype(np.int64), "s": s[used]}
        )

    made = blocks.mapInArrow(sums, "cell long, n long, hits long, s double")
    made = made.groupBy("cell").agg(*(F.sum(x).alias(x) for x in ("n", "hits", "s")))
    found = np.zeros((3, width * cells))
    for r in made.collect():  # at most nodes x features x 64 rows
        found[:, r.cell] = r.n, r.hits, r.s
    return found.reshape(3, width, -1, BINS)


def _grow(level_sums, weights: tuple, depth: int) -> tuple:
    """(splits, slots, values) of one tree. Of equal gains the first feature and the lowest bin are taken.

    Of two children only the one with fewer rows is summed, the other is what its parent has beyond it.
    """
    splits: dict = {}
    values: dict = {}
    sums: dict = {}
    open_nodes, asked = [1], [1]
    for _ in range(depth):
        slots = dict.fromkeys([*values, *open_nodes], 0) | {node: i for i, node in enumerate(asked, 1)}
        found = level_sums(splits, slots)
        for i, node in enumerate(asked):
            sums[node] = found[:, :, i]
            if node > 1:
                other = sums.pop(node // 2) - sums[node]
                other[2][other[0] == 0] = 0.0
                sums[node ^ 1] = other
        below, asked = [], []
        for node in open_nodes:
            n, hits, s = sums[node]
            ln, lw, ls = (np.cumsum(x, axis=1) for x in (n, weights[0] * (n - hits) + weights[1] * hits, s))
            tn, tw, ts = ln[:, -1:], lw[:, -1:], ls[:, -1:]
            rw, rs = tw - lw, ts - ls
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = ls**2 / lw + rs**2 / rw - ts**2 / tw
            gain = np.where((ln > 0) & (ln < tn), gain, -np.inf)
            f, b = divmod(int(np.argmax(gain)), BINS)
            if node == 1:
                values[1] = float(ts[0, 0] / tw[0, 0])
            if gain[f, b] > 1e-12 * tw[0, 0]:
                splits[node] = (f, b)
                del values[node]
                values[2 * node], values[2 * node + 1] = float(ls[f, b] / lw[f, b]), float(rs[f, b] / rw[f, b])
                below += [2 * node, 2 * node + 1]
                asked.append(2 * node if 2 * ln[f, b] <= tn[f, 0] else 2 * node + 1)
        open_nodes = below
        if not open_nodes:
            break
    slots = {node: i for i, node in enumerate(sorted(values))}
    return splits, slots, np.array([values[node] for node in sorted(values)])


@contextmanager
def _even_tasks(spark: SparkSession):
    """Several tasks per core read the blocks, so that none waits long for the last."""
    name = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(name, None)
    spark.conf.set(name, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def fit(
    rows: DataFrame, columns: list[str], label: str, key: str, rounds: int, depth: int
) -> tuple[list, list[np.ndarray]]:
    """(trees, limits) from all ``rows``. Both classes weigh the same in sum; needs rows of both.

    The first tree fits the labels as -1 and 1, each further one the residuals of the logistic loss,
    taken by a tenth.
    """
    spark = rows.sparkSession
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("hits")).first()
    if not 0 < size.hits < size.n:
        raise ValueError("needs rows of both classes")
    weights = (0.5 * size.n / (size.n - size.hits), 0.5 * size.n / size.hits)
    cuts = limits(rows, columns, key, size.n)
    blocks = stage(_blocks(rows, columns, cuts, label), "boosting-blocks")
    trees: list = []
    since = 0  # trees whose values the blocks hold already

    def summed(batches: Iterator[pa.RecordBatch], later: list) -> Iterator[pa.RecordBatch]:
        for bins, hit, start in _unpacked(batches):
            margin = _margin(later, bins, start)
            yield pa.RecordBatch.from_pydict({"bins": [bins.tobytes()], "hits": [hit.tobytes()], "margin": [margin.tobytes()]})

    with _even_tasks(spark):
        for turn in range(rounds):
            later = trees[since:]
            if len(later) == KEPT:
                kinds = "bins binary, hits binary, margin binary"
                blocks = stage(blocks.mapInArrow(lambda b, later=later: summed(b, later), kinds), "boosting-blocks")
                since, later = turn, []
            splits, slots, values = _grow(
                lambda splits, slots: _level_sums(blocks, later, not turn, splits, slots, len(columns), weights), weights, depth
            )
            trees.append((splits, slots, values * (RATE if turn else 1.0)))
    return trees, cuts


def score(rows: DataFrame, columns: list[str], key: str, label: str, trees: list, cuts: list[np.ndarray]) -> DataFrame:
    """(key, label, probability, predicted) of all ``rows``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _margin(trees, _binned(batch, columns, cuts), None)
            made = [batch[key], batch[label], pa.array(1 / (1 + np.exp(-2 * margin))), pa.array((margin > 0).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(made, [key, label, "probability", "predicted"])

    kinds = f"{key} {rows.schema[key].dataType.simpleString()}, {label} int, probability double, predicted int"
    return rows.select(key, F.col(label).cast("int"), *columns).mapInArrow(scored, kinds)
