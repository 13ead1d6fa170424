"""Nearest vectors by a block matrix join over int8 tiles.

Candidates and queries are dealt into blocks by hash; each pair of blocks is one tile,
a task of bounded size. In a tile unit vectors are rounded to int8, their products are
exact integers, and the rounding errors bound how far each product lies from the true
cosine. Pairs whose upper bound misses the query's k-th lower bound are out; the others
are computed again from the original vectors in double precision and go through a heap
per query. The heaps of all tiles are merged by rank.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import need
from tillscope.sources.lake import stage


def _usable(vector: Column) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times the power of two that brings each one's largest part to between a half and one.

    That rounds nothing, and squares neither overflow nor vanish.
    """
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values of unit vectors, the step of each, and the length of what rounding took away."""
    step = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / step[:, None])
    return q.astype(np.int8), step, np.sqrt(((unit - q * step[:, None]) ** 2).sum(axis=1))


def bounds(queries: tuple, rows: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all cosines of a tile."""
    (a, sa, ea), (b, sb, eb) = queries, rows
    # Integer sums stay below 2**24 up to 1,040 dimensions, so single precision holds them exactly.
    kind = np.float32 if a.shape[1] <= 1040 else np.float64
    near = (a.astype(kind) @ b.astype(kind).T).astype(np.float64) * sa[:, None] * sb[None, :]
    off = ea[:, None] * (1 + eb[None, :]) + eb[None, :] + 1e-9
    return near - off, near + off


def tile(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, step: int = 64
) -> list[tuple[int, int, float]]:
    """The k nearest rows of each query: (query id, id, cosine)."""
    queries, rows = scaled(queries), scaled(rows)
    norm_q, norm = np.sqrt((queries * queries).sum(axis=1)), np.sqrt((rows * rows).sum(axis=1))
    right = quantised(rows / norm[:, None])
    out = []
    for start in range(0, len(queries), step):
        part = slice(start, start + step)
        low, high = bounds(quantised(queries[part] / norm_q[part, None]), right)
        own = query_ids[part, None] == ids[None, :]
        low[own] = high[own] = -np.inf
        kth = np.partition(low, -k, axis=1)[:, -k] if k <= len(ids) else np.full(len(low), -np.inf)
        for j in range(len(low)):
            left = np.flatnonzero((high[j] >= kth[j]) & ~own[j])
            q = queries[start + j]
            score = (rows[left] * q).sum(axis=1) / (norm[left] * norm_q[start + j])
            best = heapq.nsmallest(k, zip((-score).tolist(), ids[left].tolist()))
            out.extend((int(query_ids[start + j]), i, -s) for s, i in best)
    return out


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    block: int = 16_384,
) -> DataFrame:
    """For each row where ``is_query`` holds its ``k`` nearest others: query_id, rank, id, score.

    ``score`` is the cosine of the original vectors in double precision; ties go to the
    smaller identifier. Vectors that are NULL, empty, zero or hold NULL or non-finite
    parts take no part, nor do rows without identifier; vectors of different length
    are never compared. Rows repeated under one identifier count once, with the vector
    that sorts first. A query without others has no rows. Other columns are not read.
    With n rows and m queries about 2 n m / ``block`` vectors are shuffled.
    """
    need(vectors, id_col, vector_col)
    # Single precision travels as it is; tasks compute in double precision.
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    vector = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = stage(
        vectors.select(F.col(id_col).alias("id"), vector.alias("v"), is_query.alias("asks"))
        .filter(F.col("id").isNotNull() & _usable(F.col("v")))
        .groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
        .withColumn("dim", F.size("v")),
        "vectors",
    )
    n, m = rows.agg(F.count("*"), F.count_if(F.col("asks"))).first()
    across, down = max(1, -(-n // block)), max(1, -(-m // block))

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def dealt(blocks: int, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(blocks)).cast("int")

    right = rows.select("dim", dealt(across, 1).alias("g"), every(down).alias("h"), "id", "v")
    left = rows.filter("asks").select("dim", every(across).alias("g"), dealt(down, 2).alias("h"), "id", "v")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        def matrix(t):
            flat = t.column("v").combine_chunks()
            flat = flat if isinstance(flat, pa.Array) else flat.chunk(0)
            return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1)

        found = []
        if a.num_rows and b.num_rows:
            found = tile(a.column("id").to_numpy(), matrix(a), b.column("id").to_numpy(), matrix(b), k)
        q, i, s = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})

    keys = ["dim", "g", "h"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
