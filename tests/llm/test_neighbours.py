import numpy as np
from pyspark.sql import functions as F

from tillscope.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, id string, v string, g int, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "x", 1, 1.0) for i, v in rows], SCHEMA)


def plain(rows, k, every):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for i, q in usable.items():
        if i % every == 0:
            s = sorted((-(q * v).sum() / (np.sqrt((v * v).sum()) * np.sqrt((q * q).sum())), j) for j, v in usable.items() if j != i and len(v) == len(q))
            out[i] = [(j, -x) for x, j in s[:k]]
    return out


def check(rows, got, k, every):
    want, found = plain(rows, k, every), {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == {i for i, v in want.items() if v}
    for i, v in found.items():
        assert [j for j, _ in v] == [j for j, _ in want[i]], i
        assert np.allclose([x for _, x in v], [x for _, x in want[i]], rtol=0, atol=1e-12)


def test_exact_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 16)).astype(np.float32).astype(float)
    rows = [(i, base[i % 290].tolist()) for i in range(300)]  # ten vectors twice
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [float("inf")] + [1.0] * 15),
             (1005, [None] + [1.0] * 15), (None, [1.0] * 16), (1006, [1.0, 2.0]), (1010, [2.0, 4.0]), (1100, [1e-3] * 16)]
    df = table(spark, rows)
    for block in (40, 4096):
        check(rows, neighbours.nearest(df.repartition(5), F.col("vec_id") % 10 == 0, block=block).collect(), 5, 10)


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(200)] + [(i, [1.0, 0.0, float(i)]) for i in range(200, 230)]
    check(rows, neighbours.nearest(table(spark, rows), F.col("vec_id") % 50 == 0, block=32).collect(), 5, 50)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in (rng.normal(size=(30, 9)), rng.normal(size=(50, 9))))
    low, high = neighbours.bounds(neighbours.quantised(a), neighbours.quantised(b))
    assert (low <= a @ b.T).all() and (a @ b.T <= high).all() and (high - low).max() < 0.1


def test_few_rows(spark):
    one = table(spark, [(0, [1.0, 2.0])])
    assert neighbours.nearest(one, F.col("vec_id") % 50 == 0).collect() == []
    assert neighbours.nearest(one.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    two = table(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [1.0, 1.0])])
    (row,) = neighbours.nearest(two, F.col("vec_id") % 50 == 0).collect()
    assert (row.rank, row.vec_id) == (1, 3) and abs(row.score - 0.5**0.5) < 1e-15


def test_very_long_and_very_short_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e300, 0.0]), (2, [3e-200, 4e-200]), (3, [1e-310, 1e-310]), (4, [-1e308, 1e308])]
    got = neighbours.nearest(table(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [3, 2, 1, 4]
    assert np.allclose([r.score for r in got], [1, 1.4 / 2**0.5, 0.5**0.5, 0], rtol=0, atol=1e-12)
