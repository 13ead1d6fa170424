from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillscope.models import features, forecast, iforest, rules, segments
from tillscope.operators import rank_select


def test_kth_smallest_text(spark):
    ids = [f"T{i:05d}" for i in range(0, 30000, 3)]
    df = spark.createDataFrame([(x,) for x in ids], "id string").repartition(5)
    for k in (1, 2, 4097, 9999, 10000):
        got = rank_select.kth_smallest_key(df, rank_select.text_key(F.col("id")), k)
        assert bytes.fromhex(got).decode() == ids[k - 1]
    with pytest.raises(ValueError):
        rank_select.kth_smallest_key(df, rank_select.text_key(F.col("id")), 10001)


def test_kth_smallest_with_one_hot_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") < 20000, 7).otherwise(F.col("id")).alias("v"))
    key = rank_select.whole_key(F.col("v"))
    assert int(rank_select.kth_smallest_key(df, key, 1), 16) == 7
    assert int(rank_select.kth_smallest_key(df, key, 20000), 16) == 7
    assert int(rank_select.kth_smallest_key(df, key, 20001), 16) == 20000


def test_kth_smallest_prefix_sorts_first(spark):
    words = ["b", "ab", "a", "abc", "", "é", "z"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    order = sorted(words, key=lambda w: w.encode())
    for k in range(1, len(words) + 1):
        got = rank_select.kth_smallest_key(df, rank_select.text_key(F.col("w")), k)
        assert bytes.fromhex(got).decode() == order[k - 1]


def scored(spark, points):
    return spark.createDataFrame([(f"T{i:04d}", p) for i, p in enumerate(points)], "transaction_id string, fraud_points int")


@pytest.mark.parametrize("n, fraction, want", [(1, 0.015, 1), (10, 0.015, 1), (200, 0.015, 3), (200, 1.0, 200)])
def test_top_fraction_size(spark, n, fraction, want):
    df = scored(spark, [(i * 7) % 4 * 15 for i in range(n)])
    label = rules.fit_top_fraction(df, fraction).label(df)
    assert label.where("is_fraud = 1").count() == want


def test_top_fraction_ties_by_id(spark):
    df = scored(spark, [30] * 90 + [50] * 2 + [30] * 8)
    got = [r[0] for r in rules.fit_top_fraction(df, 0.05).label(df).where("is_fraud = 1").orderBy("transaction_id").collect()]
    assert got == ["T0000", "T0001", "T0002", "T0090", "T0091"]


def test_top_fraction_empty(spark):
    df = scored(spark, [1]).limit(0)
    assert rules.fit_top_fraction(df).label(df).count() == 0


@pytest.mark.parametrize(
    "amount, hour, far, risk, points, level",
    [
        (1.0, 12, 1.0, 10, 0, "Low"),
        (1.0, 12, 1.0, 71, 15, "Low"),
        (1.0, 4, 1.0, 70, 20, "Medium"),
        (1.0, 12, 50.1, 10, 25, "Medium"),
        (301.0, 12, 50.0, 71, 45, "High"),
        (300.0, 0, 51.0, 10, 45, "High"),
        (301.0, 0, 51.0, 71, 90, "High"),
        (301.0, 5, 1.0, 10, 30, "Medium"),
    ],
)
def test_rule_points(spark, amount, hour, far, risk, points, level):
    df = spark.createDataFrame(
        [(amount, hour, 0, far, risk, 100.0)],
        "amount double, txn_hour int, is_weekend int, raw_distance double, merchant_risk int, mean_amount double",
    )
    row = rules.score(df).first()
    assert (row.fraud_points, row.risk_level, row.fraud_score) == (points, level, points / 100)


def test_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "x string")
    codes = features.category_codes(df, ["x"])
    assert sorted((r.value, r.code) for r in codes.collect()) == [("a", 0), ("b", 1), ("c", 2)]
    got = features.with_codes(df, codes.where("value <> 'c'"), ["x"])
    assert {(r.x, r.x_enc) for r in got.collect()} == {("a", 0), ("b", 1), (None, -1), ("c", -1)}


def test_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(tuple(r) for r in features.standard_scale(df, ["a", "b"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


# ------------------------------------------------------------- isolation forest
@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(2000, 3))
    points[0] = [40.0, -40.0, 40.0]
    data = [(f"T{i:05d}", *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(data, "transaction_id string, a double, b double, c double")


def test_forest_flags_the_share_and_the_outlier(cloud):
    made = iforest.isolation_forest(cloud, ["a", "b", "c"], trees=30).cache()
    assert made.where("model_prediction = 1").count() == 30
    assert made.where("(model_score > 0) <> (model_prediction = 1)").count() == 0
    assert made.orderBy(F.desc("model_score")).first().transaction_id == "T00000"


def test_turns_of_all_rows_at_once_are_those_of_each_row():
    rng = np.random.default_rng(2)
    points = np.column_stack([rng.normal(size=700), rng.integers(0, 3, 700), np.ones(700)])
    trees = [iforest._grow(points[rng.choice(700, size, replace=False)], rng) for size in (256, 1, 40, 600)]
    points[:5, 0] = [np.nan, np.inf, -np.inf, 0.0, -0.0]
    table = pd.DataFrame(
        [(t, *node) for t, tree in enumerate(trees) for node in tree],
        columns=["tree", "node", "feature", "split", "left", "right", "path"],
    )

    def walked(row):
        total = 0.0
        for tree in trees:
            by_number = {n[0]: n for n in tree}
            node = by_number[0]
            while node[1] >= 0:
                node = by_number[node[3] if row[node[1]] <= node[2] else node[4]]
            total += node[5]
        return total

    for rows in (700, 9, 1):
        got = iforest._path_sums(*iforest._forest(table.sample(frac=1, random_state=1), 3), list(points[:rows].T))
        assert got.tolist() == [walked(p) for p in points[:rows]]


def test_forest_does_not_depend_on_partitions(cloud):
    def run(parts):
        made = iforest.isolation_forest(cloud.repartition(parts), ["a", "b", "c"], trees=20)
        return made.select("transaction_id", F.round("model_score", 9)).orderBy("transaction_id").collect()

    assert run(1) == run(6)


def test_large_table_sampling(spark):
    df = spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("x"))
    drawn = iforest.sample(df, "k", trees=50, size=64)
    per_tree = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert len(per_tree) == 50 and set(per_tree) == {64}
    assert drawn.select("k", "tree").distinct().count() == 50 * 64


def test_one_draw_for_small_and_large_tables(spark):
    for rows in (64, 90, 700, 20_000):
        df = spark.range(rows).select(F.col("id").cast("string").alias("k"))
        per_tree = {r.tree: r["count"] for r in iforest.sample(df, "k", trees=20, size=64).groupBy("tree").count().collect()}
        assert len(per_tree) == 20 and set(per_tree.values()) == {64}


def test_threshold_is_the_interpolated_quantile(spark):
    values = np.random.default_rng(3).uniform(0.3, 0.8, 997)
    df = spark.createDataFrame([(float(v),) for v in values], "score double")
    assert iforest.threshold(df, 0.015) == pytest.approx(np.quantile(values, 0.985), abs=1e-12)
    flat = spark.createDataFrame([(0.5,)] * 100, "score double")
    assert iforest.threshold(flat, 0.015) == 0.5


# -------------------------------------------------------------------- segments
def test_segments_named_by_spend(lake):
    rows = (
        lake.segments.groupBy("segment_name").agg(F.avg("total_spend").alias("m"), F.count("*").alias("n"))
        .orderBy(F.desc("m")).collect()
    )
    assert [r.segment_name for r in rows] == segments.SEGMENT_NAMES[: len(rows)]
    assert sum(r.n for r in rows) == lake.customers.count()


def test_segments_do_not_depend_on_partitions(spark, lake):
    made = segments.segment_features(lake.customer_summary, lake.as_of)
    runs = [
        sorted((r.customer_id, r.segment_id) for r in segments.kmeans(made.repartition(n), restarts=3).collect())
        for n in (1, 13)
    ]
    assert runs[0] == runs[1]
    few = segments.kmeans(made.limit(3), restarts=2)
    assert few.columns == [*made.columns, "segment_id"] and few.count() == 3
    assert segments.kmeans(made.limit(0), restarts=2).count() == 0


def test_nearest_centre_feature_by_feature():
    """The same centres and distances, bit by bit, as from the table of all gaps; the first of equally near ones."""
    rng = np.random.default_rng(5)
    x, centres = rng.integers(-4, 5, (500, 7)) * 250_000, rng.integers(-4, 5, (5, 7)) * 250_000.0
    centres[3] = centres[1]
    gaps = (((x[:, None, :] - centres[None, :, :]) / segments.UNIT) ** 2).sum(axis=2)
    near, least = segments._nearest(np.ascontiguousarray(x.T).astype(float), centres)
    assert (near == gaps.argmin(axis=1)).all() and (least == gaps.min(axis=1)).all()


def test_rounds_read_even_slices(spark, lake, monkeypatch):
    """The written points lie in as many slices as their number asks for, and the segments stay the same."""
    made = segments.segment_features(lake.customer_summary, date(2001, 8, 1)).coalesce(1)
    want = sorted((r.customer_id, r.segment_id) for r in segments.kmeans(made, restarts=3).collect())
    parts, stage = [], segments.stage

    def recording(df, name):
        parts.append((name, df.rdd.getNumPartitions()))
        return stage(df, name)

    monkeypatch.setattr(segments, "stage", recording)
    monkeypatch.setattr(segments, "_SLICE", 30)
    assert sorted((r.customer_id, r.segment_id) for r in segments.kmeans(made, restarts=3).collect()) == want
    assert parts == [("segment-points", min(made.count() // 30 + 1, 4 * spark.sparkContext.defaultParallelism))]


def test_recency(spark):
    df = spark.createDataFrame(
        [("a", None, 0.0, 0), ("b", "2024-01-01 12:00:00", 10.0, 4), ("c", "2024-01-10 00:00:00", 10.0, 1)],
        "customer_id string, t string, total_spend double, unique_merchants bigint",
    ).withColumn("last_txn", F.col("t").cast("timestamp_ntz"))
    got = segments.segment_features(df, date(2024, 1, 10))
    assert [(r.days_since_last_txn, r.spend_per_merchant) for r in got.orderBy("customer_id").collect()] == [
        (999, 0.0), (9, 2.0), (1, 5.0),
    ]


# -------------------------------------------------------------------- forecast
def frame(spark, name, values, start=date(2024, 1, 1)):
    data = [(name, start + timedelta(days=i), float(v), name == "transactions") for i, v in enumerate(values)]
    return spark.createDataFrame(data, "metric_name string, date date, y double, is_count boolean")


def test_short_series_gives_nothing(spark):
    assert forecast.forecast(frame(spark, "revenue", range(13))).count() == 0


def test_fourteen_days(spark):
    got = forecast.forecast(frame(spark, "revenue", np.random.default_rng(0).uniform(5, 9, 14))).collect()
    assert len(got) == 30 and got[0].forecast_date == date(2024, 1, 15)
    assert all(np.isfinite(r.forecast_value) for r in got)


def test_constant_series(spark):
    got = forecast.forecast(frame(spark, "transactions", [7] * 40)).collect()
    assert {(r.forecast_value, r.lower_bound, r.upper_bound) for r in got} == {(7.0, 7.0, 7.0)}


def test_recovers_coefficients(spark):
    rng = np.random.default_rng(5)
    d = [0.0, 0.0]
    for _ in range(6000):
        d.append(0.5 * d[-1] - 0.3 * d[-2] + rng.normal())
    row = forecast.gram(forecast.lagged_differences(frame(spark, "revenue", np.cumsum(d) + 1000))).toPandas().iloc[0]
    g = np.array([[row[f"g_{min(i, j)}_{max(i, j)}"] for j in range(8)] for i in range(8)])
    phi = np.linalg.solve(g[1:, 1:], g[1:, 0])
    assert phi[:2] == pytest.approx([0.5, -0.3], abs=0.04)
    assert abs(phi[2:]).max() < 0.05


def test_bounds_widen_and_metrics_are_separate(spark):
    rng = np.random.default_rng(2)
    both = frame(spark, "revenue", 5000 + np.cumsum(rng.normal(size=300))).union(
        frame(spark, "transactions", 500 + rng.normal(size=300) * 5)
    )
    got = forecast.forecast(both).toPandas()
    for name, part in got.groupby("metric_name"):
        part = part.sort_values("forecast_date")
        width = (part.upper_bound - part.lower_bound).to_numpy()
        assert (part.lower_bound <= part.forecast_value).all() and (part.forecast_value <= part.upper_bound).all()
        assert (np.diff(width) > (-1e-9 if name == "revenue" else -2)).all()
    counts = got[got.metric_name == "transactions"].forecast_value
    assert (counts == counts.round()).all()


def kalman(phi, variance, x):
    """Log likelihood of a stationary autoregression, step by step over all of its state."""
    p = len(phi)
    move = np.vstack([phi, np.eye(p)[:-1]])
    shock = np.zeros((p, p))
    shock[0, 0] = variance
    spread = np.linalg.solve(np.eye(p * p) - np.kron(move, move), shock.ravel()).reshape(p, p)
    state, total = np.zeros(p), 0.0
    for value in x:
        width, error = spread[0, 0], value - state[0]
        total -= (np.log(2 * np.pi * width) + error**2 / width) / 2
        gain = spread[:, 0] / width
        state, spread = move @ (state + gain * error), move @ (spread - np.outer(gain, spread[0])) @ move.T + shock
    return total


@pytest.mark.parametrize("lags, days", [(1, 20), (2, 16), (7, 14), (7, 90)])
def test_coefficients_maximise_the_exact_likelihood(spark, lags, days):
    """Against a Kalman filter over the whole series: no nearby coefficients or variance do better."""
    rng = np.random.default_rng(days)
    y = 50 + rng.normal(size=days).cumsum() + rng.normal(size=days)
    row = forecast.gram(forecast.lagged_differences(frame(spark, "revenue", y), lags), lags).toPandas().iloc[0]
    g = np.array([[row[f"g_{min(i, j)}_{max(i, j)}"] for j in range(lags + 1)] for i in range(lags + 1)])
    start = np.array([row[f"first_d{i}"] for i in range(lags)])[::-1]
    x = np.diff(y)
    assert start == pytest.approx(x[:lags]) and row.n_days == days
    phi, sigma = forecast.fit(g, start, days - 1)
    best = kalman(phi, sigma**2, x)
    for _ in range(40):
        moved = phi + rng.normal(size=lags) * rng.choice([1e-3, 1e-2])
        if abs(np.roots(np.append(1, -moved))).max() < 1:
            assert kalman(moved, sigma**2 * rng.choice([0.99, 1, 1.01]), x) < best
    if lags == 1:  # brute force over a grid
        grid = np.arange(-0.9999, 1, 0.0001)
        fitted = [kalman(np.array([k]), forecast_variance(k, x), x) for k in grid]
        assert grid[int(np.argmax(fitted))] == pytest.approx(phi[0], abs=1e-4)


def forecast_variance(phi, x):
    return (x[0] ** 2 * (1 - phi**2) + ((x[1:] - phi * x[:-1]) ** 2).sum()) / len(x)


def test_densify(spark):
    df = frame(spark, "revenue", [1]).union(frame(spark, "revenue", [4], date(2024, 1, 4)))
    assert [r.y for r in forecast.densify(df).orderBy("date").collect()] == [1.0, 0.0, 0.0, 4.0]
