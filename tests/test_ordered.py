"""Figures over the rows before, with hot groups, against plain Python."""

import random
from itertools import groupby

import pytest

from tillscope.operators import ordered
from tillscope.plans import outlook

SCHEMA = "id long, g string, v long"


def rows(n=3000):
    rng = random.Random(5)
    return [(k, rng.choice(["hot", "hot", None, "a", "b", f"x{k % 50}"]), rng.choice([None, *range(40)])) for k in range(n)]


def by_group(data):
    def place(r):
        return (r[1] is not None, r[1] or "")

    for _, found in groupby(sorted(data, key=place), key=lambda r: r[1]):
        yield list(found)


@pytest.mark.parametrize("parts", [1, 9])
def test_previous_and_running(spark, parts):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = ordered.ranges(df, ["g"], ["id"])
        spread = ranged.where("g = 'hot'").select("_part").distinct().count()
        previous = {r.id: r.p for r in ordered.with_previous(df, ["g"], ["id"], "v", "p").collect()}
        running = {r.id: (r.s, r.k) for r in ordered.with_running(df, ["g"], ["id"], {"s": "v", "k": "id"}).collect()}
        alone = {r.id: r.s for r in ordered.with_running(df, [], ["id"], {"s": "v"}).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread >= min(parts, 3)  # the hot group is read by several tasks
    for found in by_group(data):
        s = k = 0
        last = None
        for i, _, v in sorted(found):
            assert previous[i] == last and running[i] == (s, k)
            last, s, k = v, s + (v or 0), k + i
    s = 0
    for i, _, v in data:
        assert alone[i] == s
        s += v or 0
    assert len(previous) == len(running) == len(alone) == len(data)


def test_percent_rank(spark):
    data = rows(500) + [(1000, "one", 7), (1001, "none", None)]
    got = {(r.g, r.v): r.percent_rank for r in ordered.percent_rank(spark.createDataFrame(data, SCHEMA), ["g"], "v").collect()}
    want = {}
    for found in by_group(data):
        values = [v for _, _, v in found if v is not None]
        for v in values:
            want[found[0][1], v] = sum(x < v for x in values) / (len(values) - 1) if len(values) > 1 else 0.0
    assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ordered.with_previous(df, ["g"], ["id"], "v", "p").collect() == []
    assert ordered.with_running(df, ["g"], ["id"], {"s": "v"}).collect() == []
    assert ordered.percent_rank(df, [], "v").collect() == []


def test_repeats_of_a_pair_that_has_half_of_all_rows_on_one_day(spark):
    rng = random.Random(3)
    data = []
    for k in range(4000):
        pair = ("c", "m") if k % 2 else (f"c{k % 300}", f"m{k % 7}")
        data.append((f"t{k:05d}", *pair, rng.randrange(86_400 if k % 2 else 10**7), float(k)))
    df = spark.createDataFrame(data, "transaction_id string, customer_id string, merchant_id string, s long, amount double")
    df = df.selectExpr("transaction_id", "customer_id", "merchant_id", "timestamp'2001-01-01 00:00:00' + make_interval(0,0,0,0,0,0,s) AS timestamp", "amount")
    got = {r.transaction_id: r.gap_minutes for r in outlook.rapid_repeat_payments(df, 10).collect()}
    want, last = {}, {}
    for t, c, m, s, _ in sorted(data, key=lambda r: (r[3], r[0])):
        if (c, m) in last and s - last[c, m] <= 600:
            want[t] = round((s - last[c, m]) / 60 + 1e-9, 2)
        last[c, m] = s
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 0.011 for t in got)
