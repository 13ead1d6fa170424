"""Induced word weights against counting by hand, and the plan of the quality report."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillscope.operators import quality
from tillscope.text import induced


def words(text):
    return set(re.findall(r"[^\W\d_]{2,}|[^\w \t\n\r\f]+", (text or "").lower()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["great", "awful", "été", "card", "a", "x1y", "日本語", "fine", "!!!", ":-)"]
    made = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 9))), rng.choice([0, 1, None])) for i in range(200)]
    return [*made, (200, None, 1), (201, "", 0), (202, "GREAT great " * 2000, 1), (7, made[7][1], made[7][2])]


def test_weights_and_scores(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "id int, text string, good int, word string")
    made = induced.induce(df, "id", F.col("good") == 1, least=2)
    counts = {g: Counter(w for _, t, good in rows if good == g for w in words(t)) for g in (0, 1)}
    size = len(counts[0] | counts[1])
    odds = {w: [math.log((counts[g][w] + 1) / (counts[g].total() + size)) for g in (0, 1)] for w in counts[0] | counts[1]}
    want = {
        w: (counts[1][w], counts[0][w], odds[w][1] - odds[w][0]) for w in odds if counts[0][w] + counts[1][w] >= 2
    }
    got = {r.word: tuple(r)[1:] for r in made.collect()}
    assert got.keys() == want.keys()
    for w, row in want.items():
        assert got[w] == pytest.approx(row), w
    once = {r[0]: r for r in rows}
    known = {i: [want[w][2] for w in words(text) if w in want] for i, text, _ in once.values()}
    mean = {i: sum(k) / len(k) for i, k in known.items() if k}
    sides = [[mean[i] for i, _, good in once.values() if good == side and i in mean] for side in (0, 1)]
    middle = sum(sum(x) / len(x) for x in sides) / 2
    single = df.dropDuplicates(["id"])
    found = induced.midpoint(single, "id", made, F.col("good") == 1)
    assert found.first().middle == pytest.approx(middle)
    scored = {r.id: r for r in induced.score(single, "id", made, found).collect()}
    assert scored.keys() == once.keys()
    for i in once:
        assert scored[i].n_known == len(known[i])
        assert scored[i].polarity == pytest.approx(mean[i] - middle if i in mean else 0.0, abs=1e-6)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id int, text string, good int")
    made = induced.induce(df, "id", F.col("good") == 1)
    middle = induced.midpoint(df, "id", made, F.col("good") == 1)
    assert made.collect() == [] and middle.first().middle == 0
    assert induced.score(df, "id", made, middle).collect() == []


def test_held_out_agreement(spark):
    """Held-out texts of both kinds are told apart."""
    from tillscope.catalog import QUERIES
    from tillscope.lakehouse import lakehouse

    lake = lakehouse(spark, "/root/testdata/sf0.1")
    share = {r.good: r.right_pct for r in QUERIES["quality_sentiment_agreement"](lake).collect()}
    assert share[True] > 95 and share[False] > 55


def test_row_checks_need_no_shuffle_by_key(lake):
    tables = lake.bronze
    contract = quality.Contract(key=("transaction_id",), not_null=("amount",), ranges={"amount": (0, 9)})
    _, rows = quality._table_report("transactions", tables.transactions, contract, {})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("Exchange SinglePartition") == 1
