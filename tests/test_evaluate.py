"""Ranking figures and calibration against brute force; the models by held-out rows."""

import itertools
import random

import numpy as np
import pytest

from tillscope.models import boosting, evaluate, supervised

SCHEMA = "g string, probability double, label int"


def rows(n=400):
    rng = random.Random(8)
    out = []
    for _ in range(n):
        p = round(rng.random(), rng.choice([1, 4]))
        out.append((rng.choice(["a", "b", None]), p, int(rng.random() < p)))
    return [*out, ("a", None, 1), ("b", 0.5, None), ("one", 0.3, 1)]


def test_ranking_against_all_pairs(spark):
    data = rows()
    got = {r.g: r for r in evaluate.ranking(spark.createDataFrame(data, SCHEMA), ["g"]).collect()}
    for g in {r[0] for r in data}:
        known = [(p, y) for h, p, y in data if h == g and p is not None and y is not None]
        pos, neg = [p for p, y in known if y], [p for p, y in known if not y]
        assert (got[g].positives, got[g].negatives) == (len(pos), len(neg))
        if neg:
            won = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
            assert got[g].auc == pytest.approx(won / len(pos) / len(neg), abs=1e-8)
        else:
            assert got[g].auc is None
        precise = sum(sum(q >= p for q in pos) / sum(q >= p for q, _ in known) for p in pos)
        assert got[g].average_precision == pytest.approx(precise / len(pos), abs=1e-8)
    assert len(got) == 4
    assert evaluate.ranking(spark.createDataFrame([], SCHEMA), ["g"]).collect() == []


def test_calibration_is_the_isotonic_fit(spark):
    data = rows()
    table = evaluate.calibration(spark.createDataFrame(data, SCHEMA), places=2).orderBy("score").collect()
    sizes, hits = [r.n for r in table], [r.positives for r in table]
    assert sum(sizes) == len(data) - 2
    k = len(table)
    for i, r in enumerate(table):
        fit = max(min(sum(hits[a : b + 1]) / sum(sizes[a : b + 1]) for b in range(i, k)) for a in range(i + 1))
        assert r.calibrated == pytest.approx(fit)


def test_scores_between_those_of_the_table(spark):
    table = spark.createDataFrame([(0.2, 0.1), (0.5, 0.4)], "score double, calibrated double")
    asked = spark.createDataFrame([(0.0,), (0.2,), (0.4999,), (0.5,), (1.0,), (None,)], "probability double")
    got = {r.probability: r.calibrated for r in evaluate.calibrate(asked, table).collect()}
    assert got == {0.0: 0.1, 0.2: 0.1, 0.4999: 0.1, 0.5: 0.4, 1.0: 0.4, None: None}
    assert evaluate.calibrate(asked, table.limit(0)).where("calibrated IS NOT NULL").count() == 0


def test_several_classes(spark):
    rng = random.Random(1)
    words = {"card": "visa chip pin", "refund": "money back return", "día": "mañana día tarde"}
    data = [(k, c, " ".join(rng.choices((words[c] + " the a of").split(), k=6))) for k in range(600) for c in [rng.choice([*words])]]
    df = spark.createDataFrame([*data, (1000, None, "visa"), (1001, "card", None)], "id long, c string, text string")
    got = supervised.class_classifier(df, "c", "id").collect()
    assert {r.id for r in got} == {r[0] for r in data} | {1001}
    judged = [r for r in got if r.fold == 0]
    assert len(judged) > 80 and sum(r.hit for r in judged) / len(judged) > 0.9
    assert all(r.hit == (r.label == r.predicted) and 0 < r.probability <= 1 and 0 <= r.calibrated <= 1 for r in got)
    falls = sorted((r.probability, r.calibrated) for r in got)
    assert all(a[1] <= b[1] for a, b in zip(falls, falls[1:]))


def test_boosted_trees_rank_held_out_rows(spark):
    rng = random.Random(4)
    data = [(f"t{k}", rng.random(), rng.random()) for k in range(3000)]
    label = {k: int(x > 0.8 and y > 0.6) for k, x, y in data}
    features = spark.createDataFrame(data, "transaction_id string, x double, y double")
    labels = spark.createDataFrame([*label.items()], "transaction_id string, is_fraud int")
    scored = supervised.boosted_fraud(features, labels, ["x", "y"], rounds=5, depth=3)
    found = {r.held_out: r for r in evaluate.ranking(scored, ["held_out"]).collect()}
    assert found[True].auc > 0.98 and found[True].average_precision > 0.9
    assert found[True].positives + found[False].positives == sum(label.values())
    taken = scored.where("held_out AND label = 1").agg({"predicted": "avg"}).first()[0]
    assert taken > 0.9  # the rare class is not drowned


def test_boosted_trees_do_not_depend_on_the_partitions(spark, monkeypatch):
    rng = random.Random(5)
    data = [(f"t{k}", float(rng.randrange(9)), float(rng.randrange(5)), rng.random()) for k in range(4000)]
    rows = spark.createDataFrame([(*r, int(r[1] > 6 and r[2] > 2)) for r in data], "transaction_id string, x double, y double, z double, is_fraud int")

    def run(parts):
        made = supervised.boosted_fraud(rows.repartition(parts), None, ["x", "y", "z"], rounds=7, depth=2)
        return made.orderBy("transaction_id").collect()

    whole = run(1)
    assert len(whole) == 4000 and all(r.predicted == r.label for r in whole)
    monkeypatch.setattr(boosting, "BLOCK", 300)
    monkeypatch.setattr(boosting, "KEPT", 2)  # margins written on the way change nothing
    assert run(5) == whole


def test_a_tree_takes_the_best_splits():
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 8, (3, 5000)).astype(np.uint8)
    hit = (bins[0] > 5) & (bins[1] > 3)
    weights = (2500 / (~hit).sum(), 2500 / hit.sum())
    pulled = np.where(hit, weights[1], -weights[0])

    def sums(splits, slots):
        at = boosting._place(splits, slots, bins)
        found = np.zeros((3, 3, max(slots.values()), boosting.BINS))
        for slot, f in itertools.product(range(1, max(slots.values()) + 1), range(3)):
            for i, part, w in ((0, at == slot, None), (1, (at == slot) & hit, None), (2, at == slot, pulled)):
                found[i, f, slot - 1] = np.bincount(bins[f][part], w if w is None else w[part], boosting.BINS)
        return found

    splits, slots, values = boosting._grow(sums, weights, 3)
    assert splits == {1: (0, 5), 3: (1, 3)}
    assert [round(float(values[slots[node]]), 9) for node in (2, 6, 7)] == [-1, -1, 1]
