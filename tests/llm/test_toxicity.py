import random

import numpy as np
import pandas as pd

from tillscope.llm import toxicity


def corpus(n=400):
    rng, rows, labels = random.Random(5), [], []
    words = [f"w{k}" for k in range(300)]
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=8)) + "." for _ in range(rng.randint(1, 9))]
        bad = i % 4 == 0
        if bad:
            k = rng.randrange(len(parts))
            parts[k] = f"you {rng.choice(['vilest', 'rotter', 'cad'])} " + parts[k]
        rows.append((i, " ".join(parts)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_rows_and_sentences(spark, documents):
    rows, labels = corpus()
    docs = documents([*rows, (9001, None), (9002, ""), (None, "you cad w1 w2."), (9003, "w1 w2. " * 40_000)])
    lab = spark.createDataFrame([*labels, (None, 1), (9002, None), (5, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, lab, rounds=25)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) + 4
    held = {r[0] for r in docs.filter(toxicity.held_out("doc_id")).select("doc_id").collect()}
    right = [got[i].predicted == y for i, y in labels if i in held]
    assert len(right) > 40 and np.mean(right) > 0.95
    text = dict(rows)
    for i, y in labels:
        for s in got[i].offending:
            assert s.score >= 0.5 and text[i][s.start : s.end].strip()
        if y and got[i].predicted:
            assert any(text[i][s.start : s.end].startswith("you ") for s in got[i].offending)
    assert all(0 <= r.score <= 1 for r in got.values()) and got[9001].score == got[9002].score
    assert got[None].predicted == 1
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r.predicted for r in got.values())


def test_held_out_labels_are_not_learnt(spark, documents):
    rows, labels = corpus(60)
    docs = documents(rows)
    held = {r[0] for r in docs.filter(toxicity.held_out("doc_id")).select("doc_id").collect()}
    one = spark.createDataFrame([(i, y) for i, y in labels], "doc_id long, toxic int")
    other = spark.createDataFrame([(i, 1 - y if i in held else y) for i, y in labels], "doc_id long, toxic int")
    a, b = toxicity.fit(docs, one, rounds=2), toxicity.fit(docs, other, rounds=2)
    assert a.weights.keys() == b.weights.keys() and np.isclose(a.bias, b.bias)


def test_gradient_is_the_derivative():
    bags = pd.DataFrame({"y": [1.0, 0.0], "plain": [2, 1], "ids": [[0, 1, 1], [1]], "ends": [[1, 3], [1]]})

    def loss(t):
        total = 0.0
        for r in bags.itertuples():
            z, a = [], 0
            for e in r.ends:
                z.append(t[2] + sum(t[i] for i in r.ids[a:e]))
                a = e
            z += [t[2]] * r.plain
            miss = np.prod([1 - 1 / (1 + np.exp(-x)) for x in z])
            total -= np.log(1 - miss) if r.y else np.log(miss)
        return total

    t = np.array([0.3, -0.4, -1.0])
    g = toxicity.gradient(bags, t[:2], t[2])
    for k in range(3):
        d = np.zeros(3)
        d[k] = 1e-6
        assert np.isclose(g[k], (loss(t + d) - loss(t - d)) / 2e-6, atol=1e-5)


def test_no_labels_and_no_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(documents([(1, "a b.")]), none)
    (row,) = toxicity.score(documents([(1, "a b.")]), model).collect()
    assert row.predicted == 0
    assert toxicity.score(documents([]).limit(0), model).collect() == []


def test_length_alone_is_not_toxic(spark, documents):
    rows, labels = corpus(120)
    docs = documents([*rows, (9001, "w1 w2. " * 40_000), (9002, "Nothing known here! " * 40_000), (9003, "you cad w1. " + "w1 w2. " * 40_000)])
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, lab, rounds=25, least=3.0)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert model.weights and [got[k].predicted for k in (9001, 9002, 9003)] == [0, 0, 1]
    assert {r.doc_id for r in toxicity.clean(docs, model).select("doc_id").collect()} >= {9001, 9002}
    # A neutral sentence, or one with evidence against, changes no score.
    known = toxicity._Words({"bad": 4.0, "good": -1.0})
    one = toxicity.bag_score("bad.", known, -5.0)[0]
    assert 0 < one < 0.5 and toxicity.bag_score("bad." + " good. plain." * 10_000, known, -5.0)[0] == one


def test_labels_of_one_kind_give_a_constant(spark, documents):
    docs = documents([(1, "a b."), (2, "a b. " * 5_000), (3, None)])
    for labels, toxic in (([], 0), ([(k, 0) for k in range(1, 9)], 0), ([(k, 1) for k in range(1, 9)], 1)):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        rows = toxicity.score(docs, model).collect()
        assert [r.predicted for r in rows] == [toxic] * 3 and len({r.score for r in rows}) == 1
        assert toxicity.clean(docs, model).count() == 3 * (1 - toxic)
