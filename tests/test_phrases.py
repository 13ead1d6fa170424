"""Phrase mining against counting by hand."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tillscope.text import phrases
from tillscope.text.lexicon import STOP_WORDS


def runs(text):
    run = []
    for token in re.findall(r"[^\W\d_]+|[^\w \t\n\r\f]+|[\d_]+", (text or "").lower()) + ["."]:
        if re.match(r"[^\W\d_]", token) and token not in STOP_WORDS:
            run.append(token)
        else:
            yield run
            run = []


def places(text, longest):
    for run in runs(text):
        for n in range(1, longest + 1):
            for i in range(len(run) - n + 1):
                yield tuple(run[i : i + n])


def brute(texts, longest, least):
    counts = Counter(p for t in texts for p in places(t, longest))
    total = sum(n for p, n in counts.items() if len(p) == 1)
    found = {p: n for p, n in counts.items() if n >= least}
    around = defaultdict(list)
    for p, n in found.items():
        for inner in {p[i:j] for i in range(len(p)) for j in range(i + 1, len(p) + 1)} - {p}:
            around[inner].append(n)
    out = {}
    for p, n in found.items():
        c_value = math.log2(len(p) + 1) * (n - (sum(around[p]) / len(around[p]) if around[p] else 0))
        pmi = math.log2(n / total) - sum(math.log2(counts[w,] / total) for w in p) if len(p) > 1 else 0.0
        bound = pmi / -math.log2(n / total) if len(p) > 1 and n < total else 0.0
        out[" ".join(p)] = (len(p), n, c_value, pmi, c_value * (1 + max(0.0, bound)))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = ["card", "payment", "failed", "the", "été", "größe", "refund", "and", "login", "日本", "42", ",", "x_y"]
    made = [" ".join(rng.choices(words, k=rng.randint(0, 14))) for _ in range(150)]
    return [*made, None, "", "Payment FAILED payment failed payment failed", "the and of", "payment " * 3000]


@pytest.mark.parametrize("longest, least", [(4, 2), (1, 1), (3, 5)])
def test_phrase_table(spark, texts, longest, least):
    df = spark.createDataFrame([(t, "x") for t in texts], "text string, phrase string")
    got = {r.phrase: tuple(r)[1:] for r in phrases.phrase_table(df, longest=longest, least=least).collect()}
    want = brute(texts, longest, least)
    assert got.keys() == want.keys()
    for phrase, row in want.items():
        assert got[phrase] == pytest.approx(row, abs=1e-9), phrase


def test_keywords_are_the_best_phrases_of_each_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = phrases.phrase_table(df)
    score = brute(texts, 4, 2)
    got = {r.id: r.keywords for r in phrases.keywords(df, "id", table).collect()}
    for i, text in enumerate(texts):
        own = {" ".join(p) for p in places(text, 4)} & score.keys()
        best = sorted((-round(score[p][4], 6), p) for p in own if len(p) > 3)[:5]
        assert got[i] == (", ".join(p for _, p in best) or "general")


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, text string")
    table = phrases.phrase_table(df)
    assert table.collect() == [] and phrases.keywords(df, "id", table).collect() == []


@pytest.mark.parametrize("known", [0, 3, 6, 1000])
def test_keywords_do_not_depend_on_the_known_phrases(spark, texts, known):
    """Texts that the best phrases settle and texts that need the whole table get the same keywords."""
    again = [(i % 140, text) for i, text in enumerate(texts)]  # some texts lie in two rows
    df = spark.createDataFrame(again, "id int, text string")
    table = phrases.phrase_table(df)
    score = {r.phrase: round(r.score, 6) for r in table.collect()}
    got = {r.id: r.keywords for r in phrases.keywords(df, "id", table, known=known).collect()}
    for key in range(140):
        own = {" ".join(p) for i, text in again if i == key for p in places(text, 4)} & score.keys()
        best = sorted((-score[p], p) for p in own if len(p) > 3)[:5]
        assert got[key] == (", ".join(p for _, p in best) or "general")
    assert got.keys() == set(range(140))


def test_only_unsettled_texts_are_joined_with_the_whole_table(spark, monkeypatch):
    """Texts with enough of the known phrases do not ship their places."""
    long = "alpha bravo charlie delta echoes "
    df = spark.createDataFrame([(i, long * 40) for i in range(50)] + [(50, "alpha, foxtrot the golf")], "id int, text string")
    table = spark.createDataFrame([(w, 9.0 - i) for i, w in enumerate((long + "foxtrot").split())], "phrase string, score double")
    staged = {}

    def counting(df, name):
        staged[name] = df.count()
        return df

    monkeypatch.setattr(phrases, "stage", counting)
    got = {r.id: r.keywords for r in phrases.keywords(df, "id", table, known=5).collect()}
    assert got == {i: ", ".join(long.split()) for i in range(50)} | {50: "alpha, foxtrot"}
    assert staged["places"] == 3  # alpha, foxtrot and golf (four letters) of the one short text
