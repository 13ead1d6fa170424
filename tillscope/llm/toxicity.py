"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability from a logistic model
of its words; the document's is their noisy-or, 1 - prod(1 - p). Only documents have
labels: the gradient of the document's likelihood reaches the sentences through the
noisy-or, so sentences that explain a toxic label are found without being marked. A
score counts only sentences whose words raise them above the bias: else any text that is
long enough would be toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import need
from tillscope.sources.lake import stage

SENTENCE = re.compile(r"[^.!?\n。]*[.!?\n。]*\s*")
TOKEN = re.compile(r"\w+")
PREFIXES = (4, 5, 6, 7, 8)


def features(word: str) -> list[str]:
    """A lower-case word and its beginnings, so that inflected and compound forms share evidence."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def held_out(id_col: str) -> Column:
    """Rows no label is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Model:
    """Feature weights; a sentence scores ``bias`` plus the weights of its distinct features."""

    weights: dict[str, float]
    bias: float


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int
) -> DataFrame:
    """text and y of at most ``most`` labelled rows, chosen by hash, none of them held out.

    The bound makes the labels small enough to send to all tasks, whatever the tables' size.
    """
    chosen = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label_col).cast("double")).alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "_id").select("text", "y")


def _count(batches):
    """Documents with each feature, by label; partial counts leave before they grow large."""
    held: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def out():
        rows = [(f, int(n * (1 - y)), int(n * y)) for y, c in held.items() for f, n in c.items()]
        for c in held.values():
            c.clear()
        return pa.RecordBatch.from_pandas(
            pd.DataFrame(rows, columns=["feature", "clean", "toxic"]).astype({"clean": "int64", "toxic": "int64"}),
            pa.schema([("feature", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]), preserve_index=False,
        )

    for batch in batches:
        for text, y in zip(batch["text"], batch["y"]):
            found = {f for w in set(TOKEN.findall(text.as_py().lower())) for f in features(w)}
            held[int(y.as_py() > 0)].update(found)
            if len(held[0]) + len(held[1]) > 300_000:
                yield out()
    yield out()


def choose(rows: DataFrame, kept: int, least: float) -> tuple[pd.DataFrame, float, float]:
    """Features whose document counts differ most between labels, and the label counts.

    ``kept`` features at the most, each ``least`` standard deviations away from equal shares.
    """
    sums = rows.agg(F.count_if(F.col("y") > 0), F.count_if(F.col("y") <= 0)).first()
    toxic, clean = float(sums[0]), float(sums[1])
    counts = (
        rows.mapInArrow(_count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    both = F.col("clean") + F.col("toxic")
    share = both / F.lit(toxic + clean)
    # Signed root of the 2 x 2 chi-square statistic.
    strength = (F.col("toxic") - share * toxic) / F.sqrt(share * (1 - share) * toxic * clean / (toxic + clean) + 1.0)
    best = (
        counts.filter(F.abs(strength) >= least).orderBy(F.abs(strength).desc(), "feature").limit(kept).toPandas()
        if toxic and clean
        else pd.DataFrame({"feature": [], "clean": [], "toxic": []})
    )
    return best, toxic, clean


def _sentences(text: str):
    """Spans of the sentences of a text; an empty text is one empty sentence."""
    spans = [m.span() for m in SENTENCE.finditer(text) if m.end() > m.start()]
    return spans or [(0, 0)]


def _bags(index: dict[str, int]):
    def run(batches):
        for batch in batches:
            ys, empty, flat, cuts = [], [], [], []
            for text, y in zip(batch["text"], batch["y"]):
                low, none, ids, ends = text.as_py(), 0, [], []
                for a, b in _sentences(low):
                    found = {index[f] for w in TOKEN.findall(low[a:b].lower()) for f in features(w) if f in index}
                    if found:
                        ids.extend(sorted(found))
                        ends.append(len(ids))
                    else:
                        none += 1
                ys.append(float(y.as_py() > 0)), empty.append(none), flat.append(ids), cuts.append(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ys, pa.float64()), pa.array(empty, pa.int64()), pa.array(flat, pa.list_(pa.int32())),
                 pa.array(cuts, pa.list_(pa.int32()))], ["y", "plain", "ids", "ends"],
            )

    return run


def gradient(bags: pd.DataFrame, w: np.ndarray, bias: float) -> np.ndarray:
    """Gradient of the summed negative log-likelihood; the bias is last."""
    g = np.zeros(len(w) + 1)
    if not len(bags):
        return g
    y, plain = bags["y"].to_numpy(), bags["plain"].to_numpy()
    ends = [np.asarray(e, np.int64) for e in bags["ends"]]
    per_bag = np.array([len(e) for e in ends])
    sizes = np.concatenate([np.diff(e, prepend=0) for e in ends]) if per_bag.sum() else np.zeros(0, np.int64)
    ids = np.concatenate([np.asarray(i, np.int64) for i in bags["ids"]]) if per_bag.sum() else np.zeros(0, np.int64)
    sentence, bag = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.arange(len(y)), per_bag)
    z = bias + np.bincount(sentence, w[ids], len(sizes)) if len(sizes) else np.zeros(0)
    p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
    miss = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)) + plain * np.log1p(-p0)
    pull = 1 - y / np.maximum(-np.expm1(miss), 1e-12)
    dz = p * pull[bag]
    if len(ids):
        g[:-1] = np.bincount(ids, dz[sentence], len(w))
    g[-1] = dz.sum() + (plain * p0 * pull).sum()
    return g


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most: int = 20_000,
    kept: int = 1024,
    least: float = 4.0,
    rounds: int = 40,
    rate: float = 0.2,
) -> Model:
    """Weights from at most ``most`` labelled documents and their whole texts.

    Features are chosen by their document counts. Each round is one Spark job that adds
    up gradients over the bags; the driver sees ``kept`` + 1 numbers. Without labels of
    both kinds the model is a constant for a document of any length: above one half if
    all labels are toxic, else below.
    """
    need(docs, id_col, text_col)
    need(labels, id_col, label_col)
    rows = stage(training_rows(docs, labels, id_col, text_col, label_col, most), "labelled")
    best, toxic, clean = choose(rows, kept, least)
    if not (toxic and clean):
        return Model({}, 6.0 if toxic else -6.0)
    names, pos, neg = best["feature"].tolist(), best["toxic"].to_numpy(float), best["clean"].to_numpy(float)
    bags = stage(
        rows.mapInArrow(_bags({f: k for k, f in enumerate(names)}), "y double, plain long, ids array<int>, ends array<int>"),
        "bags",
    )
    # Start from half the log-odds, taken back by a standard error: a word brings several features.
    odds = np.log((pos + 0.5) / (toxic + 1)) - np.log((neg + 0.5) / (clean + 1))
    w = np.sign(odds) * np.maximum(0, np.abs(odds) - np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))) / 2
    theta, m, v = np.append(w, -6.0), 0.0, 0.0
    for step in range(1, rounds + 1):
        at = theta.copy()

        def part(batches, at=at):
            g = np.zeros(len(at))
            for batch in batches:
                g += gradient(batch.to_pandas(), at[:-1], at[-1])
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.list_(pa.float64()))], ["g"])

        parts = bags.mapInArrow(part, "g array<double>").select(F.posexplode("g").alias("k", "x"))
        sums = parts.groupBy("k").agg(F.sum("x").alias("x")).toPandas()
        g = np.zeros(len(theta))
        g[sums["k"].to_numpy()] = sums["x"].to_numpy()
        g /= toxic + clean
        m, v = 0.8 * m + 0.2 * g, 0.95 * v + 0.05 * g * g
        theta -= rate * (m / (1 - 0.8**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-4)
    return Model({f: float(x) for f, x in zip(names, theta) if x}, float(theta[-1]))


class _Words(dict):
    """Features that a word brings, with weights; forgets before it grows large."""

    def __init__(self, weights):
        self.weights = weights

    def __missing__(self, word):
        if len(self) > 100_000:
            self.clear()
        self[word] = found = {f: self.weights[f] for f in features(word) if f in self.weights}
        return found


def bag_score(text: str, known: _Words, bias: float) -> tuple[float, list[tuple[int, int, float]]]:
    """Noisy-or of the sentences with evidence above the bias, and those of one half or more with their places.

    Without any weights the score is the bias's, however many sentences there are.
    """
    if not known.weights:
        return float(1 / (1 + np.exp(-bias))), []
    miss, bad = 0.0, []
    for a, b in _sentences(text):
        found: dict[str, float] = {}
        for w in TOKEN.findall(text[a:b].lower()):
            if hit := known[w]:
                found |= hit
        evidence = sum(x for _, x in sorted(found.items()))
        if evidence <= 0:
            continue
        z = bias + evidence
        miss -= np.logaddexp(0, z)
        if z >= 0:
            bad.append((a, b, float(1 / (1 + np.exp(-z)))))
    return float(-np.expm1(miss)), bad


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: identifier, ``score``, ``predicted``, and the offending sentences as character spans.

    NULL and empty texts are one empty sentence. Repeated rows get equal rows. An empty
    table gives an empty result; other columns are not read.
    """
    need(docs, id_col, text_col)
    weights, bias = model.weights, model.bias
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches):
        known = _Words(weights)
        for batch in batches:
            scores, bad = [], []
            for text in batch["text"]:
                s, b = bag_score(text.as_py() or "", known, bias)
                scores.append(s), bad.append([dict(zip(("start", "end", "score"), x)) for x in b])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array(bad, pa.list_(span))], ["id", "score", "predicted", "offending"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = f"id {kind}, score double, predicted int, offending array<struct<start: int, end: int, score: double>>"
    return rows.mapInArrow(run, made).withColumnRenamed("id", id_col)


def clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with all their columns."""
    need(docs, text_col)
    weights, bias = model.weights, model.bias

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        known = _Words(weights)
        return pd.Series([bag_score(t or "", known, bias)[0] < 0.5 for t in texts], dtype=bool)

    return docs.filter(passes(F.col(text_col).cast("string")))
