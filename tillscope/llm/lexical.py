"""Ranked lexical search that scores equal documents once.

Only the terms of the query items matter, so each document shrinks to the counts of those
terms and to m, which stands for its length. Documents with the same counts and the same m
score alike for every item: they are one class, found by a hash and verified by the counts
themselves. Classes are scored block by block against all items, and the members of the
best classes are laid out by ascending identifier.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import ascii_lower, need, numbered, slices
from tillscope.sources.lake import stage

#: Terms are runs of ASCII letters and digits and of anything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NO_ID = 2**63 - 1  # rows without identifier come last
_CELLS = 2_000_000  # scores held at once: classes of a slice times items


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By byte: whether it belongs to a term, and the byte with A-Z lower-cased."""
    every = np.arange(256)
    upper = (every >= 65) & (every <= 90)
    inside = ((every >= 48) & (every <= 57)) | upper | ((every >= 97) & (every <= 122)) | (every >= 128)
    return inside, np.where(upper, every + 32, every).astype(np.uint8)


def bags(texts: list[bytes], vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of each text; rows, term numbers and counts of its terms in ``vocabulary``."""
    inside, lower = _letters()
    blob = np.frombuffer(b"\0".join(texts), np.uint8)
    held = inside[blob]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], held, [False]]).astype(np.int8)))
    first, size = edge[::2], edge[1::2] - edge[::2]
    begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    row = np.searchsorted(begin, first, "right") - 1
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    terms = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(lower[blob[held]])]
    ).dictionary_encode()
    known = pc.fill_null(pc.index_in(terms.dictionary, value_set=vocabulary), -1).to_numpy()
    number = known[terms.indices.to_numpy()].astype(np.int64)
    wide = max(1, len(vocabulary))
    cells, counts = np.unique((row * wide + number)[number >= 0], return_counts=True)
    return np.bincount(row, minlength=len(texts)), cells // wide, cells % wide, counts


def _restricted(docs: DataFrame, vocabulary: list[bytes], slice_bytes: int) -> DataFrame:
    """Rows with at least one term: ``_rid``, ``_id``, ``n`` and the counts of vocabulary terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        words = pa.array(shared.value, pa.binary())
        for batch in batches:
            texts = [t or b"" for t in batch["text"].cast(pa.large_binary()).to_pylist()]
            for a, b in slices(map(len, texts), slice_bytes):
                n, row, number, counts = bags(texts[a:b], words)
                ends = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (number, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch["_rid"].slice(a, b - a), batch["_id"].slice(a, b - a), pa.array(n.astype(np.int64)), *lists],
                    ["_rid", "_id", "n", "terms", "counts"],
                )

    schema = "_rid long, _id long, n long, terms array<int>, counts array<int>"
    return docs.mapInArrow(run, schema).where("n > 0")


class Postings:
    """Which items hold a term, how often, and what the term weighs."""

    def __init__(self, items: np.ndarray, terms: np.ndarray, times: np.ndarray, weights: np.ndarray, n_items: int):
        order = np.argsort(terms, kind="stable")
        self.items, self.times = items[order], times[order]
        self.first = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.weights, self.n_items = weights, n_items

    def scores(self, m: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Scores of all rows for all items. ``row``, ``term`` and ``tf`` are the rows' counts."""
        part = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        size = self.first[term + 1] - self.first[term]
        upto = np.cumsum(size)
        at = np.repeat(self.first[term] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
        out = np.zeros(len(m) * self.n_items, np.int64)
        np.add.at(out, np.repeat(row, size) * self.n_items + self.items[at], np.repeat(part, size) * self.times[at])
        return out.reshape(len(m), self.n_items)


class Best:
    """The ``k`` best classes of each item so far: by score, then by smallest member."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.ones(n_items, np.int64)  # scores below the floor cannot enter
        self.rows = np.zeros((4, 0), np.int64)  # item, score, smallest member, class

    def add(self, scores: np.ndarray, member: np.ndarray, number: np.ndarray) -> None:
        if len(scores) >= self.k:
            at = len(scores) - self.k
            self.floor = np.maximum(self.floor, np.partition(scores, at, axis=0)[at])
        row, item = np.nonzero(scores >= self.floor)
        found = np.stack([item, scores[row, item], member[row], number[row]])
        rows = np.concatenate([self.rows, found], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        nth = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        self.rows = rows[:, nth < self.k]
        full = self.rows[:, (nth[nth < self.k]) == self.k - 1]
        self.floor[full[0]] = np.maximum(self.floor[full[0]], full[1])


def _best_classes(classes: DataFrame, postings: Postings, item_rows: np.ndarray, k: int) -> DataFrame:
    """Per task the ``k`` best classes of each item."""
    shared = classes.sparkSession.sparkContext.broadcast((vars(postings), item_rows))

    def run(batches):
        fields, rows = shared.value
        mine = Postings.__new__(Postings)
        vars(mine).update(fields)
        best = Best(mine.n_items, k)
        for batch in batches:
            step = max(1, _CELLS // max(1, mine.n_items))
            for a in range(0, len(batch), step):
                part = batch.slice(a, step)
                m, member, number = (part[c].to_numpy() for c in ("m", "_id", "class"))
                row = np.repeat(np.arange(len(m)), pc.list_value_length(part["terms"]).to_numpy())
                term, tf = (part[c].flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
                best.add(mine.scores(m, row, term, tf), member, number)
        item, score, _, number = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(rows[item]), pa.array(number), pa.array(score)], ["item", "class", "score"])

    return classes.mapInArrow(run, "item long, class long, score long")


def _blocks(wanted: DataFrame, most: int) -> list[Column]:
    """Conditions that split the items so that each part has at most ``most`` terms; one item may have more."""
    total = wanted.count()
    fine = 64 * math.ceil(total / most) if total > most else 1
    if fine == 1:
        return [F.lit(True)]
    bucket = F.pmod(F.xxhash64("_rid"), F.lit(fine))
    sizes = {r.b: r["count"] for r in wanted.groupBy(bucket.alias("b")).count().collect()}
    return [(bucket >= a) & (bucket < b) for a, b in slices([sizes.get(k, 0) for k in range(fine)], most)]


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_terms: int = 1_000_000,
    slice_bytes: int = 4_000_000,
) -> DataFrame:
    """Per row of ``items`` its ``k`` best rows of ``docs``: the item, ``rank``, the document, ``score``.

    Every document is scored for every item. A term weighs floor(1000 ln((2N+2)/(2df+1))),
    a document's m is 25 + (75 n N) div L, and its score the sum over the item's terms, with
    repeats, of weight x ((10^9 tf) div (1000 tf + 8 m)). N counts the documents with a term,
    L all their terms, n one document's, df those that hold the term. Only A-Z are lower-cased.
    Equal scores go by ascending identifier, rows without one last; scores of 0 are left out.

    A NULL text has no terms. Repeated rows, of either table, are rows of their own: a repeated
    item gets its ranking again under the same identifier. Empty tables give an empty result.
    Document identifiers are whole numbers. Items are taken in blocks of ``most_terms`` distinct terms,
    and only these go to the executors; a class keeps its ``k`` smallest identifiers, as no
    others can be among the ``k`` best.
    """
    need(docs, id_col, text_col)
    need(items, item_col, item_text_col)
    spark = docs.sparkSession
    asked = numbered(items, "items", F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    terms = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))
    wanted = stage(
        asked.select("_rid", F.explode(terms).alias("term")).groupBy("_rid", "term").agg(F.count(F.lit(1)).alias("times")),
        "item-terms",
    )
    source = docs.select(
        F.monotonically_increasing_id().alias("_rid"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    found = None
    for block in _blocks(wanted, most_terms):
        part = _search_block(source, wanted.where(block), k, slice_bytes)
        found = part if found is None else found.unionByName(part)
    kind = docs.schema[id_col].dataType
    return found.join(asked.select(F.col("_rid").alias("item"), "item_id"), "item").select(
        F.col("item_id").alias(item_col),
        "rank",
        F.when(F.col("_id") != _NO_ID, F.col("_id")).cast(kind).alias(id_col),
        "score",
    )


def _search_block(source: DataFrame, wanted: DataFrame, k: int, slice_bytes: int) -> DataFrame:
    asked = wanted.toArrow()  # at most as many rows as a block may have
    words = asked["term"].cast(pa.large_binary()).combine_chunks().dictionary_encode()
    rows, item = np.unique(asked["_rid"].to_numpy(), return_inverse=True)
    bag = stage(_restricted(source, words.dictionary.to_pylist(), slice_bytes), "bags")
    total = bag.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    holding = np.zeros(len(words.dictionary), np.int64)
    for r in bag.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        holding[r.term] = r["count"]
    weights = [math.floor(1000 * math.log((2 * total.N + 2) / (2 * df + 1))) for df in holding.tolist()]
    postings = Postings(
        item, words.indices.to_numpy().astype(np.int64), asked["times"].to_numpy(), np.array(weights, np.int64), len(rows)
    )
    # One row per document at first; of a class only the k smallest identifiers travel.
    key = ["h", "m", "terms", "counts"]
    by_id = Window.partitionBy(*key).orderBy("_id", "_rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = stage(
        bag.where(F.size("terms") > 0)
        .withColumn("m", F.expr(f"25L + (75L * n * {total.N}L) div {total.L or 1}L"))
        .withColumn("h", F.xxhash64("m", "terms", "counts"))
        .withColumn("place", F.row_number().over(by_id))
        .withColumn("class", F.first("_rid").over(by_id))
        .where(F.col("place") <= k)
        .select("class", "place", "_id", "m", "terms", "counts"),
        "classes",
    )
    ahead = Window.partitionBy("item").orderBy(F.desc("score"), "_id")
    best = _best_classes(members.where("place = 1"), postings, rows, k)
    return (
        best.join(members.select("class", "_id"), "class")
        .withColumn("rank", F.row_number().over(ahead))
        .where(F.col("rank") <= k)
        .select("item", "rank", "_id", "score")
    )
