"""Repeated passages by level-wise doubling.

Word windows are hashed by doubling: the hash of a window of twice the length comes from
the hashes of its two halves. The first level looks at windows of half the length that
counts, and of these only at the smallest hash in every full window (its representative),
so a small share of all places is shuffled. Only windows whose representative is
repeated anywhere are extended to twice the length and looked at themselves; with
``longest`` beyond ``window`` the repeated ones are extended again until none survive.

Places of one hash are gathered inside a task before they are shuffled, so a passage
that stands in a third of all documents brings one row per task and slice, not per place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import keyed_by_content, need, slices

_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHARS = 4_000_000
_ASK = "h long, n int, key long, pos int, more array<struct<key: long, pos: int>>"


def split(text: str | None) -> list[bytes]:
    """Words: runs of anything but ASCII white space, in UTF-8."""
    return (text or "").encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    flat = np.empty(len(words), dtype=object)
    flat[:] = words
    return pd.util.hash_array(flat, categorize=False)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def doubled(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` from the hashes of single words."""
    held, out, got = h, None, 0
    size = 1
    while True:
        if length & size:
            if out is None:
                out, got = held, size
            else:
                n = max(0, len(h) - got - size + 1)
                out, got = _mixed(out[:n] * _STEP + held[got : got + n]), got + size
        if size * 2 > length:
            return out
        n = max(0, len(held) - size)
        held = _mixed(held[:n] * _STEP + held[size : size + n] + np.uint64(size))
        size *= 2


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every ``width`` consecutive values."""
    size, held = 1, h
    while size * 2 <= width:
        held = np.minimum(held[: len(held) - size], held[size:])
        size *= 2
    n = max(0, len(h) - width + 1)
    return np.minimum(held[:n], held[width - size : width - size + n])


def representatives(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """By half window its hash; by full window the smallest of the half windows in it."""
    half = (window + 1) // 2
    halves = doubled(h, half)
    return halves, _least(halves, window - half + 1) if len(h) >= window else np.zeros(0, np.uint64)


def _asks(h: np.ndarray, key: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """One row per hash: how often it stands here (2 for more), its first place, and the others."""
    order = np.argsort(h, kind="stable")
    h, key, pos = h[order].view(np.int64), key[order], pos[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(h)))
    rest = np.ones(len(h), bool)
    rest[first] = False
    others = pa.StructArray.from_arrays([pa.array(key[rest]), pa.array(pos[rest])], ["key", "pos"])
    ends = np.append(0, np.cumsum(sizes - 1)).astype(np.int32)
    alone = np.append(sizes == 1, False)
    more = pa.ListArray.from_arrays(pa.array(ends, mask=alone), others)
    return pa.RecordBatch.from_arrays(
        [pa.array(h[first]), pa.array(np.minimum(sizes, 2).astype(np.int32)), pa.array(key[first]),
         pa.array(pos[first]), more], ["h", "n", "key", "pos", "more"],
    )


def _flat(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Asks of several texts, each (key, hashes, places)."""
    hs = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint64)
    keys = np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts])
    places = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64)
    return _asks(hs, keys, places.astype(np.int32))


def _first_level(window: int):
    def run(batches):
        for batch in batches:
            texts, keys = batch["text"].to_pylist(), batch["key"].to_pylist()
            for a, b in slices((len(t or "") for t in texts), _CHARS):
                parts = []
                for key, text in zip(keys[a:b], texts[a:b]):
                    words = split(text)
                    if len(words) < window:
                        continue
                    halves, least = representatives(word_hashes(words), window)
                    # A place is a representative if it is the smallest in a full window that holds it.
                    span = window - (window + 1) // 2
                    wide = np.concatenate([np.zeros(span, np.uint64), least, np.zeros(span, np.uint64)])
                    chosen = np.flatnonzero(halves == ~_least(~wide, span + 1))
                    parts.append((key, halves[chosen], chosen))
                yield _flat(parts)

    return run


def _next_level(window: int, length: int):
    """Full windows of ``length`` whose windows of the level before are repeated."""

    def run(batches):
        for batch in batches:
            texts, keys, marks = batch["text"].to_pylist(), batch["key"].to_pylist(), batch["marks"]
            for a, b in slices((len(t or "") for t in texts), _CHARS):
                parts = []
                for k in range(a, b):
                    words, at = split(texts[k]), marks[k].values.to_numpy()
                    if len(words) < length:
                        continue
                    h = word_hashes(words)
                    if length == window:
                        halves, least = representatives(h, window)
                        starts = np.flatnonzero(np.isin(least, halves[np.unique(at)]))
                    else:
                        on = np.zeros(len(words) + length, bool)
                        on[at] = True
                        starts = np.flatnonzero(on[: len(words) - length + 1] & on[length // 2 :][: len(words) - length + 1])
                    parts.append((keys[k], doubled(h, length)[starts], starts))
                yield _flat(parts)

    return run


def _repeated(asks: DataFrame) -> DataFrame:
    """key and the distinct places, as ``marks``, of the hashes that stand in more than one place."""
    total = F.sum("n").over(Window.partitionBy("h"))
    hit = asks.withColumn("_total", total).filter("_total > 1")
    first = F.array(F.struct("key", "pos"))
    places = F.explode(F.when(F.col("more").isNull(), first).otherwise(F.concat(first, "more"))).alias("p")
    return hit.select(places).groupBy("p.key").agg(F.collect_set("p.pos").alias("marks"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, text and id; every join takes all three, so that the texts are shuffled once for all of them.

    Equal texts have equal results, so a number that they share stands for the text.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    return keyed_by_content(rows, "key", F.coalesce("text", F.lit(""))).select("key", "text", "id")


def repeats(texts: DataFrame, window: int = 35, longest: int | None = None) -> list[tuple[int, DataFrame]]:
    """For each level from ``window`` on: its length, and (key, marks), the starts of repeated windows of ``keyed`` texts.

    Windows are compared by 64-bit hashes. Copies of one text count as places of their
    own. ``longest`` extends repeated windows to twice the length up to that bound.
    """
    marks = _repeated(texts.select("key", "text").mapInArrow(_first_level(window), _ASK))
    out, length = [], window
    while length <= max(window, longest or 0):
        marks = _repeated(texts.join(marks, "key").mapInArrow(_next_level(window, length), _ASK))
        out.append((length, marks))
        if longest and marks.isEmpty():
            break
        length *= 2
    return out


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window from one of ``starts``."""
    edge = np.zeros(n + window + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.asarray(starts) + window, -1)
    return np.cumsum(edge)[:n] > 0


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, with_text: bool = True
) -> DataFrame:
    """Per row of ``docs``: identifier, n_words, n_removed, kept_sha256, removed spans and the kept text.

    Every word in a window of ``window`` words that also starts elsewhere, in the same
    document or another, is removed; windows are judged on the input. ``spans`` are
    (first word, end) of what was removed. Kept words are joined by one space. NULL and
    empty texts have no words. Rows repeated count as copies of each other. An empty
    table gives an empty result; other columns are not read.
    """
    need(docs, id_col, text_col)
    texts = keyed(docs, id_col, text_col)
    ((_, marks),) = repeats(texts, window)
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows: list[list] = [[] for _ in range(5)]
            for text, starts in zip(batch["text"], batch["marks"]):
                words = split(text.as_py())
                gone = np.zeros(len(words), bool)
                if starts.is_valid and words:
                    gone = covered(len(words), starts.values.to_numpy(), window)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if gone.any() else b" ".join(words)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2)
                row = (
                    len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                    [{"first": int(x), "end": int(y)} for x, y in edges], kept.decode() if with_text else None,
                )
                for c, x in zip(rows, row):
                    c.append(x)
            span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(span), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *(pa.array(c, k) for c, k in zip(rows, kinds))],
                ["id", "n_words", "n_removed", "kept_sha256", "spans", "kept_text"],
            )

    made = (
        f"id {kind}, n_words long, n_removed long, kept_sha256 string, "
        "spans array<struct<first: long, end: long>>, kept_text string"
    )
    out = texts.join(marks, "key", "left").mapInArrow(run, made)
    return (out if with_text else out.drop("kept_text")).withColumnRenamed("id", id_col)
