"""Licence scan over a positional index of rare words.

Phrases and statements are templates. Their words form a small index of postings
(word, template, place). The document frequency of every index word is counted over
all documents; a template is looked up by its words of highest IDF. Each place of such
a word in a file implies a start of the template; the starts that its other looked-up
words imply as well (the intersection of postings by relative position) are candidates,
and a candidate counts when the template's mandatory phrases stand where they should.
A phrase that stands in a file contains its own rarest words at the right places, so
the look-up loses none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import LOWER, UPPER, need

#: Bytes that end a word become spaces; A-Z become a-z. Other bytes, all of UTF-8 included, stay.
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_BYTES = bytes(
    LOWER.encode()[UPPER.encode().index(b)] if b in UPPER.encode() else b if b in _WORD_BYTES else 0x20
    for b in range(256)
)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    must: tuple[str, ...] = ()  # phrases of the text that a match must hold; none: the whole text
    base: bool = False


#: Phrases with the labels they stand for.
PHRASES = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
)

#: Statements of public licences and common ways to name a version.
STATEMENTS = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted free of charge", "person obtaining a copy")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose",
             ("permission to use copy modify and or distribute this software",)),
)


def split(text: str) -> list[bytes]:
    """The words of a text, lower-cased, in UTF-8."""
    return text.encode().translate(_BYTES).split()


@dataclass
class Index:
    """What a file is looked up in: for each looked-up word its postings (template, place)."""

    postings: dict[bytes, list[tuple[int, int]]]
    lookups: list[int]  # by template: how many of its words are looked up
    words: list[list[bytes]]
    must: list[list[tuple[int, list[bytes]]]]  # by template: phrases with their places
    labels: list[str]
    base: list[bool]
    weight: dict[bytes, float]  # IDF


def _find(phrase: list[bytes], words: list[bytes]) -> int:
    for k in range(len(words) - len(phrase) + 1):
        if words[k : k + len(phrase)] == phrase:
            return k
    raise ValueError(f"a mandatory phrase is not part of its template: {phrase}")


def build(templates: tuple[Template, ...], counts: dict[bytes, int], files: int, looked_up: int = 2) -> Index:
    """Index ``templates`` by their ``looked_up`` mandatory words of highest IDF."""
    index = Index({}, [], [], [], [], [], {})
    for t, template in enumerate(templates):
        words = split(template.text)
        must = [(_find(split(p), words), split(p)) for p in template.must] or [(0, words)]
        index.words.append(words), index.must.append(must)
        index.labels.append(template.label), index.base.append(template.base)
        for w in words:
            index.weight[w] = math.log((files + 1) / (counts.get(w, 0) + 1)) + 1.0
        held = {w for _, p in must for w in p}
        rare = sorted(held, key=lambda w: (-index.weight[w], w))[:looked_up]
        index.lookups.append(len(rare))
        for w in rare:
            # Only places inside mandatory phrases, so that a match is bound to imply its start.
            places = sorted({a + k for a, p in must for k, x in enumerate(p) if x == w})
            index.postings.setdefault(w, []).extend((t, k) for k in places)
    return index


def scan_words(words: list[bytes], index: Index) -> list[tuple[int, int, float]]:
    """Matches (template, start, share of the template's IDF that stands in place), in text order."""
    starts: dict[int, dict[int, set[bytes]]] = {}
    for at, w in enumerate(words):
        for t, k in index.postings.get(w, ()):
            starts.setdefault(t, {}).setdefault(at - k, set()).add(w)
    found = []
    for t, by_start in starts.items():
        for start, seen in by_start.items():
            if len(seen) < index.lookups[t]:
                continue
            if all(start + a >= 0 and words[start + a : start + a + len(p)] == p for a, p in index.must[t]):
                body = index.words[t]
                there = [index.weight[w] for k, w in enumerate(body) if 0 <= start + k < len(words) and words[start + k] == w]
                found.append((t, start, sum(there) / sum(index.weight[w] for w in body)))
    return sorted(found)


def frequencies(docs: DataFrame, text_col: str, templates: tuple[Template, ...]) -> tuple[dict[bytes, int], int]:
    """Documents that hold each index word, and documents in all; the index words are few and fixed."""
    vocabulary = frozenset(w for t in templates for w in split(t.text))

    def count(batches):
        held, n = dict.fromkeys(vocabulary, 0), 0
        for batch in batches:
            for text in batch["text"]:
                n += 1
                for w in vocabulary.intersection(split(text.as_py() or "")):
                    held[w] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in held] + [None], pa.string()), pa.array([*held.values(), n], pa.int64())],
            ["word", "n"],
        )

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    sums = {r.word: r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return {w.encode(): n for w, n in sums.items() if w is not None}, sums.get(None, 0)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[Template, ...] = PHRASES + STATEMENTS,
    looked_up: int = 2,
) -> DataFrame:
    """Per row of ``docs``: identifier, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    ``matches`` lists (label, start word, share). ``score`` is the largest share of a
    match, 0 without any. NULL texts are empty. Repeated rows get equal rows, an empty
    table an empty result, and other columns are not read.
    """
    need(docs, id_col, text_col)
    counts, files = frequencies(docs, text_col, templates)
    index = build(templates, counts, files, looked_up)
    # A byte search for the rare words tells most texts apart before they are indexed.
    rare = [b" " + w + b" " for w in index.postings]
    match = pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())])

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for text in batch["text"]:
                clean = (text.as_py() or "").encode().translate(_BYTES)
                words = clean.split()
                clean = b" " + clean + b" "
                found = scan_words(words, index) if any(r in clean for r in rare) else []
                base = [(t, s) for t, s, _ in found if index.base[t]]
                at = [s for _, s in base]
                row = (
                    len(words), len(base), min(at, default=None), max(at, default=None),
                    ",".join(sorted({index.labels[t] for t, _ in base})),
                    ",".join(sorted({index.labels[t] for t, _, _ in found})),
                    max((x for _, _, x in found), default=0.0),
                    [{"label": index.labels[t], "start": s, "share": x} for t, s, x in found],
                )
                for c, x in zip(cols, row):
                    c.append(x)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(match)]
            names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *(pa.array(c, k) for c, k in zip(cols, kinds))], names
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    made = (
        f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, "
        "matches array<struct<label: string, start: long, share: double>>"
    )
    return rows.mapInArrow(run, made).withColumnRenamed("id", id_col)
