"""Lexical search against plain scoring of every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from tillscope.llm import lexical

ITEMS = "item_id long, text string, `_rid` string, `item` string, `class` string, `rank` string, `score` string, term string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, b, sum(b.values())) for i, b in bags if b]
    big, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, b, _ in held for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b, n in held:
            m = 25 + (75 * n * big) // total
            score = sum(
                math.floor(1000 * math.log((2 * big + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
                for t in terms(text)
                if b[t]
            )
            if score > 0:
                scored.append((-score, 2**63 if i is None else i))
        out += [(item, r + 1, None if i == 2**63 else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def run(documents, spark, docs, items, **more):
    asked = spark.createDataFrame([(*r, *["x"] * 6) for r in items], ITEMS)
    rows = lexical.search(documents(docs), asked, **more).collect()
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in rows)


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(2)
    words = ["Alpha", "beta", "gamma7", "ñandú", "Émile", "x1", "日本", "the", "of", "omega"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 8)))) for i in range(120)]
    # Copies up to order and other words, in hot classes; ties; NULL, empty and long texts; repeated rows.
    docs += [(1000 - i, "the ALPHA, beta! zzz") for i in range(60)] + [(2000 + i, "yyy beta alpha the") for i in range(60)]
    docs += [(3000, None), (3001, ""), (3002, " .,; "), (3003, "beta " * 30_000), (5, docs[5][1]), (None, "alpha omega")]
    items = [(i, " ".join(rng.choices(words + ["unseen"], k=rng.randint(1, 12)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "nothing here known"), (3, items[3][1]), (None, "alpha"), (7, "beta beta beta")]
    return docs, items


@pytest.mark.parametrize("more", [{}, {"k": 3, "slice_bytes": 40}, {"k": 1, "most_terms": 9}])
def test_against_plain_scoring(documents, spark, mixed, more):
    docs, items = mixed
    assert run(documents, spark, docs, items, **more) == brute(docs, items, more.get("k", 10))


def test_small_slices_of_classes(documents, spark, mixed, monkeypatch):
    monkeypatch.setattr(lexical, "_CELLS", 90)  # three classes at a time
    docs, items = mixed
    assert run(documents, spark, docs, items) == brute(docs, items, 10)


def test_empty_tables(documents, spark, mixed):
    docs, items = mixed
    assert not run(documents, spark, [], items) and not run(documents, spark, docs, [])
    assert not run(documents, spark, [(1, None)], items)


def test_equal_bags_are_one_class(documents, spark, mixed, monkeypatch):
    """Order, case and words that no item has make no class of their own, and no more than k members travel."""
    seen = {}
    kept = lexical.stage
    monkeypatch.setattr(lexical, "stage", lambda df, name, *a, **b: seen.setdefault(name, kept(df, name, *a, **b)))
    run(documents, spark, [(i, f"{'beta Alpha' if i % 2 else 'alpha beta'} w{i}") for i in range(500)], [(1, "alpha beta")])
    assert seen["classes"].where("place = 1").count() == 1 and seen["classes"].count() == 10


def test_a_shared_hash_joins_no_classes(documents, spark, mixed, monkeypatch):
    monkeypatch.setattr(lexical.F, "xxhash64", lambda *columns: lexical.F.lit(7).cast("long"))
    docs, items = mixed
    assert run(documents, spark, docs, items) == brute(docs, items, 10)
