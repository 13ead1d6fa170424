"""Terms against counting by hand; topics by invariants."""

import re
from collections import Counter

from tillscope.models import supervised


def test_terms_of_every_script(spark):
    texts = ["Für élève für", "日本語 a x1yy", None, "", "été für", "für"]
    got = {r.term: (r.documents, r.occurrences) for r in supervised.terms(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    found = [re.findall(r"[^\W\d_]{2,}", (t or "").lower()) for t in texts]
    documents, every = Counter(w for ws in found for w in set(ws)), Counter(w for ws in found for w in ws)
    assert got == {w: (documents[w], every[w]) for w in every}


def test_topics_part_texts_of_different_words(spark):
    """Every text has one topic and a weight; two vocabularies without a common word get different topics."""
    rows = [(i, " ".join([f"{'left' if i % 2 else 'right'}{w}" for w in "abcdef"] * 5)) for i in range(40)] + [(99, None)]
    got = supervised.topic_model(spark.createDataFrame(rows, "doc_id int, text string"), topics=2, rounds=20).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    assert all(0 <= r.topic < 2 and (0 < r.weight <= 1) == (r.doc_id != 99) for r in got)
    sides = [{r.topic for r in got if r.doc_id != 99 and r.doc_id % 2 == side} for side in (0, 1)]
    assert len(sides[0]) == len(sides[1]) == 1 and sides[0] != sides[1]
