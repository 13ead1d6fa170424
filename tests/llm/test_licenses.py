import re

import pytest

from tillscope.llm import licenses

PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "apache\nLICENSE apache-license xapache license apache licenses",
    "This work is licensed under the GNU General Public License, version 3.", "gnu general public licence gnu gnu general public license",
    "Licensed under CC BY-NC 4.0. cc by cc by", "Released under the MIT License.", "mit mit license mit license éMIT License mit\x00license",
    "nothing here", "", None, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    "filler words " * 30_000 + "MIT license", "cc cc by by cc by",
]


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = []
    for label, phrase in PHRASES.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    at = [k for k, _ in found]
    return (len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))


@pytest.mark.parametrize("looked_up", [1, 2, 3])
def test_base_phrases_match_a_plain_scan(documents, looked_up):
    docs = documents([*enumerate(TEXTS), (0, TEXTS[0]), (None, "mit license")])
    got = licenses.scan(docs, looked_up=looked_up).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "mit license" if r.doc_id is None else TEXTS[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_statements(documents):
    got = {r.doc_id: r.labels for r in licenses.scan(documents(list(enumerate(TEXTS)))).collect()}
    assert got[0] == "apache,apache-2.0" and got[2] == "gpl,gpl-3.0" and got[4] == "cc-by,cc-by-nc-4.0" and got[10] == "mit"


def test_whole_table_matches_a_plain_scan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in licenses.scan(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])


def test_empty(documents):
    assert licenses.scan(documents([]).limit(0)).collect() == []
