"""Byte pairs against the tiktoken library and against merging word by word."""

import base64
import random

import numpy as np
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tillscope.llm import byte_pairs
from tillscope.llm.queries import QUERIES, RANK_FILE


@pytest.fixture(scope="module")
def v():
    return byte_pairs.ranks(RANK_FILE)


@pytest.fixture(scope="module")
def entries():
    with open(RANK_FILE, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@pytest.fixture(scope="module")
def library(entries):
    return tiktoken.Encoding("own", pat_str=byte_pairs.PATTERN, mergeable_ranks=entries, special_tokens={})


BITS = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "l", "e", "a", "1", "٣", "é", "日", "!", "..", "\x1c", "\x85",
        "\xa0", "𝔸", "😀", "r", "the", "aaaa", "ab", "<|endoftext|>"]


def starts(v, texts):
    lengths = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    fresh = np.zeros(len(points), bool)
    fresh[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    return byte_pairs.word_starts(v.kinds, points, fresh)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BITS), max_size=12).map("".join), min_size=1, max_size=4))
def test_words_are_the_matches_of_the_pattern(v, texts):
    if "".join(texts):
        want, at = [], 0
        for t in texts:
            want += [at + m.start() for m in regex.finditer(byte_pairs.PATTERN, t)]
            at += len(t)
        assert starts(v, texts).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(), st.lists(st.sampled_from(BITS)).map("".join)), min_size=1, max_size=6))
def test_same_ids_as_the_library(v, library, texts):
    ids, counts = byte_pairs.Encoder(v).encode(texts)
    want = [library.encode_ordinary(t) for t in texts]
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]


def plain(word, entries):
    """Merge the leftmost pair of lowest rank until none is left."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        found = [(entries[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in entries]
        if not found:
            return [entries[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_replay_equals_merging_word_by_word(v, entries):
    """Long runs, chains of one letter, and ranks that bring about lower ones."""
    rng = random.Random(3)
    early = [i for i in np.flatnonzero(v.early)]
    tokens = {i: t for t, i in entries.items()}
    words = [b"a" * n for n in range(1, 40)] + [b"ab" * n for n in range(1, 20)]
    words += [b"".join(tokens[rng.choice(early)] for _ in range(rng.randint(1, 5))) for _ in range(600)]
    words += [bytes(rng.choice(b"etaoin s") for _ in range(rng.randint(1, 200))) for _ in range(100)]
    ids, sizes = byte_pairs.replay(v, np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]))
    ends = np.cumsum(sizes)
    got = [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]
    assert got == [plain(w, entries) for w in words]


def test_forgetting_words_changes_nothing(v, library):
    encoder = byte_pairs.Encoder(v, most=3)
    for text in ("one two three four five", "five six seven", "one two", ""):
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_tables(documents, library):
    """NULL, empty, very long and repeated texts, rows without identifier, clashing columns; slices of any size."""
    long = "".join(random.Random(5).choice(BITS) for _ in range(60_000))
    rows = [(1, "it's the\n\n  end"), (2, None), (3, ""), (4, long), (4, long), (None, "no id"), (7, "x" * 5000)]
    docs = documents(rows)
    for most in (50, 2_000_000):
        encoded = byte_pairs.encode(docs, RANK_FILE, slice_chars=most)
        got = {(r.doc_id, None if r.token_ids is None else tuple(r.token_ids)) for r in encoded.collect()}
        assert got == {(i, None if t is None else tuple(library.encode_ordinary(t))) for i, t in rows}
    back = byte_pairs.decode(encoded.withColumnRenamed("doc_id", "id"), RANK_FILE).collect()
    assert sorted((str(r.id), r.decoded) for r in back) == sorted(
        ((str(i), None if t is None else bytearray(t.encode())) for i, t in rows), key=lambda x: (x[0], x[1] or b"")
    )
    assert byte_pairs.encode(documents([]), RANK_FILE).collect() == []
    assert byte_pairs.decode(byte_pairs.encode(documents([]), RANK_FILE), RANK_FILE).collect() == []


def test_decode_stops_at_unknown_ids(spark):
    df = spark.createDataFrame([(1, [60_000])], "doc_id long, token_ids array<int>")
    with pytest.raises(Exception, match="none of the rank file"):
        byte_pairs.decode(df, RANK_FILE).collect()


def test_query_over_the_given_table(spark, sf, library):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_byte_pairs"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
