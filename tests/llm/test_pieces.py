import os
from fractions import Fraction

import numpy as np
import pytest

from tillscope.llm import pieces
from tillscope.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no tokenizer file")
TEXTS = ["", "Hello  world\n\n end ", "▁ literal ▁▁ marks", "\t\x00\x0b odd é漢字 😀🏳️‍🌈", "x" * 5000, " " * 300,
         "the the the the", "a\r\nb c d", "word " * 20_000]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(PIECE_MODEL)


def test_decoding_is_lossless(documents):
    docs = documents([*enumerate(TEXTS), (50, None), (None, "no id"), (0, "")])
    rows = pieces.encode(docs, PIECE_MODEL)
    got = rows.collect()
    assert len(got) == len(TEXTS) + 3 and all(r.lossless for r in got)
    assert all((r.piece_ids is None) == (r.doc_id == 50) and r.n_pieces == len(r.piece_ids or []) for r in got)
    back = {r.doc_id: r.text for r in pieces.decode(rows, PIECE_MODEL).collect()}
    assert back == dict(enumerate(TEXTS)) | {50: None, None: "no id"}


def test_runs_agree_and_seeds_differ(documents):
    docs = documents([(k, "reproducible segmentation of sampled pieces " * 3) for k in range(20)])
    a = {r.doc_id: r.piece_ids for r in pieces.encode(docs.repartition(5), PIECE_MODEL).collect()}
    b = {r.doc_id: r.piece_ids for r in pieces.encode(docs.coalesce(1), PIECE_MODEL, slice_chars=50).collect()}
    c = {r.doc_id: r.piece_ids for r in pieces.encode(docs, PIECE_MODEL, seed=8).collect()}
    assert a == b and a != c and len({tuple(x) for x in a.values()}) > 1


def test_draws_follow_the_lattice(vocabulary):
    """Frequencies of whole segmentations against their weights by brute force."""
    word, v = " the", vocabulary
    by_text = {}
    for i, t in enumerate(v.text):
        if t and i not in set(v.byte_ids.tolist()):
            by_text[t.decode()] = i

    def all_of(s):
        if not s:
            return [((), 1.0)]
        return [
            ((by_text[s[:k]], *rest), v.weights[by_text[s[:k]]] * w)
            for k in range(1, len(s) + 1) if s[:k] in by_text for rest, w in all_of(s[k:])
        ]

    want = dict(all_of(word))
    total, n = sum(want.values()), 40_000
    ids, counts = pieces.Sampler(v).encode([word] * n, np.arange(n).astype(np.uint64) * np.uint64(2654435761))
    seen, at = {}, 0
    for c in counts:
        k = tuple(ids[at : at + c].tolist())
        seen[k] = seen.get(k, 0) + 1
        at += c
    assert set(seen) <= set(want)
    for k, w in want.items():
        assert abs(seen.get(k, 0) / n - w / total) < 5 * (w / total / n) ** 0.5 + 1e-3


def shares(v, chunk):
    """By node: the probability of each edge into it, longest first, by exact fractions."""
    by_text = {t.decode(): i for i, t in enumerate(v.text) if t and i not in set(v.byte_ids.tolist())}
    forward, out = [Fraction(1)], []
    for end in range(1, len(chunk) + 1):
        into = []
        for n in range(min(v.longest, end), 0, -1):
            part = chunk[end - n : end]
            if part in by_text:
                into.append(forward[end - n] * Fraction(v.weights[by_text[part]]))
            elif n == 1:
                into.append(forward[end - 1] * Fraction(v.weights[v.byte_ids[0]]) ** len(part.encode()))
        forward.append(sum(into))
        out.append([float(x / forward[-1]) for x in into])
    return out


@pytest.mark.parametrize("chunk", ["https://example.org/" + "a1Zq%3f" * 55, " " * 16, " " * 400, "漢字かな交じり文" * 40 + "\U00013000" * 90])
def test_long_runs_are_one_lattice(vocabulary, chunk):
    lat = pieces.lattices(vocabulary, ["short", chunk, "x"])
    origin = int(lat.first[1]) + 1
    edges = [*lat.edges.tolist(), len(lat.limit)]
    for k, want in enumerate(shares(vocabulary, chunk)):
        a, b = edges[origin + k + 1], edges[origin + k + 2]
        upto = (lat.limit[a:b].astype(np.float64) + 1) / 2**32
        assert np.allclose(np.diff(upto, prepend=0), want, atol=1e-7), k


@pytest.mark.parametrize("segment", [16, 37, 1000])
def test_segments_draw_as_the_whole_lattice(vocabulary, monkeypatch, segment):
    texts = ["q" * 700 + " " * 90 + "ünïcödé漢字" * 80, " " * 600, "\U00013000abc" * 200 + "\nend", "Zm9vYmFy" * 150]
    seeds = np.arange(len(texts)).astype(np.uint64) * np.uint64(977)
    monkeypatch.setattr(pieces, "_LONG", 10**6)
    want, counts = pieces.Sampler(vocabulary).encode(texts, seeds)
    monkeypatch.setattr(pieces, "_LONG", 50)
    monkeypatch.setattr(pieces, "_SEGMENT", segment)
    got, again = pieces.Sampler(vocabulary).encode(texts, seeds)
    assert counts.tolist() == again.tolist() and got.tolist() == want.tolist()
    assert pieces.decode_ids(vocabulary.text, got.tolist()) == "".join(texts)


def test_empty(documents):
    assert pieces.encode(documents([]).limit(0), PIECE_MODEL).collect() == []
