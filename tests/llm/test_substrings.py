import hashlib
import random
import re

import numpy as np

from tillscope.llm import common, substrings


def plain(texts, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    where = {}
    for d, words in enumerate(split):
        for k in range(len(words) - window + 1):
            where.setdefault(tuple(words[k : k + window]), []).append((d, k))
    gone = [set() for _ in split]
    for places in where.values():
        if len(places) > 1:
            for d, k in places:
                gone[d].update(range(k, k + window))
    return [
        (len(w), len(g), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in g).encode()).hexdigest())
        for w, g in zip(split, gone)
    ]


def corpus(seed, window):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [fresh(window + k) for k in (-1, 0, 1, 7, 60)]
    texts = []
    for _ in range(40):
        words = fresh(rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        texts.append(" ".join(words))
    texts += [None, "", "a " * 200, "a b " * window, texts[3], texts[3].replace(" ", "\n"), "x y " * 5]
    return texts


def test_removal_matches_brute_force(documents):
    for window in (2, 5, 8, 35):
        texts = corpus(window, window)
        got = substrings.remove_repeats(documents(list(enumerate(texts))).repartition(5), window=window).collect()
        want = plain(texts, window)
        assert len(got) == len(texts)
        for r in got:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], (window, r.doc_id)
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
            assert sum(s.end - s.first for s in r.spans) == r.n_removed


def test_doubling_goes_on_until_none_survive(documents):
    long = " ".join(f"q{k}" for k in range(50))
    docs = documents([(1, long + " end"), (2, "start " + long), (3, "other words")])
    levels = substrings.repeats(substrings.keyed(docs), 8, longest=10**6)
    sizes = {n: sum(len(r.marks) for r in marks.collect()) for n, marks in levels}
    assert sizes == {8: 2 * 43, 16: 2 * 35, 32: 2 * 19, 64: 0}


def test_hashes_by_doubling_tell_windows_apart():
    h = np.random.default_rng(1).integers(0, 2**63, 300).astype(np.uint64)
    h[200:280] = h[20:100]
    for n in (1, 2, 3, 7, 18, 35, 64):
        d = substrings.doubled(h, n)
        assert len(d) == len(h) - n + 1
        assert (d[200 : 281 - n] == d[20 : 101 - n]).all() and len(np.unique(d)) == len(d) - (81 - n)


def test_slices_and_partitions_do_not_matter(documents, monkeypatch):
    docs = documents(list(enumerate(corpus(3, 8))))
    a = sorted(map(str, substrings.remove_repeats(docs.coalesce(1), window=8).collect()))
    monkeypatch.setattr(substrings, "_CHARS", 300)
    assert a == sorted(map(str, substrings.remove_repeats(docs.repartition(11), window=8).collect()))


def test_empty_and_repeated_rows(documents):
    assert substrings.remove_repeats(documents([]).limit(0)).collect() == []
    text = " ".join(map(str, range(40)))
    got = substrings.remove_repeats(documents([(1, text), (1, text), (None, "a b")])).collect()
    assert sorted(r.n_removed for r in got) == [0, 40, 40]


def test_texts_whose_keys_collide(documents, monkeypatch):
    """All texts share 64 bits: marks of one still never reach another."""
    monkeypatch.setattr(common, "content_key", lambda *columns: common.F.lit(7).cast("long"))
    texts = corpus(8, 8)
    got = substrings.remove_repeats(documents(list(enumerate(texts))).repartition(5), window=8).collect()
    want = plain(texts, 8)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], r.doc_id
