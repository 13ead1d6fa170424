import random

from tillscope.llm import near_dups


def plain(rows, words=5, threshold=0.8):
    def grams(t):
        w = (t or "").lower().split()
        k = min(words, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = [grams(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return links, [find(x) for x in range(len(rows))]


def corpus(seed, copies):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    texts = [" ".join(fresh(rng.randint(0, 60))) for _ in range(40)]
    base = fresh(120)
    for k in range(copies):
        words = list(base)
        for _ in range(k % 5):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**5)}"
        texts.append(" ".join(words))
    texts += [None, "", "   ", "one", "One", "one two", texts[5], texts[5].upper(), "long text " * 20_000]
    return list(enumerate(texts))


def compare(rows, got):
    links, roots = plain(rows)
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        assert (by_id[i].n_links, by_id[i].class_id) == (links[k], rows[roots[k]][0]), i
        assert by_id[i].class_size == roots.count(roots[k])
    assert sum(r.kept for r in got) == len(set(roots))


def test_classes_and_links_match_brute_force(documents):
    rows = corpus(1, 60)
    compare(rows, near_dups.near_classes(documents(rows).repartition(6)).collect())


def test_large_buckets_are_split_and_cut_into_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_dups, "_BLOCK", 16)
    rows = corpus(2, 90)
    compare(rows, near_dups.near_classes(documents(rows), small=8).collect())


def test_runs_reach_the_recall():
    alive = near_dups.survival(0.8)
    assert abs(alive - (1 - (1 - 0.8 * alive) ** near_dups.fan_for(0.8))) < 1e-9 and 0.93 < alive < 0.95
    for depth in (1, 2, 3):
        runs = near_dups.runs_for(0.8, depth, 0.999)
        met = 0.8**depth * alive
        assert 1 - (1 - met) ** runs >= 0.999 > 1 - (1 - met) ** (runs - 1)


def test_shared_boilerplate_is_split_on(documents, monkeypatch):
    """Texts that share a passage, but are not near each other, are split on; their links stay exact.

    Ending at the third level leaves buckets of 1,800 texts and 4 million comparisons here."""
    rng = random.Random(5)
    passage = " ".join(f"b{k}" for k in range(40))
    own = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(12_000)]
    near = [[*w[:30], "changed", *w[31:]] for w in own[:300]]
    rows = [(i, f"{passage} {' '.join(w)}") for i, w in enumerate([*own, *near])]
    seen, kept = [], near_dups._leaves

    def watched(*args):
        seen.append(kept(*args))
        return seen[-1]

    monkeypatch.setattr(near_dups, "_leaves", watched)
    got = {r.doc_id: (r.n_links, r.class_id) for r in near_dups.near_classes(documents(rows).repartition(8)).collect()}
    want = {i: (0, i) for i in range(12_000)} | {i: (1, i) for i in range(300)} | {12_000 + i: (1, i) for i in range(300)}
    assert got == want
    sizes = [r.n for r in seen[0].select("path", "n").distinct().collect()]
    assert max(sizes) <= 512
    assert sum(n * n for n in sizes) < 20 * len(rows)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in near_dups.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_survivors_and_edges(documents):
    rows = corpus(4, 20) + [(None, "a b c d e f g h"), (None, "a b c d e f g h"), (7, corpus(4, 20)[7][1])]
    docs = documents(rows)
    left = near_dups.drop_near(docs)
    assert left.columns == docs.columns
    assert left.count() == len(set(plain(rows)[1]))
    assert near_dups.near_classes(documents([]).limit(0)).collect() == []
    assert near_dups.drop_near(documents([]).limit(0)).collect() == []
    assert near_dups.drop_near(documents([(1, None), (2, "")])).count() == 2


def test_links_of_rows_repeated_under_one_identifier(documents):
    """Repeated rows, also without identifier, count once each: with near copies and among themselves."""
    base = [f"w{k}" for k in range(60)]
    a, b, c = " ".join(base), " ".join([*base[:59], "x"]), " ".join(["y", *base[1:]])
    rows = [(1, a), (1, a), (1, a), (2, b), (None, c), (None, c), (3, b), (4, "other text")]
    links, roots = plain([(i, t) for i, t in rows])
    got = near_dups.near_classes(documents(rows).repartition(3)).collect()
    want = sorted((str(i), n, roots.count(r)) for (i, _), n, r in zip(rows, links, roots))
    assert sorted((str(r.doc_id), r.n_links, r.class_size) for r in got) == want
