import pytest

from tillscope.llm.mixing import mix, mix_plan

ROWS = [(k, "w " * (k % 17 + 1), f"s{k % 5}") for k in range(2000)] + [
    (3000, None, "s1"), (3001, "", "s2"), (3002, "a b", None), (None, "q r s", None), (3003, None, "empty"),
    (3004, "long " * 3000, "big"), (3005, "é x", "S0"),
]


def water(sizes, weights, total):
    """Plain filling: share, stop the full ones, share the rest again."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    full = set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if w and rest * weights[s] / w >= 2 * sizes[s]}
        if not over:
            break
        full |= over
        open_ -= over
    for s in sizes:
        target[s] = 2.0 * sizes[s] if s in full else rest * weights[s] / w
    return target


def test_targets_match_plain_filling(documents):
    got = mix_plan(documents(ROWS)).collect()
    sizes = {}
    for i, t, *s in ROWS:
        sizes[s[0]] = sizes.get(s[0], 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want = water(sizes, weights, 1.5 * sum(sizes.values()))
    by_id = {i: s[0] for i, _, *s in ROWS}
    for r in got:
        s = by_id[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken == r.size * r.copies and r.taken <= 2 * r.size
    assert len(got) == len(ROWS)
    for s in ("s0", "s1", "s2", "s3", "s4"):
        taken = sum(r.taken for r in got if by_id[r.doc_id] == s)
        assert taken == pytest.approx(want[s], rel=0.1)


def test_reruns_and_partitions_agree(documents):
    docs = documents(ROWS)
    a = sorted(mix_plan(docs.repartition(9)).collect(), key=str)
    assert a == sorted(mix_plan(docs.coalesce(1)).collect(), key=str)


def test_rows_are_repeated_as_planned(documents):
    docs = documents(ROWS)
    plan = {r.doc_id: r.copies for r in mix_plan(docs).collect()}
    out = mix(docs)
    assert out.columns == docs.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {i: n for i, n in plan.items() if n}


def test_empty_and_wordless(documents):
    assert mix_plan(documents([]).limit(0)).collect() == []
    (row,) = mix_plan(documents([(1, None, "a")])).collect()
    assert (row.size, row.target, row.taken) == (0, 0.0, 0)
    assert mix(documents([(1, None, "a")])).collect() == []
