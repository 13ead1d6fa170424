import hashlib

from tillscope.llm.exact_dedup import drop_copies, exact_groups

ROWS = [(1, "Same Text"), (2, "same text"), (3, "SAME TEXT"), (4, None), (5, ""), (6, "Ä"), (7, "ä"),
        (None, "same text"), (None, "alone"), (9, "x y " * 50_000), (10, "X y " * 50_000), (11, "r"), (11, "r")]


def plain(rows, best):
    groups = {}
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        groups.setdefault(low, []).append(i)
    return {
        hashlib.sha256(k.encode()).hexdigest(): (best((i for i in v if i is not None), default=None), len(v))
        for k, v in groups.items()
    }


def test_groups_match_a_plain_version(documents):
    docs = documents(ROWS).repartition(7)
    for keep, best in (("max", max), ("min", min)):
        want = plain(ROWS, best)
        got = exact_groups(docs, keep=keep, bits=1).collect()
        assert len(got) == len(ROWS)
        for r in got:
            assert (r.keep_id, r.group_size) == want[r.text_sha256]
        kept = [r for r in got if r.kept]
        assert len(kept) == len(want) and all(r.doc_id == r.keep_id for r in kept)


def test_partitioning_does_not_matter(documents):
    docs = documents([(k, f"t{k % 3}") for k in range(60)])
    one = sorted(map(tuple, exact_groups(docs.coalesce(1)).collect()))
    many = sorted(map(tuple, exact_groups(docs.repartition(13), bits=2).collect()))
    assert one == many


def test_survivors_keep_their_columns(documents):
    docs = documents(ROWS)
    left = drop_copies(docs, keep="max")
    assert left.columns == docs.columns
    assert left.count() == len(plain(ROWS, max))
    assert left.filter("doc_id = 11").count() == 1


def test_empty(documents):
    assert exact_groups(documents([]).limit(0)).collect() == []
    assert drop_copies(documents([]).limit(0)).collect() == []
