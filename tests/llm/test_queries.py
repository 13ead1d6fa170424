"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

import re
from collections import Counter

import __spark_entry__ as driver
import corpus_pipeline
import duckdb
import pytest
from check import TABLES, compare

from tillscope.llm import mixing, near_dups, pieces, toxicity
from tillscope.llm.queries import ORACLES, PIECE_MODEL, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(name, spark, con, sf):
    line = compare(spark, con, sf, name)
    assert line.startswith("ok"), line


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(driver.queries())


def test_contract_columns(spark, sf):
    """Columns and types that the queries promise."""
    want = {
        "op3_nearest_vectors": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
        "op7_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint",
                             "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
        "op11_byte_pairs": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
        "op12_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
        "op13_dialogue_repair": {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint",
                                 "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string",
                                 "repaired_sha256": "string"},
        "op10_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    }
    for name, columns in want.items():
        assert columns.items() <= dict(QUERIES[name](spark, sf).dtypes).items(), name


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    stages = iter(corpus_pipeline.STAGES)

    def step(previous):
        name, function = next(stages)
        out = function(spark, previous, sf)
        rows = out.collect()
        return name, spark.createDataFrame(rows, out.schema), rows

    # Toxicity: what stays is what plain scoring of each text lets stay.
    name, after, rows = step(docs)
    known = toxicity._Words(model.weights)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {i for i, t in texts.items() if toxicity.bag_score(t or "", known, model.bias)[0] < 0.5}
    assert name == "toxicity" and {r.doc_id for r in rows} == want and after.columns == docs.columns

    # Exact copies: the largest identifier of each text.
    name, after, rows = step(after)
    best = {}
    for i in want:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in texts[i] or "")
        best[low] = max(i, best.get(low, i))
    assert {r.doc_id for r in rows} == set(best.values()) and after.columns == docs.columns

    # Near copies: the smallest identifier of each class of brute-force links.
    name, after, rows = step(after)
    ids = sorted(best.values())
    sets = {i: set(near_dups.shingles(texts[i], 5).tolist()) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            n = len(sets[a] & sets[b]) if a < b else 0
            if n and n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = {find(i) for i in ids}
    assert {r.doc_id for r in rows} == kept and after.columns == docs.columns

    # Mixing: as often as the plan over the same rows says.
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(after).collect()}
    name, after, rows = step(after)
    seen = Counter(r.doc_id for r in rows)
    assert seen == Counter({i: n for i, n in plan.items() if n}) and after.columns == docs.columns

    # Pieces: decoding gives every text back.
    name, after, rows = step(after)
    tables = pieces.vocabulary(PIECE_MODEL).text
    assert Counter(r.doc_id for r in rows) == seen
    assert all(pieces.decode_ids(tables, r.piece_ids) == texts[r.doc_id] for r in rows)


def test_run_applies_all_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.filter("lossless").count() == out.count() > 0
