"""The queries that apply each operator to its whole table, and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm import (
    byte_pairs,
    dialogues,
    exact_dedup,
    html_text,
    lexical,
    licenses,
    mixing,
    near_dups,
    neighbours,
    pieces,
    pseudonyms,
    substrings,
    toxicity,
)

#: Files of public tokenizers; a path, never part of this repository.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Stands in for the key that a deployment keeps in its secret store.
PSEUDONYM_KEY = b"tillscope query key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with keyed pseudonyms for personal data."""
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every text, and whether decoding gives the text back."""
    return pieces.encode(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of each vector whose vec_id is divisible by 50."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside 35-word windows that stand in more than one place."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("spans")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document brings to a mix of sources weighing 3, 1, 2 in turn."""
    return mixing.mix_plan(table(spark, sf_dir, "documents")).drop("copies")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and statements of every text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every text at a Jaccard similarity of 0.8 over five-word sets."""
    return near_dups.near_classes(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", toxicity.held_out("doc_id"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair ids of every text, and the bytes they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    ids = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    encoded = byte_pairs.encode(docs, RANK_FILE).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        "token_ids",
    )
    return byte_pairs.decode(encoded, RANK_FILE).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired rows of every damaged conversation."""
    damaged = dialogues.damage(table(spark, sf_dir, "conversations"))
    return dialogues.repair(damaged, present=F.col("present"))


QUERIES = {
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_nearest_vectors": op3_nearest_vectors,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_license_scan": op7_license_scan,
    "op8_ngram_join": op8_ngram_join,
    "op9_toxicity": op9_toxicity,
    "op10_html_extraction": op10_html_extraction,
    "op11_byte_pairs": op11_byte_pairs,
    "op12_lexical_search": op12_lexical_search,
    "op13_dialogue_repair": op13_dialogue_repair,
}

ORACLES = {
    "op4_substring_dedup": r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (
  SELECT doc_id, ws, [md5(array_to_string(ws[i:i+34], ' ')) for i in range(1, greatest(len(ws) - 33, 1))] AS hs
  FROM t),
g AS (SELECT doc_id, unnest(hs) AS h, generate_subscripts(hs, 1) AS i FROM w),
r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS at FROM g SEMI JOIN r USING (h)),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS at FROM t),
k AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.at) AS kept, count(*) AS n
  FROM p ANTI JOIN c ON p.doc_id = c.doc_id AND p.at = c.at GROUP BY p.doc_id)
SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k ON t.doc_id = k.doc_id""",
    "op5_exact_dedup": """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h)""",
    "op6_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w
  FROM d GROUP BY source),
-- The smallest sources for their weight are full; the others share what is left.
r AS (
  SELECT *, 3 * sum(source_size) OVER () - 4 * (sum(source_size) OVER o - source_size) AS rest,
    2 * (sum(w) OVER () - sum(w) OVER o + w) AS share
  FROM s WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (
  SELECT min_by(rest, source_size / w) AS rest, min_by(share, source_size / w) AS share
  FROM r WHERE source_size * 2 * share > w * rest),
t AS (
  SELECT source, source_size, CASE WHEN source_size * 2 * l.share <= w * l.rest THEN CAST(2 * source_size AS DOUBLE)
    ELSE CAST(l.rest AS DOUBLE) * w / CAST(l.share AS DOUBLE) END AS target
  FROM r, l),
c AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    CAST(CAST('0x' || substr(md5('17:' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
q AS (
  SELECT row_number() OVER () AS iid, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
qt AS (SELECT iid, item_id, t, count(*) AS times FROM q GROUP BY ALL),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(ts)) AS BIGINT) AS words FROM d WHERE len(ts) > 0),
e AS (SELECT rid, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS t FROM d),
tf AS (SELECT rid, doc_id, n, t, count(*) AS tf FROM e WHERE t IN (SELECT t FROM qt) GROUP BY ALL),
w AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, s GROUP BY t),
r AS (
  SELECT iid, item_id, doc_id, rid,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM tf JOIN w USING (t) JOIN qt USING (t), s GROUP BY iid, item_id, doc_id, rid),
o AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10""",
}
