"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition is a run. A run holds one entry per distinct text: digest,
verification hash, the identifier to keep and the number of rows. In each round runs
are merged ``2**bits`` at a time by a sort-based aggregation on (run, digest,
verification), so an entry meets at most ``2**bits`` others of its text, however many
copies the text has. After ``log(partitions) / bits`` rounds one run is left, spread
over the cluster by digest. The verdicts then go down the same tree, again at most
``2**bits`` rows a key, to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import ascii_lower, need, numbered

ENTRY = ["_digest", "_sha"]


def _tree(rows: DataFrame, keep: str, bits: int) -> DataFrame:
    """``rows`` (_rid, _run, _id, _digest, _sha) with _keep (a struct with id and rid) and _n."""
    best = F.max if keep == "max" else F.min
    # Null identifiers lose against any other, rows of one identifier are told apart by number.
    null_last = F.col("_id").isNull() if keep == "min" else F.col("_id").isNotNull()
    rank = F.struct(null_last.alias("empty"), F.col("_id").alias("id"), F.col("_rid").alias("rid"))
    levels = [rows.groupBy("_run", *ENTRY).agg(best(rank).alias("_keep"), F.count("*").alias("_n"))]
    runs = (rows.agg(F.max("_run")).first()[0] or 0) + 1
    while runs > 1:
        runs = (runs + (1 << bits) - 1) >> bits
        up = F.shiftright("_run", bits).alias("_run")
        levels.append(levels[-1].groupBy(up, *ENTRY).agg(best("_keep").alias("_keep"), F.sum("_n").alias("_n")))
    verdict = levels.pop()
    while levels:
        below = levels.pop().select("_run", *ENTRY, F.shiftright("_run", bits).alias("_up"))
        verdict = below.join(verdict.withColumnRenamed("_run", "_up"), ["_up", *ENTRY]).drop("_up")
    return rows.join(verdict, ["_run", *ENTRY])


def _hashed(text: str):
    body = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return [F.xxhash64(body).alias("_digest"), F.unhex(F.sha2(body, 256)).alias("_sha")]


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", bits: int = 3
) -> DataFrame:
    """One row per row of ``docs``: the identifier, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; NULL is the empty
    text. A 64-bit digest orders the runs and SHA-256 verifies each match. ``keep``
    (min or max) says which identifier stays; NULL identifiers stay only where a group
    has no other. Of rows repeated under the kept identifier exactly one has ``kept``.
    ``group_size`` counts rows. An empty table gives an empty result; other columns,
    whatever their names, are not read.
    """
    need(docs, id_col, text_col)
    rows = numbered(
        docs, "digests", F.spark_partition_id().alias("_run"), F.col(id_col).alias("_id"), *_hashed(text_col)
    )
    return _tree(rows, keep, bits).select(
        F.col("_id").alias(id_col),
        F.col("_keep.id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_keep.rid") == F.col("_rid")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", bits: int = 3
) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    need(docs, id_col, text_col)
    whole = numbered(docs, "numbered", F.spark_partition_id().alias("_run"), F.struct("*").alias("_row"))
    rows = whole.select(
        "_rid", "_run", F.col("_row")[id_col].alias("_id"), F.col("_row")[text_col].alias("_text")
    ).select("_rid", "_run", "_id", *_hashed("_text"))
    kept = _tree(rows, keep, bits).filter(F.col("_keep.rid") == F.col("_rid")).select("_rid")
    return whole.join(kept, "_rid", "left_semi").select("_row.*")
