"""The stages that turn raw documents into training text.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result to the shared folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillscope.llm import exact_dedup, mixing, near_dups, pieces, toxicity
from tillscope.llm.queries import PIECE_MODEL
from tillscope.sources.lake import stage


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model calls toxic go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts stays, the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the smallest doc_id."""
    return near_dups.drop_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their weights."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document."""
    return pieces.encode(docs, PIECE_MODEL)


STAGES = [
    ("toxicity", harmless),
    ("exact dedup", exact),
    ("ngram jaccard join", near),
    ("source mixing", mixed),
    ("sentencepiece", encoded),
]

#: A trained model and sampled segmentations have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
