"""Lexicon sentiment inside the JVM: no explode, no join, no shuffle.

Tokens are matched with a hash set; only the few matches look up their score.
The mapping travels with the plan, so it should stay a word list (thousands of
entries), not a corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.text.lexicon import INTENSIFIERS, LEXICON, NEGATION_FACTOR, NEGATIONS

_WORD = "[a-z]+"


def _mapping(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def with_sentiment(
    df: DataFrame, text: str, lexicon: dict[str, tuple[float, float]] = LEXICON
) -> DataFrame:
    """Adds polarity (-1 to 1) and subjectivity (0 to 1): means over the words found, 0 when none.

    A preceding negation turns and halves a word, a preceding intensifier scales it.
    """
    polarity = _mapping({w: p for w, (p, _) in lexicon.items()})
    subjectivity = _mapping({w: s for w, (_, s) in lexicon.items()})
    strength = _mapping(INTENSIFIERS)
    words = F.col("_words")

    def scored(hit: Column) -> Column:
        before = hit["before"]
        factor = F.when(before.isin(NEGATIONS), NEGATION_FACTOR).otherwise(
            F.coalesce(F.try_element_at(strength, before), F.lit(1.0))
        )
        value = F.try_element_at(polarity, hit["word"]) * factor
        return F.struct(
            F.greatest(F.least(value, F.lit(1.0)), F.lit(-1.0)).alias("polarity"),
            F.try_element_at(subjectivity, hit["word"]).alias("subjectivity"),
        )

    def mean(name: str) -> Column:
        total = F.aggregate("_hits", F.lit(0.0), lambda sum_, hit: sum_ + hit[name])
        return c.rounded(c.or_zero(F.try_divide(total, F.size("_hits"))), 6)

    found = F.filter(
        F.zip_with(
            words,
            F.concat(F.array(F.lit("")), words),
            lambda word, before: F.struct(word.alias("word"), before.alias("before")),
        ),
        lambda pair: pair["word"].isin(list(lexicon)),
    )
    return (
        df.withColumn("_words", F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), 0))
        .withColumn("_hits", F.transform(found, scored))
        .withColumns({"polarity": mean("polarity"), "subjectivity": mean("subjectivity")})
        .drop("_words", "_hits")
    )


def review_sentiment(reviews: DataFrame, lexicon: dict[str, tuple[float, float]] = LEXICON) -> DataFrame:
    return (
        with_sentiment(reviews, "review_text", lexicon)
        .withColumn("sentiment", c.label3(F.col("polarity")))
        .select("review_id", "merchant_id", "rating", "polarity", "subjectivity", "sentiment", "review_text")
    )


def text_sentiment(df: DataFrame, keys: list[str], column: str = "text") -> DataFrame:
    """Polarity, subjectivity and label for the texts of any table."""
    return (
        with_sentiment(df, column)
        .withColumn("sentiment", c.label3(F.col("polarity")))
        .select(*keys, "polarity", "subjectivity", "sentiment")
    )


def merchant_sentiment(scored: DataFrame) -> DataFrame:
    return scored.groupBy("merchant_id").agg(
        F.count("review_id").alias("review_count"),
        c.rounded(F.avg("rating"), 4).alias("avg_rating"),
        c.rounded(F.avg("polarity"), 4).alias("avg_polarity"),
        c.rounded(F.avg("subjectivity"), 4).alias("avg_subjectivity"),
        *[
            F.count_if(F.col("sentiment") == label).alias(f"{label}_count")
            for label in ("positive", "negative", "neutral")
        ],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(label, n) of one label column."""
    return df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
