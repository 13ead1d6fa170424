"""Word weights learnt from labelled texts, and texts scored by them.

A word weighs the log odds of its share among the words of good texts against its share among
those of bad ones, smoothed by one. Each text counts a word once; shares of words, not of texts,
because good texts may well be longer. Counts cover all labelled texts; a text's score is the
mean weight of its distinct known words, less the midpoint between what good and bad labelled
texts have on average: most words are common to both kinds, and their small weights would
otherwise outweigh the few that tell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.sources.lake import stage

#: Two letters or more, or a run of marks: emoticons and "!!!" say as much as words do.
WORD = r"\p{L}{2,}|[^\p{L}\p{N} \t\n\r\f]+"
LEAST = 3  # labelled texts that hold a word of the lexicon


def text_words(texts: DataFrame, key: str, column: str = "text", *more: Column | str) -> DataFrame:
    """``key`` and each distinct ``WORD``, lower case. NULL and empty texts have none."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(column)), F.lit(WORD), F.lit(0)))
    return texts.select(key, *more, F.explode(words).alias("word"))


def induce(labelled: DataFrame, key: str, good: Column, column: str = "text", least: int = LEAST) -> DataFrame:
    """``word, n_good, n_bad, weight`` for words in ``least`` labelled texts or more.

    ``good`` is true for good texts and false for bad ones; rows where it is NULL teach nothing.
    Repeated rows count again. Without texts of either kind all weights rest on the smoothing alone.
    """
    rows = labelled.withColumn("_good", good).where(F.col("_good").isNotNull())
    counts = stage(
        text_words(rows, key, column, "_good")
        .groupBy("word")
        .agg(F.count_if("_good").alias("n_good"), F.count_if(~F.col("_good")).alias("n_bad")),
        "word-counts",
    )
    totals = counts.agg(F.sum("n_good").alias("good"), F.sum("n_bad").alias("bad"), F.count(F.lit(1)).alias("size"))

    def share(n: str, total: str) -> Column:
        return F.ln((F.col(n) + 1) / (F.col(total) + F.col("size")))

    return (
        counts.where(F.col("n_good") + F.col("n_bad") >= least)
        .crossJoin(F.broadcast(totals))  # one row
        .select("word", "n_good", "n_bad", (share("n_good", "good") - share("n_bad", "bad")).alias("weight"))
    )


def _means(texts: DataFrame, key: str, lexicon: DataFrame, column: str) -> DataFrame:
    return (
        text_words(texts, key, column)
        .join(lexicon.select("word", "weight"), "word")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_known"), F.avg("weight").alias("mean"))
    )


def midpoint(labelled: DataFrame, key: str, lexicon: DataFrame, good: Column, column: str = "text") -> DataFrame:
    """One row, ``middle``: halfway between the mean scores of good and bad texts; 0 where a kind is missing."""
    kinds = labelled.select(key, good.alias("_good")).distinct()
    told = _means(labelled, key, lexicon, column).join(kinds, key)
    sides = [F.avg(F.when(F.col("_good") == side, F.col("mean"))) for side in (True, False)]
    return told.agg(F.coalesce((sides[0] + sides[1]) / 2, F.lit(0.0)).alias("middle"))


def score(texts: DataFrame, key: str, lexicon: DataFrame, middle: DataFrame, column: str = "text") -> DataFrame:
    """Per key ``n_known`` words, ``polarity`` (0 without any) and ``label``. ``middle`` is ``midpoint``'s row."""
    polarity = c.rounded(F.coalesce(F.col("mean") - F.col("middle"), F.lit(0.0)), 6)
    return (
        texts.select(key).distinct()
        .join(_means(texts, key, lexicon, column), key, "left")
        .crossJoin(F.broadcast(middle))  # one row
        .select(key, F.coalesce("n_known", F.lit(0)).alias("n_known"), polarity.alias("polarity"))
        .withColumn("label", F.when(F.col("polarity") > 0, "positive").when(F.col("polarity") < 0, "negative").otherwise("neutral"))
    )


def agreement(scored: DataFrame, labels: DataFrame, key: str, good: Column) -> DataFrame:
    """One row per label of ``labels``: texts, how many the sign of the score calls right, and the share."""
    said = scored.join(labels.select(key, good.alias("good")), key).where(F.col("good").isNotNull())
    right = F.count_if((F.col("polarity") > 0) == F.col("good"))
    n = F.count(F.lit(1))
    return said.groupBy("good").agg(n.alias("n"), right.alias("n_right"), c.rounded(c.percent(right, n)).alias("right_pct"))


def lexicon(texts: DataFrame, key: str, good: Column, column: str = "text", least: int = LEAST) -> DataFrame:
    """``induce``, written once for the readers that follow."""
    return stage(induce(texts, key, good, column, least), "induced-lexicon")
