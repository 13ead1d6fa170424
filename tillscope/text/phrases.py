"""Phrases that a body of texts repeats, and the best of them as keywords of each text.

Candidates are runs of words without a stop word, digit or mark between them, and all shorter
runs inside. The C-value of a phrase is its count less the mean count of the longer phrases
that hold it, times the logarithm of its length, so that "account" gives way to "account
access" where it hardly stands alone. Pointwise mutual information says how much more often its
words meet than their counts let expect. Counts cover all texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.sources.lake import stage
from tillscope.text.lexicon import STOP_WORDS

LONGEST, LEAST, MOST_KEYWORDS = 4, 2, 5
KNOWN = 20_000  # phrases of the highest scores that every task gets
_MARKS, _SPACE = r"[^\p{L} \t\n\r\f]+", r"[ \t\n\r\f]+"


def _inner(words: Column, longest: Column) -> Column:
    """All runs of up to ``longest`` of the words, joined by one space."""
    size = F.size(words)
    return F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.least(longest, size)),
            lambda n: F.transform(
                F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")
            ),
        )
    )


def _words(column: str) -> Column:
    """The words of a text in order, NULL for every stop word and every run of digits or marks."""
    tokens = F.split(F.regexp_replace(F.lower(F.col(column)), _MARKS, " | "), _SPACE)
    return F.transform(tokens, lambda w: F.when(~w.isin("", "|", *STOP_WORDS), w))


def candidates(
    texts: DataFrame, column: str = "text", longest: int = LONGEST, keys: list[str] | None = None, once: bool = False
) -> DataFrame:
    """One row per place of a candidate phrase: ``keys`` and ``phrase``. NULL and empty texts have none.

    With ``once`` a row of ``texts`` gives each of its phrases a single time.
    """
    words = F.col("_words")
    # lengths[n - 1] holds the phrase of n words that begins at each place, NULL where a break comes before its end.
    lengths = [words]
    for n in range(1, longest):
        after = F.slice(words, F.lit(n + 1), F.greatest(F.size(words) - n, F.lit(0)))
        lengths.append(F.zip_with(lengths[-1], after, lambda a, b: F.concat(a, F.lit(" "), b)))
    places = F.concat(*lengths)
    return (
        texts.select(*(keys or []), _words(column).alias("_words"))
        .select(*(keys or []), F.explode(F.array_distinct(places) if once else places).alias("phrase"))
        .where(F.col("phrase").isNotNull())
    )


def phrase_table(texts: DataFrame, column: str = "text", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """Every phrase with ``least`` places or more: ``phrase, n_words, n, c_value, pmi, score``.

    ``score`` is the C-value raised by the share that the mutual information has of its
    largest possible value, where it is positive. A single word has a mutual information of 0.
    """
    counted = candidates(texts, column, longest).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counted.withColumn("words", F.split("phrase", " ")), "phrase-counts")
    total = counts.where(F.size("words") == 1).agg(F.sum("n").alias("total"))
    found = counts.where(F.col("n") >= least)

    inner = F.array_distinct(_inner(F.col("words"), F.size("words") - 1))
    nested = (
        found.where(F.size("words") > 1)
        .select("n", F.explode(inner).alias("phrase"))
        .groupBy("phrase")
        .agg((F.sum("n") / F.count(F.lit(1))).alias("around"))
    )
    singles = found.where(F.size("words") == 1).select(F.col("phrase").alias("word"), F.col("n").alias("alone"))
    bits = (
        found.select("phrase", F.explode("words").alias("word"))
        .join(singles, "word")
        .crossJoin(F.broadcast(total))  # one row
        .groupBy("phrase", "total")
        .agg(F.sum(F.log2(F.col("alone") / F.col("total"))).alias("bits"))
    )
    n_words, share = F.size("words"), F.log2(F.col("n") / F.col("total"))
    pmi = F.when(n_words == 1, 0.0).otherwise(share - F.col("bits"))
    bound = F.when((n_words == 1) | (F.col("n") == F.col("total")), 0.0).otherwise(F.col("pmi") / -share)
    return (
        found.join(bits, "phrase")
        .join(nested, "phrase", "left")
        .withColumn("c_value", F.log2(n_words + 1) * (F.col("n") - F.coalesce("around", F.lit(0.0))))
        .withColumn("pmi", pmi)
        .withColumn("score", F.col("c_value") * (1 + F.greatest(F.lit(0.0), bound)))
        .select("phrase", n_words.alias("n_words"), "n", "c_value", "pmi", "score")
    )


def rounded(table: DataFrame) -> DataFrame:
    return table.withColumns({x: c.rounded(F.col(x), 6) for x in ("c_value", "pmi", "score")})


def _best(own: DataFrame, key: str, table: DataFrame, most: int) -> DataFrame:
    """(key, list): the ``most`` best of each text's phrases in ``table``, a phrase once."""
    best = Window.partitionBy(key).orderBy(F.desc("score"), "phrase")
    return (
        own.join(table, "phrase")
        .withColumn("place", F.dense_rank().over(best))  # a phrase that comes again has the same place
        .where(F.col("place") <= most)
        .groupBy(key)
        .agg(F.array_sort(F.collect_set(F.struct("place", "phrase"))).alias("list"))
    )


def keywords(
    texts: DataFrame, key: str, table: DataFrame, column: str = "text", longest: int = LONGEST, most: int = MOST_KEYWORDS,
    known: int = KNOWN,
) -> DataFrame:
    """Per text its best phrases of more than three characters, best first, else general.

    ``key`` names a text; rows of one key are one text. Equal scores go by the phrase.

    Every task gets the phrases of the highest scores, at most ``known``, so the places of a text need not
    be shuffled to find these. A text that holds ``most`` of them is settled, as any other phrase scores
    lower; only the other texts are joined with the whole table.
    """
    scored = table.where(F.length("phrase") > 3).select("phrase", F.round("score", 6).alias("score"))
    # Equal scores stay together: those of the first phrase beyond the bound go to the rest.
    cut = scored.orderBy(F.desc("score")).offset(known).limit(1).select("score").first()
    high = F.broadcast(scored.where(F.col("score") > cut.score) if cut else scored)  # at most ``known`` rows
    found = _best(candidates(texts, column, longest, [key], once=True), key, high, most)
    if cut:
        found = stage(found, "keywords")
        settled = found.where(F.size("list") == most)
        rest = texts.join(settled.select(key), key, "left_anti")
        # Written: what is left are few and short texts, and the planner then knows their size.
        own = stage(candidates(rest, column, longest, [key], once=True).where(F.length("phrase") > 3), "places")
        found = settled.unionByName(_best(own, key, scored, most))
    listed = F.array_join(F.transform("list", lambda x: x["phrase"]), ", ")
    return texts.select(key).distinct().join(found, key, "left").select(
        key, F.coalesce(listed, F.lit("general")).alias("keywords")
    )
