"""Urgency, topics and keywords of support tickets."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.text.lexicon import LEXICON, STOP_WORDS
from tillscope.text.sentiment import with_sentiment

# Points, words and topic groups of the ticket rules.
URGENT_WORDS = ["immediately", "urgent", "asap", "emergency", "critical"]
TOPICS = {
    "refund_delay": ["refund", "waiting", "days"],
    "payment_failure": ["failed", "declined", "deducted"],
    "fraud_concern": ["fraud", "authorize", "unauthorized"],
    "account_access": ["login", "access", "authentication", "password"],
    "loyalty_query": ["cashback", "reward", "offer"],
}
CRITICAL_FROM, HIGH_FROM = 4, 2
MOST_KEYWORDS = 5


TEXT = "_text"


def _with_text(tickets: DataFrame, column: str = "description") -> DataFrame:
    """Adds the text in lower case, once for all rules."""
    return tickets.withColumn(TEXT, F.lower(F.coalesce(column, F.lit(""))))


def _has_any(words: list[str]) -> Column:
    """Any of the words, also inside longer words."""
    return reduce(or_, [F.contains(F.col(TEXT), F.lit(w)) for w in words])


def urgency_points() -> Column:
    issue = F.col("issue_type")
    return (
        F.when(F.col("priority") == "High", 3).otherwise(0)
        + F.when(issue.isin("Fraud Alert", "Account Access"), 2).otherwise(0)
        + F.when(issue == "Payment Failed", 1).otherwise(0)
        + F.when(_has_any(URGENT_WORDS), 2).otherwise(0)
    )


def urgency() -> Column:
    points = urgency_points()
    return (
        F.when(points >= CRITICAL_FROM, "critical").when(points >= HIGH_FROM, "high").otherwise("normal")
    )


def _or_general(values: Column) -> Column:
    """Comma list of the array, or general when there is nothing in it."""
    text = F.array_join(values, ", ")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("general"))


def topics() -> Column:
    """Matching topic names in the fixed order, else general."""
    return _or_general(F.array(*[F.when(_has_any(words), F.lit(name)) for name, words in TOPICS.items()]))


def keywords() -> Column:
    """The first five phrases longer than three characters: runs of words between stop
    words, digits and punctuation. Else general."""
    words = F.split(F.regexp_replace(TEXT, "[^a-z ]+", " | "), " +")
    kept = F.transform(words, lambda w: F.when(w.isin(STOP_WORDS), "|").otherwise(w))
    phrases = F.filter(
        F.transform(F.split(F.array_join(kept, " "), r"\|"), lambda p: F.trim(p)),
        lambda p: F.length(p) > 3,
    )
    return _or_general(F.slice(phrases, 1, MOST_KEYWORDS))


def ticket_urgency(tickets: DataFrame) -> DataFrame:
    return _with_text(tickets).select("ticket_id", "issue_type", "priority", urgency().alias("urgency"))


def ticket_topics(tickets: DataFrame) -> DataFrame:
    return _with_text(tickets).select("ticket_id", topics().alias("topics"))


def ticket_keywords(tickets: DataFrame) -> DataFrame:
    return _with_text(tickets).select("ticket_id", keywords().alias("keywords"))


def text_rules(df: DataFrame, keys: list[str], column: str = "text") -> DataFrame:
    """Topics, keywords and whether an urgent word occurs, for the texts of any table."""
    return _with_text(df, column).select(
        *keys, topics().alias("topics"), keywords().alias("keywords"), _has_any(URGENT_WORDS).alias("urgent")
    )


def ticket_nlp(tickets: DataFrame, lexicon: dict[str, tuple[float, float]] = LEXICON) -> DataFrame:
    return with_sentiment(_with_text(tickets), "description", lexicon).select(
        "ticket_id",
        "issue_type",
        F.col("polarity").alias("sentiment"),
        c.label3(F.col("polarity")).alias("polarity_label"),
        urgency().alias("urgency"),
        keywords().alias("keywords"),
        topics().alias("topics"),
    )
