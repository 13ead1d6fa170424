"""Models with labels, and topics: fraud, complaints, themes of texts.

A hash of the key decides which rows are held out, so every run splits alike.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer, HashingTF, IndexToString, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.models import boosting, evaluate
from tillscope.sources.lake import stage

FOLDS = 5
TERM = r"\p{L}{2,}"


def fold(key: str) -> Column:
    """0 to 4 by a hash of the key."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % FOLDS


def held_out(key: str) -> Column:
    """One row in five."""
    return fold(key) == 0


def split_counts(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows by fold and label."""
    return df.groupBy(held_out(key).alias("held_out"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def _scored(model, df: DataFrame, key: str, label: str) -> DataFrame:
    return model.transform(df).select(
        key, F.col(label).cast("int").alias("label"), held_out(key).alias("held_out"),
        F.round(vector_to_array("probability")[1], 6).alias("probability"), F.col("prediction").cast("int").alias("predicted"),
    )


def supervised_fraud(
    features: DataFrame, labels: DataFrame, columns: list[str], key: str = "transaction_id", trees: int = 20, depth: int = 6
) -> DataFrame:
    """(key, label, held_out, probability, predicted): a random forest on all rows that are not held out."""
    rows = features.join(labels.select(key, F.col("is_fraud").cast("double").alias("label")), key)
    forest = RandomForestClassifier(labelCol="label", featuresCol="vector", numTrees=trees, maxDepth=depth, seed=42)
    steps = Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="vector"), forest])
    return _scored(steps.fit(rows.where(~held_out(key))), rows, key, "label")


def boosted_fraud(
    features: DataFrame, labels: DataFrame | None, columns: list[str], key: str = "transaction_id", rounds: int = 20, depth: int = 5
) -> DataFrame:
    """(key, label, held_out, probability, predicted): boosted trees on all rows that are not held out.

    Both classes weigh the same in sum, so the rare one is not drowned. Needs rows of both.
    Without ``labels`` the features carry is_fraud themselves; rows without a label take no part.
    """
    rows = features if labels is None else features.join(labels.select(key, "is_fraud"), key)
    rows = rows.where(F.col("is_fraud").isNotNull())
    trees, cuts = boosting.fit(rows.where(~held_out(key)), columns, "is_fraud", key, rounds, depth)
    return boosting.score(rows, columns, key, "is_fraud", trees, cuts).select(
        key, F.col("is_fraud").alias("label"), held_out(key).alias("held_out"), F.round("probability", 6).alias("probability"), "predicted"
    )


def class_classifier(
    texts: DataFrame, label: str, key: str, text: str = "text", width: int = 1 << 14
) -> DataFrame:
    """(key, label, fold, predicted, probability, hit, calibrated) of all texts with a label, of any number of classes.

    Multinomial regression on hashed words learns from folds 2 to 4. ``probability`` is that of the
    predicted class; fold 1 calibrates it by pooling adjacent violators, fold 0 is left to judge both.
    NULL texts are empty; rows without a label take no part.
    """
    rows = texts.where(F.col(label).isNotNull()).select(
        key, F.col(label).alias("label"), fold(key).cast("int").alias("fold"), F.coalesce(text, F.lit("")).alias("text")
    )
    words = Pipeline(
        stages=[
            StringIndexer(inputCol="label", outputCol="class", stringOrderType="alphabetAsc"),
            RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="words", outputCol="vector", numFeatures=width, binary=True),
        ]
    ).fit(rows)
    vectors = stage(words.transform(rows).select(key, "label", "fold", "class", "vector"), "text-vectors")
    fitted = LogisticRegression(labelCol="class", featuresCol="vector", family="multinomial", regParam=0.01, maxIter=30).fit(
        vectors.where("fold > 1")
    )
    named = IndexToString(inputCol="prediction", outputCol="predicted", labels=words.stages[0].labels)
    scored = named.transform(fitted.transform(vectors)).select(
        key, "label", "fold", "predicted", F.round(F.array_max(vector_to_array("probability")), 6).alias("probability"),
        (F.col("label") == F.col("predicted")).cast("int").alias("hit"),
    )
    scored = stage(scored, "class-scores")
    return evaluate.calibrate(scored, evaluate.calibration(scored.where("fold = 1"), label="hit"))


def text_classifier(
    texts: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", width: int = 1 << 14
) -> DataFrame:
    """(key, label, held_out, probability, predicted) of all labelled texts: logistic regression on hashed word counts."""
    known = labels.where(F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("label"))
    rows = texts.select(key, F.coalesce(text, F.lit("")).alias("text")).join(known, key)
    steps = Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\W+"),
            HashingTF(inputCol="words", outputCol="vector", numFeatures=width, binary=True),
            LogisticRegression(labelCol="label", featuresCol="vector", regParam=0.01, maxIter=30),
        ]
    )
    return _scored(steps.fit(rows.where(~held_out(key))), rows, key, "label")


def confusion(scored: DataFrame) -> DataFrame:
    """Rows by fold, label and prediction."""
    return scored.groupBy("held_out", "label", "predicted").agg(F.count(F.lit(1)).alias("n"))


def terms(texts: DataFrame, text: str = "text") -> DataFrame:
    """(term, documents, occurrences) of every term, in any script."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), 0)

    def counted(array: Column, documents: int) -> Column:
        return F.transform(array, lambda t: F.struct(t.alias("term"), F.lit(documents).alias("d")))

    # Each text once per distinct term and once per occurrence, added up before the shuffle.
    both = F.concat(counted(F.array_distinct("w"), 1), counted(F.col("w"), 0))
    return (
        texts.select(words.alias("w"))
        .select(F.explode(both).alias("t"))
        .groupBy("t.term")
        .agg(F.count_if(F.col("t.d") == 1).alias("documents"), F.count_if(F.col("t.d") == 0).alias("occurrences"))
    )


def topic_model(
    texts: DataFrame, key: str = "doc_id", text: str = "text", topics: int = 8, rounds: int = 10, vocabulary: int = 2000
) -> DataFrame:
    """(key, topic, weight): latent Dirichlet allocation, the strongest topic of each text.

    Each round draws as many texts as there are, with replacement, so a text is never drawn in
    ten rounds with a probability of e**-10. Topics rest on the ``vocabulary`` terms that are most
    frequent; every text gets its topic, one without known terms topic 0 with a weight of 0.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), 0)
    counted = CountVectorizer(inputCol="w", outputCol="features", vocabSize=vocabulary, minDF=2.0)
    rows = texts.select(key, words.alias("w"))
    # Written, so that the rounds do not work from the texts again.
    vectors = stage(counted.fit(rows).transform(rows).select(key, "features"), "term-vectors")
    model = LDA(k=topics, maxIter=rounds, seed=42, subsamplingRate=1.0).fit(vectors)
    mix = vector_to_array(F.col("topicDistribution"))
    return model.transform(vectors).select(
        key,
        (F.array_position(mix, F.array_max(mix)) - 1).cast("int").alias("topic"),
        F.round(F.array_max(mix), 6).alias("weight"),
    )
