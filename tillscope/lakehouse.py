"""The tables of one data folder, raw to derived, each built once and then read.

Every table that several queries read is written to the shared folder on first
use. The build order is bronze, silver, labels, models.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope import fixtures, schemas
from tillscope.functions import columns as c
from tillscope.models import forecast, rules, segments, supervised
from tillscope.models.features import FRAUD_FEATURES, joined_features
from tillscope.models.iforest import isolation_forest
from tillscope.operators import pair_months
from tillscope.operators.count_index import CountIndex
from tillscope.operators.star import enrich
from tillscope.plans import silver, transactions, views
from tillscope.sources.lake import scratch_path, stage, with_audit
from tillscope.tables import Tables
from tillscope.text import induced, phrases, sentiment, tickets

# Reference day of all relative windows over the given tables.
AS_OF = date(2001, 8, 1)

_TRANSACTION_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "amount", "payment_method",
    "category", "city", "state", "timestamp", "status", "device_type",
    "fraud_points", "fraud_score", "risk_level", "transaction_hour", "weekend_flag",
    "customer_merchant_distance", "txn_hour", "is_weekend", "is_high_value",
    "is_late_night", "txn_month",
]
# What the others follow from.
_MOVED_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "amount", "payment_method", "category", "city", "state",
    "timestamp", "status", "device_type", "fraud_points", "customer_merchant_distance", "txn_month",
]
# What the models take from the customer and the merchant; it stays with the scored rows, not with the transactions.
_MODEL_COLUMNS = ["customer_mean", "customer_std", "customer_tx_rate", "seller_risk"]


def _completed(moved: DataFrame) -> DataFrame:
    """The moved columns and those that follow from them."""
    return rules.graded(silver.flagged(moved)).select(*_TRANSACTION_COLUMNS)


class Lakehouse:
    """Silver tables and what the models derive from them."""

    as_of = AS_OF

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def given(self, name: str) -> DataFrame:
        """A table of the folder as it is."""
        return fixtures.table(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------------ bronze
    @cached_property
    def raw_transactions(self) -> DataFrame:
        return stage(fixtures.transactions(self.spark, self.sf_dir), "raw-transactions")

    @cached_property
    def bronze(self) -> Tables:
        return Tables(
            customers=fixtures.customers(self.spark, self.sf_dir),
            merchants=fixtures.merchants(self.spark, self.sf_dir),
            transactions=self.raw_transactions,
            reviews=fixtures.reviews(self.scored, self.merchants),
            tickets=fixtures.tickets(self.spark, self.sf_dir),
        )

    # ------------------------------------------------------------------ silver
    @cached_property
    def customers(self) -> DataFrame:
        return stage(silver.customers(fixtures.customers(self.spark, self.sf_dir)), "customers")

    @cached_property
    def merchants(self) -> DataFrame:
        return stage(silver.merchants(fixtures.merchants(self.spark, self.sf_dir)), "merchants")

    @cached_property
    def _scored_rows(self) -> DataFrame:
        """Cleansed transactions with place, distance, rule points and what the models take from both dimensions.

        The raw rows are not read from their written table, whose splits hold so many of them that the sort
        before the dedup would spill. The flags are added once the rows have met their customers and merchants,
        and only columns that do not follow from others are written.
        """
        clean = silver.typed_transactions(fixtures.transactions(self.spark, self.sf_dir))
        met = enrich(clean, self.customers, self.merchants, ["std_amount", "mean_nb_tx_per_day"])
        taken = dict(zip(_MODEL_COLUMNS, map(F.col, ["mean_amount", "std_amount", "mean_nb_tx_per_day", "merchant_risk"])))
        scored = rules.score(silver.flagged(met.withColumns(taken)))
        scored = scored.withColumn("txn_month", c.month()).select(*_MOVED_COLUMNS, *_MODEL_COLUMNS)
        return stage(scored, "scored-transactions")

    @cached_property
    def scored(self) -> DataFrame:
        """Cleansed transactions with place, distance and rule score."""
        return _completed(self._scored_rows)

    @cached_property
    def top_fraction(self) -> rules.TopFraction:
        return rules.fit_top_fraction(self.scored)

    @cached_property
    def transactions(self) -> DataFrame:
        """The scored transactions with their label, laid out by month.

        The label is stored: as an expression it would make every reader fetch the ids. It and the columns that
        follow from others are added after the rows have moved to their month.
        """

        return stage(
            self.scored.select(*_MOVED_COLUMNS), "transactions", partition_by="txn_month", sort_by="customer_id",
            lookup_by="transaction_id", then=lambda moved: self.top_fraction.label(_completed(moved)),
        )

    @cached_property
    def transaction_counts(self) -> CountIndex:
        return transactions.counted(self.transactions)

    @cached_property
    def reviews(self) -> DataFrame:
        # Not by way of ``bronze``, which writes the raw transactions.
        return stage(silver.reviews(fixtures.reviews(self.scored, self.merchants)), "reviews")

    @cached_property
    def tickets(self) -> DataFrame:
        return stage(silver.tickets(fixtures.tickets(self.spark, self.sf_dir)), "tickets")

    # ------------------------------------------------------------------ derived
    @cached_property
    def _feature_rows(self) -> DataFrame:
        """The features and the rule points, from the scored rows as they lie: nothing is joined to a dimension again."""
        rows = self._scored_rows.where(F.col("customer_id").isNotNull() & F.col("merchant_id").isNotNull())
        rows = rules.graded(silver.flagged(rows)).withColumnRenamed("seller_risk", "merchant_risk")
        return joined_features(rows, self.scored, ["fraud_points"])

    @cached_property
    def features(self) -> DataFrame:
        return self._feature_rows.drop("fraud_points")

    @cached_property
    def _predicted(self) -> DataFrame:
        return isolation_forest(self._feature_rows, FRAUD_FEATURES, keep=["fraud_points"])

    @cached_property
    def predictions(self) -> DataFrame:
        return self._predicted.drop("fraud_points")

    @cached_property
    def judged(self) -> DataFrame:
        """The predictions with the label of the rules, which needs no join."""
        return self.top_fraction.label(self._predicted).drop("fraud_points")

    @cached_property
    def boosted_fraud(self) -> DataFrame:
        labelled = self.top_fraction.label(self._feature_rows).drop("fraud_points")
        return stage(supervised.boosted_fraud(labelled, None, FRAUD_FEATURES), "boosted-fraud")

    @cached_property
    def spoken_roles(self) -> DataFrame:
        turns = self.given("conversations").select(
            F.format_string("%s:%s", "conv_id", "turn").alias("turn_id"), "role", "text"
        )
        return stage(supervised.class_classifier(turns, "role", "turn_id"), "spoken-roles")

    @cached_property
    def refreshed_pairs(self) -> DataFrame:
        """Counts stored when the last two years lacked their refunds, and refreshed for those months."""
        late = F.year("txn_month") >= self.as_of.year - 2
        path = scratch_path(self.spark, "pair-months")
        pair_months.refresh(self.transactions.where(~(late & c.refunded())), path)
        months = self.transactions.where(late).select("txn_month").distinct().collect()  # of the calendar
        pair_months.refresh(self.transactions, path, [r.txn_month for r in months])
        return pair_months.stored(self.spark, path)

    @cached_property
    def customer_summary(self) -> DataFrame:
        return stage(views.customer_summary(self.transactions, self.customers), "customer-summary")

    @cached_property
    def segments(self) -> DataFrame:
        features = segments.segment_features(self.customer_summary, self.as_of)
        named = segments.name_segments(segments.kmeans(stage(features, "segment-input")))
        return stage(with_audit(named), "customer-segments")

    @cached_property
    def review_sentiment(self) -> DataFrame:
        return stage(sentiment.review_sentiment(self.reviews), "review-sentiment")

    @cached_property
    def merchant_sentiment(self) -> DataFrame:
        return stage(sentiment.merchant_sentiment(self.review_sentiment), "merchant-sentiment")

    @cached_property
    def ticket_nlp(self) -> DataFrame:
        return stage(tickets.ticket_nlp(self.tickets), "ticket-nlp")

    @cached_property
    def ticket_phrases(self) -> DataFrame:
        return stage(phrases.phrase_table(self.tickets, "description"), "ticket-phrases")

    @cached_property
    def document_phrases(self) -> DataFrame:
        return stage(phrases.phrase_table(self.given("documents"), longest=3, least=3), "document-phrases")

    @cached_property
    def _quality_taught(self) -> DataFrame:
        """The labelled documents whose doc_id no 5 divides."""
        return self.given("documents").join(self.given("labels").where("doc_id % 5 != 0"), "doc_id")

    @cached_property
    def quality_lexicon(self) -> DataFrame:
        return induced.lexicon(self._quality_taught, "doc_id", F.col("quality") == 1)

    @cached_property
    def quality_midpoint(self) -> DataFrame:
        good = F.col("quality") == 1
        return stage(induced.midpoint(self._quality_taught, "doc_id", self.quality_lexicon, good), "quality-midpoint")

    @cached_property
    def daily_series(self) -> DataFrame:
        return stage(forecast.daily_series(self.transactions), "daily-series")

    @cached_property
    def forecasts(self) -> DataFrame:
        return stage(forecast.forecast(self.daily_series), "forecasts", partition_by="metric_name")


_open: dict[tuple[str, str], Lakehouse] = {}


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """The lakehouse of a data folder; one per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = Lakehouse(spark, sf_dir)
    return _open[key]
