"""Segment rule, paging, text rules, empty input."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillscope.functions import columns
from tillscope.operators import paging
from tillscope.plans import customers, executive, fraud, insights, merchants, outlook, report, transactions, views
from tillscope.text import sentiment, tickets

AS_OF = date(2024, 6, 1)
SUMMARY = (
    "customer_id string, total_spend double, total_txns bigint, last_txn timestamp_ntz, "
    "avg_txn_value double, unique_merchants bigint"
)


def test_segment_branches(spark):
    recent, old = datetime(2024, 5, 30), datetime(2024, 1, 1)
    edge = datetime(2024, 3, 3)  # 90 days before
    cases = {
        "high_value": [(50000.0, 100, recent, 1.0, 1)],
        "frequent": [(49999.99, 100, recent, 1.0, 1), (1.0, 50, old, 1.0, 1)],
        "dormant": [(1.0, 49, old, 900.0, 30), (1.0, 1, datetime(2024, 3, 2, 23, 59, 59), 900.0, 30)],
        "luxury_spender": [(1.0, 1, edge, 500.0, 30)],
        "diverse_shopper": [(1.0, 1, recent, 499.99, 20)],
        "casual": [(1.0, 1, recent, 1.0, 19), (0.0, 0, None, 0.0, 0)],
    }
    data = [(name, *row) for name, group in cases.items() for row in group]
    df = spark.createDataFrame(data, SUMMARY)
    rule = customers.segment_of(customers.SegmentCuts(), AS_OF)
    assert all(r.customer_id == r.s for r in df.select("customer_id", rule.alias("s")).collect())


@pytest.mark.parametrize("page, limit", [(0, 10), (1, 0), (1, 101)])
def test_page_bounds(spark, page, limit):
    with pytest.raises(ValueError):
        paging.page_of(spark.range(3), "id", "id", page, limit)


def test_top_bounds(lake):
    with pytest.raises(ValueError):
        merchants.top(lake.transactions, lake.merchants, limit=51)


def test_pages_cover_ties_once(lake):
    seen = []
    for p in range(1, 4):
        df = transactions.page(
            lake.transactions, lake.customers, lake.merchants, page=p, limit=100, sort_by="status", sort_order="asc"
        )
        seen += [r.transaction_id for r in df.collect()]
    assert len(seen) == len(set(seen)) == 300
    want = lake.transactions.orderBy("status", "transaction_id").limit(300)
    assert seen == [r.transaction_id for r in want.collect()]


@pytest.mark.parametrize("kind", ["id % 7", "if(id % 5 = 0, null, (id % 97) - 40.5)", "concat('s', id % 13)",
                                  "if(id % 9 = 0, double('NaN'), id / 3)", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 50 as int))",
                                  "date_add(date'1960-01-01', cast(id % 300 as int))"])
@pytest.mark.parametrize("rows", [500, 12_000])
def test_near_and_far_pages(spark, kind, rows):
    df = spark.range(rows).select("id", F.expr(kind).alias("k")).repartition(5)
    for down in (True, False):
        want = [r.id for r in df.orderBy(*paging.page_order("k", down, "id")).collect()]
        for page in (1, rows // 50 + 1):
            got = [r.id for r in paging.page_of(df, "k", "id", page, 25, down).collect()]
            assert got == want[(page - 1) * 25 : page * 25]
    assert paging.page_of(df, "k", "id", rows // 25 + 1, 25).count() == 0


def test_no_job_runs_while_a_page_is_built(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    spark.sparkContext.setJobGroup("page", "page")
    paging.page_of(df, "k", "id", 3_000_000_000, 25)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("page")
    assert paging.page_of(df, "k", "id", 3_000_000_000, 25).count() == 0


def test_exact_quantiles_beyond_a_sketch(spark):
    rows = spark.range(300_000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 2).cast("string").alias("category"),
        (F.pmod(F.xxhash64("id"), F.lit(10**7)) / 100).alias("amount"),
    )
    got = outlook.outlier_treatment(rows).groupBy("category").agg(F.min("amount_treated").alias("a"), F.max("amount_treated").alias("b"))
    for r in got.collect():
        part = sorted(x.amount for x in rows.where(F.col("category") == r.category).collect())
        assert (r.a, r.b) == (part[int(len(part) * 0.01) - 1], part[int(len(part) * 0.99) - 1])


def test_growth_compares_with_the_calendar(spark):
    df = spark.createDataFrame(
        [("m", 10.0, datetime(2024, 1, 3)), ("m", 15.0, datetime(2024, 2, 3)), ("m", 30.0, datetime(2024, 4, 3))],
        "merchant_id string, amount double, timestamp timestamp_ntz",
    ).withColumn("status", F.lit("Success"))
    got = outlook.merchant_growth(df).orderBy("month").collect()
    assert [(r.previous_revenue, r.growth_pct) for r in got] == [(None, None), (10.0, 50.0), (None, None)]


def test_money_sums_do_not_depend_on_partitions(spark):
    df = spark.range(2_000_000).select((F.pmod(F.xxhash64("id"), F.lit(10**11)) / 100).alias("amount"))
    sums = {df.repartition(n).agg(columns.money_sum("amount"), columns.money_avg("amount")).first() for n in (1, 3, 7, 16)}
    assert len(sums) == 1


def test_page_past_the_end_and_unknown_sort(lake):
    args = (lake.transactions, lake.customers, lake.merchants)
    assert transactions.page(*args, page=10_000, limit=100).count() == 0
    newest = transactions.page(*args, limit=1, sort_by="no such column").first()
    assert newest.timestamp == lake.transactions.agg(F.max("timestamp")).first()[0]


def test_filters(lake):
    tx = lake.transactions
    assert transactions.filtered(tx, is_fraud=0).count() == tx.where("is_fraud = 0").count()
    assert transactions.filtered(tx, status="", city=None).count() == tx.count()
    assert transactions.filtered(tx, payment_method=" Credit Card").count() == tx.where("payment_method = 'credit card'").count() > 0
    day = tx.where("timestamp <= '1997-05-05 00:00:00'").count()
    assert transactions.filtered(tx, date_to="1997-05-05").count() == day


def test_search_wildcards(spark):
    df = spark.createDataFrame([("Alpha",), ("beta",), ("a_b",)], "n string")
    assert paging.where_contains(df, "n", "ALP").count() == 1
    assert paging.where_contains(df, "n", "a_").count() == 2
    assert paging.where_contains(df, "n", "").count() == 3


def test_lookup(lake):
    args = (lake.transactions, lake.customers, lake.merchants)
    some = lake.transactions.first().transaction_id
    assert transactions.get(*args, some).count() == 1
    assert transactions.get(*args, "TXN-none").count() == 0


def test_page_plan_cuts_before_joins(lake):
    df = transactions.page(lake.transactions, lake.customers, lake.merchants)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("GlobalLimit") > plan.index("Join")  # the page is cut below the joins


def test_empty_fact(lake):
    tx = lake.transactions.limit(0)
    assert tuple(transactions.stats(tx).first()) == (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert tuple(fraud.totals(tx).first()) == (0, 0.0, 0.0, 0.0)
    assert insights.refund_rate(tx).first()[0] == 0.0
    kpis = executive.executive_kpis(tx, lake.customers, lake.merchants).first()
    assert (kpis.total_transactions, kpis.success_rate) == (0, 0.0)
    assert report.kpis(tx).first().avg_ticket == 0.0
    assert insights.weekend_lift(tx, AS_OF).first().weekend_lift == -100.0
    empty = views.merchant_performance(tx, lake.merchants)
    assert empty.where("total_txns = 0 AND revenue = 0 AND fraud_pct = 0").count() == lake.merchants.count()
    quiet = views.customer_summary(tx, lake.customers)
    segments = customers.segments_heuristic(quiet, AS_OF).collect()
    assert [(r.segment, r.customer_count) for r in segments] == [("casual", lake.customers.count())]


def test_profiles(lake):
    who = lake.transactions.groupBy("customer_id").count().orderBy(F.desc("count"), "customer_id").first()
    row = customers.profile(lake.transactions, lake.customers, lake.merchants, who.customer_id).collect()
    assert len(row) == 1
    assert len(row[0].recent_transactions) == min(20, who["count"])
    assert sum(m.transactions for m in row[0].monthly_spend) == who["count"] == row[0].total_txns
    times = [t.timestamp for t in row[0].recent_transactions]
    assert times == sorted(times, reverse=True)
    one = merchants.profile(lake.transactions, lake.merchants, lake.as_of, "MER00001").collect()
    assert len(one) == 1 and one[0].merchant_id == "MER00001"


def test_rapid_repeats(spark):
    data = [
        ("t1", "c", "m", "2024-01-31 23:50:00"),
        ("t2", "c", "m", "2024-02-01 00:10:00"),
        ("t3", "c", "m", "2024-02-01 00:40:00"),
        ("t4", "c", "m", "2024-02-03 00:41:00"),
        ("t5", "c", "other", "2024-02-03 00:41:00"),
        ("t6", None, "m", "2024-02-03 00:41:00"),
    ]
    df = spark.createDataFrame(data, "transaction_id string, customer_id string, merchant_id string, t string")
    df = df.select("*", F.col("t").cast("timestamp_ntz").alias("timestamp"), F.lit(1.0).alias("amount"))
    got = outlook.rapid_repeat_payments(df, minutes=30)
    assert sorted((r.transaction_id, r.gap_minutes) for r in got.collect()) == [("t2", 20.0), ("t3", 30.0)]


# ------------------------------------------------------------------------ text
def ticket(spark, *values):
    return spark.createDataFrame(values, "ticket_id string, issue_type string, priority string, description string")


@pytest.mark.parametrize(
    "issue, priority, text, want",
    [
        ("General Query", "Low", "", "normal"),
        ("Payment Failed", "Low", None, "normal"),
        ("Account Access", "Low", "x", "high"),
        ("Refund Issue", "High", "x", "high"),
        ("Payment Failed", "High", "x", "critical"),
        ("Fraud Alert", "Low", "act IMMEDIATELY", "critical"),
        ("General Query", "Low", "asap", "high"),
        ("General Query", "Low", "uncritically", "high"),
        ("Fraud Alert", "High", "urgent emergency", "critical"),
    ],
)
def test_urgency(spark, issue, priority, text, want):
    assert tickets.ticket_urgency(ticket(spark, ("t", issue, priority, text))).first().urgency == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("where is my REFUND", "refund_delay"),
        ("it failed, I did not authorize", "payment_failure, fraud_concern"),
        ("Wednesdays offers", "refund_delay, loyalty_query"),
        ("inaccessible", "account_access"),
        ("hello", "general"),
        (None, "general"),
    ],
)
def test_topics(spark, text, want):
    assert tickets.ticket_topics(ticket(spark, ("t", "i", "Low", text))).first().topics == want


def test_keywords(spark):
    text = "Problem with cashback offers and reward points for my recent purchases."
    got = tickets.ticket_keywords(ticket(spark, ("t", "i", "Low", text), ("u", "i", "Low", "of the 12 cat")))
    assert [r.keywords for r in got.orderBy("ticket_id").collect()] == [
        "problem, cashback offers, reward points, recent purchases", "general",
    ]


@pytest.mark.parametrize(
    "text, polarity, label",
    [
        ("Good.", 0.7, "positive"),
        ("not good", -0.35, "negative"),
        ("VERY good", 0.91, "positive"),
        ("excellent, extremely excellent", 0.95, "positive"),
        ("good but terrible", -0.1, "neutral"),
        ("nothing known", 0.0, "neutral"),
        (None, 0.0, "neutral"),
        ("", 0.0, "neutral"),
    ],
)
def test_sentiment(spark, text, polarity, label):
    df = spark.createDataFrame([("r", "m", 1, text)], "review_id string, merchant_id string, rating int, review_text string")
    row = sentiment.review_sentiment(df).first()
    assert (row.polarity, row.sentiment) == (polarity, label)


def test_own_lexicon(spark):
    df = spark.createDataFrame([("meh meh good",)], "t string")
    assert sentiment.with_sentiment(df, "t", {"meh": (-0.4, 1.0)}).first().polarity == -0.4
