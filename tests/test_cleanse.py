from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillscope import schemas
from tillscope.functions import columns as c
from tillscope.operators import cleanse, quality
from tillscope.plans import silver


def rows(df):
    return [tuple(r) for r in df.collect()]


def raw_tx(spark, *values):
    names = "transaction_id customer_id merchant_id amount payment_method timestamp status device_type"
    return spark.createDataFrame(values, " string, ".join(names.split()) + " string")


def test_complete_duplicate_wins(spark):
    df = spark.createDataFrame(
        [("a", None, "x"), ("a", "m@x", "y"), ("b", None, "z")], "customer_id string, email string, customer_name string"
    )
    assert rows(silver._cleansed(df, "customers")) == [("a", "m@x", "y")]


def test_dedup_does_not_depend_on_order(spark):
    data = [("k", i % 3, str(i)) for i in range(50)]
    df = spark.createDataFrame(data, "k string, a int, b string")
    want = rows(cleanse.dedup(df, "k", ["k"]))
    for parts in (1, 3, 7):
        assert rows(cleanse.dedup(df.orderBy(F.rand(parts)).repartition(parts), "k", ["k"])) == want
    assert want == [("k", 0, "0")]


def test_dedup_cuts_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS v")
    plan = cleanse.dedup(df, "k", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_transactions_bad_values_and_flags(spark):
    df = raw_tx(
        spark,
        ("t1", "c", "m", "abc", " UPI ", "bad", "Success", "Mobile "),
        ("t2", "c", "m", "5000", "Wallet", "2024-01-05 23:00:00", None, "Tablet"),  # Friday
        ("t3", "c", "m", "5000.01", "Wallet", "2024-01-06 04:59:59", "Failed", "Tablet"),  # Saturday
        ("t4", "c", "m", "1", "Wallet", "2024-01-07 00:00:00", "Failed", "Tablet"),  # Sunday
        ("t5", "c", "m", "1", "Wallet", "2024-01-08 05:00:00", "Failed", "Tablet"),  # Monday
        ("t6", None, "m", "1", "Wallet", "2024-01-08 05:00:00", "Failed", "Tablet"),
    )
    got = {
        r.transaction_id: (r.amount, r.txn_hour, r.is_weekend, r.is_high_value, r.is_late_night)
        for r in silver.transactions(df).collect()
    }
    assert got == {
        "t1": (None, None, 0, 0, 0),
        "t2": (5000.0, 23, 0, 0, 0),
        "t3": (5000.01, 4, 1, 1, 1),
        "t4": (1.0, 0, 1, 0, 1),
        "t5": (1.0, 5, 0, 0, 0),
    }
    first = silver.transactions(df).where("transaction_id = 't1'").first()
    assert (first.payment_method, first.device_type) == ("upi", "mobile")


def test_backslash_n(spark):
    df = spark.createDataFrame(
        [("r", "t", "c", "m", 5, "a\\nb\nc", datetime(2024, 1, 1))], schemas.REVIEWS
    )
    row = silver.reviews(df).first()
    assert (row.review_text, row.review_length) == ("a b\nc", 5)




@pytest.mark.parametrize("value, want", [(2.675, 2.68), (1.005, 1.01), (-0.125, -0.13), (0.1 + 0.2, 0.3)])
def test_rounded(spark, value, want):
    assert spark.range(1).select(c.rounded(F.lit(value))).first()[0] == want


def test_rounded_not_finite(spark):
    df = spark.range(1).select(c.rounded(F.lit(float("nan"))).alias("a"), c.rounded(F.lit(float("inf"))).alias("b"))
    assert tuple(df.first()) == (None, None)


def test_orphans(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a",)], "k string")
    assert sorted(rows(cleanse.null_orphans(fact, dim, "k")), key=lambda r: r[1]) == [("a", 1), (None, 2), (None, 3)]
    assert rows(cleanse.orphans(fact, dim, "k")) == [("b", 2)]


def test_nan_and_defaults(spark):
    df = spark.createDataFrame([(float("nan"), None), (1.0, 2)], "x double, y int")
    assert rows(cleanse.nan_to_null(df)) == [(None, None), (1.0, 2)]
    assert rows(cleanse.with_defaults(df.select("y"), {"y": 0, "z": 1})) == [(0, 1), (2, 1)]


def test_quarantine(spark):
    contract = quality.Contract(key=("id",), not_null=("id",), ranges={"h": (0, 23)}, lengths={"id": 3})
    df = spark.createDataFrame([("a", 0), ("b", 24), ("abcd", 99), (None, 1), ("c", None)], "id string, h int")
    good, bad = quality.quarantine(df, contract)
    assert rows(good) == [("a", 0), ("c", None)]
    assert sorted((r.id or "", r.broken_rules) for r in bad.collect()) == [
        ("", ["not_null:id"]), ("abcd", ["range:h", "length:id"]), ("b", ["range:h"]),
    ]


def test_quality_counts(spark, lake):
    got = {(r.table_name, r["rule"]): r.violations for r in quality.quality_report(lake.bronze).collect()}
    assert got["transactions", "unique:transaction_id"] == 6000 - lake.transactions.count()
    assert got["transactions", "reference:customer_id"] == 0


def test_label3(spark):
    df = spark.createDataFrame([(0.1,), (-0.1,), (0.11,), (-0.11,), (None,), (float("nan"),)], "p double")
    got = [r[0] for r in df.select(c.label3(F.col("p"))).collect()]
    assert got == ["neutral", "neutral", "positive", "negative", "neutral", "neutral"]


def test_ranges(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1),), (datetime(2024, 1, 31, 23),), (datetime(2024, 2, 1),), (datetime(2024, 2, 1, 1),)],
        "timestamp timestamp_ntz",
    )
    assert c.in_range(df, since="2024-01-01", until="2024-02-01").count() == 3
    assert c.trailing(df, date(2024, 1, 31), 30).count() == 2
    assert c.trailing(df, date(2024, 2, 1), 1).count() == 3


def test_month_layout_prunes(lake):
    df = c.in_range(lake.transactions, since="2001-07-02", before="2001-08-02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan
    assert df.count() == lake.transactions.where("timestamp >= '2001-07-02' AND timestamp < '2001-08-02'").count()
