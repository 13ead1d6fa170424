"""Stored counts: refreshed months against counting all anew."""

from datetime import date

from pyspark.sql import functions as F

from tillscope.operators import pair_months as pm

SCHEMA = ("transaction_id long, merchant_id string, customer_id string, amount double, status string, is_fraud int, "
          "timestamp timestamp_ntz, txn_month date")  # fmt: skip


def table(spark, n=2000, changed=()):
    rows = spark.range(n).select(
        F.col("id").alias("transaction_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("m"), (F.col("id") % 7).cast("string"))).alias("merchant_id"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("c"), (F.col("id") % 40).cast("string"))).alias("customer_id"),
        (F.col("id") % 100 + F.when(((F.col("id") % 4) + 1).isin(list(changed)), 0.5).otherwise(0.0)).alias("amount"),
        F.when(F.col("id") % 5 > 0, "Success").otherwise("Refunded").alias("status"), (F.col("id") % 50 == 0).cast("int").alias("is_fraud"),
        F.make_date(F.lit(2001), (F.col("id") % 4 + 1).cast("int"), F.lit(1)).alias("txn_month"),
    )
    return rows.withColumn("timestamp", F.col("txn_month").cast("timestamp_ntz")).selectExpr(*(x.split()[0] for x in SCHEMA.split(", ")))


def figures(spark, path):
    both = (pm.merchants, pm.customers)
    return [sorted(map(tuple, f(pm.stored(spark, path)).collect()), key=str) for f in both]


def test_refreshed_equals_rebuilt(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    pm.refresh(table(spark), a)
    old = figures(spark, a)
    new = table(spark, changed=[2, 3]).where("txn_month <> DATE '2001-03-01'")  # one month changed, one emptied
    pm.refresh(new, a, [date(2001, 2, 1), date(2001, 3, 1)])
    pm.refresh(new, b)
    assert figures(spark, a) == figures(spark, b) != old
    pm.refresh(new, a, [])
    assert figures(spark, a) == figures(spark, b)


def test_only_the_months_named_are_read(spark, tmp_path):
    source, path = str(tmp_path / "tx"), str(tmp_path / "p")
    table(spark).write.partitionBy("txn_month").parquet(source)
    tx = spark.read.parquet(source)
    pm.refresh(tx, path)
    for month in (1, 2, 4):  # any reader of another month would fail
        for file in (tmp_path / "tx" / f"txn_month=2001-{month:02d}-01").glob("*.parquet"):
            file.write_bytes(b"broken")
    pm.refresh(spark.read.schema(tx.schema).parquet(source), path, [date(2001, 3, 1)])
    assert pm.stored(spark, path).agg(F.sum("n")).first()[0] == 2000


def test_null_keys_and_empty(spark, tmp_path):
    path = str(tmp_path / "e")
    rows = [(1, None, "c", None, "Success", None, None, date(2001, 1, 1)), (2, None, None, 2.0, "Success", 1, None, date(2001, 1, 1))]
    pm.refresh(spark.createDataFrame(rows, SCHEMA), path)
    got = pm.merchants(pm.stored(spark, path)).first()
    assert (got.merchant_id, got.total_txns, got.revenue, got.unique_customers, got.fraud_pct) == (None, 2, 2.0, 1, 50.0)
    pm.refresh(spark.createDataFrame([], SCHEMA), path, [date(2001, 1, 1)])
    assert pm.merchants(pm.stored(spark, path)).collect() == []
