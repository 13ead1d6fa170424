"""Files to report, end to end."""

import os
from datetime import date

import pytest

from tillscope import jobs, schemas
from tillscope.sources.csv import FILES, read_csv, write_csv
from tillscope.sources.lake import jdbc_table, read_table, replace_partition, warehouse_query
from tillscope.tables import Tables

AS_OF = date(2001, 8, 1)


@pytest.fixture(scope="module")
def folders(spark, lake, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    data, root = f"{base}/data", f"{base}/lake"
    for name, df in Tables(
        lake.customers, lake.merchants, lake.transactions, lake.bronze.reviews, lake.bronze.tickets
    ).items():
        write_csv(df.select(*schemas.ENTITIES[name].names), f"{data}/{FILES[name]}")
    return data, root


def test_medallion(spark, lake, folders):
    data, root = folders
    jobs.ingest(spark, data, root)
    jobs.cleanse(spark, root)
    jobs.aggregate(spark, root)
    tx = read_table(spark, f"{root}/silver/transactions")
    names = schemas.TRANSACTIONS.names
    assert tx.select(*names).exceptAll(lake.transactions.select(*names)).count() == 0
    assert tx.count() == lake.transactions.count()
    assert any(f.startswith("txn_month=") for f in os.listdir(f"{root}/silver/transactions"))
    assert sorted(os.listdir(f"{root}/gold")) == [
        "customer_segments", "daily_revenue", "fraud_summary", "merchant_kpis", "payment_trends", "support_metrics",
    ]
    jobs.aggregate_warehouse(spark, root, AS_OF)
    assert len(os.listdir(f"{root}/warehouse")) == 6
    assert read_table(spark, f"{root}/quarantine/transactions").count() == 0
    reviews = read_table(spark, f"{root}/silver/reviews")
    assert reviews.exceptAll(lake.reviews).count() == 0 and reviews.count() == lake.reviews.count()


def test_warehouse_load(spark, lake, folders):
    data, root = folders
    report = {r.table_name: r.row_count for r in jobs.load_warehouse(spark, data, root).collect()}
    assert report == {
        "dim_customers": lake.customers.count(),
        "dim_merchants": lake.merchants.count(),
        "fact_transactions": lake.transactions.count(),
    }
    missing = {r.table_name: r.row_count for r in jobs.load_warehouse(spark, f"{data}/none", root).collect()}
    assert set(missing.values()) == {0}
    assert read_table(spark, f"{root}/warehouse/fact_transactions").count() == lake.transactions.count()


def test_models_and_report(spark, lake, folders):
    data, root = folders
    tables = Tables(lake.customers, lake.merchants, lake.transactions, lake.reviews, lake.tickets)
    jobs.score_fraud(tables, root)
    jobs.segment_customers(tables, root, AS_OF, restarts=2)
    jobs.score_reviews(tables, root)
    jobs.tag_tickets(tables, root)
    jobs.forecast_daily(tables, root)
    jobs.summarise(tables, root, AS_OF)
    jobs.write_report(tables, root, f"{root}/report")
    assert set(os.listdir(f"{root}/report")) == {"kpis", "fraud", "insights", "merchants", "segments", "tickets"}
    text = [r.summary for r in spark.read.json(f"{root}/report/insights").orderBy("id").collect()]
    assert len(text) == 6 and "%s" not in " ".join(text) and "null" not in " ".join(text)
    jobs.write_report(tables, root, f"{root}/csv", fmt="csv")
    again = spark.read.option("header", True).option("escape", '"').csv(f"{root}/csv/insights").orderBy("id")
    assert [r.summary for r in again.collect()] == text


def test_replace_one_metric(spark, tmp_path):
    path = str(tmp_path / "f")
    names = "metric_name string, v int"
    replace_partition(spark.createDataFrame([("a", 1), ("b", 2)], names), path, "metric_name")
    replace_partition(spark.createDataFrame([("a", 3)], names), path, "metric_name")
    assert sorted((r.metric_name, r.v) for r in read_table(spark, path).collect()) == [("a", 3), ("b", 2)]


def test_malformed_line_is_kept_apart(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,x\na,1\nb,oops\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("x", T.IntegerType())])
    df = read_csv(spark, str(tmp_path / "t.csv"), schema)
    assert df.select("k", "_corrupt_record").where("_corrupt_record IS NULL").collect()[0].k == "a"
    got = {r.k: (r.x, r._corrupt_record) for r in df.collect()}
    assert got == {"a": (1, None), "b": (None, "b,oops")}


def test_parameters_bind(spark):
    spark.range(5).createOrReplaceTempView("numbers")
    assert warehouse_query(spark, "SELECT id FROM numbers WHERE id = :x", {"x": 3}).first().id == 3
    assert callable(jdbc_table)
