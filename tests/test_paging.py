"""Pages found by counting in ever smaller intervals, and by stored counts."""

import random
import re
from datetime import date, datetime
from decimal import Decimal

import pytest

from tillscope.operators import paging, refine
from tillscope.plans import transactions

rng = random.Random(1)
MANY = 900
VALUES = {
    "double": [*[rng.choice([0.0, -0.0, 1.5, -2.25, 1e300, -1e300, float("inf"), float("-inf"), float("nan"), None])
                 for _ in range(MANY // 2)], *[rng.uniform(-5, 5) for _ in range(MANY // 2)]],
    "long": [rng.choice([None, 2**62, 2**62 + 1, -(2**62), rng.randrange(50)]) for _ in range(MANY)],
    "string": [rng.choice(["Success", "Failed", "Refunded", "Fa", "", None, "Zürich", "日本"]) for _ in range(MANY)],
    "timestamp_ntz": [rng.choice([None, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, rng.randrange(99)),
                                  datetime(1960, 5, rng.randint(1, 20))]) for _ in range(MANY)],
    "date": [rng.choice([None, date(2024, 1, rng.randint(1, 5))]) for _ in range(MANY)],
    "decimal(20,2)": [rng.choice([None, Decimal("1.25"), Decimal(rng.randrange(900)) / 100]) for _ in range(MANY)],
    "boolean": [rng.choice([None, True, False]) for _ in range(MANY)],
}


@pytest.mark.parametrize("kind", sorted(VALUES))
@pytest.mark.parametrize("descending", [True, False])
def test_refined_keys_are_those_of_the_sorted_table(spark, kind, descending):
    """Also where the page crosses intervals, kinds of values and the end."""
    ids = [f"TXN{rng.randrange(10**6):07d}-{k}" for k in range(len(VALUES[kind]))]
    df = spark.createDataFrame(list(zip(VALUES[kind], ids)), f"v {kind}, id string").repartition(5).cache()
    want = [r.id for r in df.orderBy(*paging.page_order("v", descending, "id")).collect()]
    for offset, limit in ((0, 25), (333, 25), (MANY - 30, 100), (MANY, 5)):
        assert refine.keys_at(df, "v", "id", offset, limit, descending, most=17) == want[offset : offset + limit]


def test_only_a_bounded_number_of_rows_is_ranked(spark):
    """One value holds all rows: the interval goes on by key."""
    df = spark.range(60_000).selectExpr("'Success' AS v", "concat('TXN', lpad(id, 9, '0')) AS id")
    keys = refine.sort_keys(df, "v", "id", True)
    here = refine.locate(keys, 31_234, True, most=500)
    assert here.rows <= 500 and here.before <= 31_234 < here.before + here.rows
    page = paging.far_page(df, "v", "id", 500, 100)
    assert [r.id for r in page.collect()] == [f"TXN{k:09d}" for k in range(49_900, 50_000)]


def test_a_near_page_reads_its_table_once(spark, lake):
    plan = paging.far_page(lake.transactions, "status", "transaction_id", 2, 100)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1 and "TakeOrderedAndProject" in plan.toString()


def test_the_index_names_the_months_to_read(lake):
    index, tx = lake.transaction_counts, lake.transactions
    for descending in (True, False):
        for page in (1, 30, 60, 10_000):
            got = transactions.page(
                tx, lake.customers, lake.merchants, page=page, limit=20, sort_order="desc" if descending else "asc", index=index
            )
            rows = transactions.page(tx, lake.customers, lake.merchants, page=page, limit=20,
                                     sort_order="desc" if descending else "asc")
            assert [r.transaction_id for r in got.collect()] == [r.transaction_id for r in rows.collect()]
    months, before = index.parts_of(0, 20, True)
    plan = index.only(tx, months)._jdf.queryExecution().executedPlan().toString()
    assert len(months) <= 2 and before == 0
    assert re.search(r"PartitionFilters: \[[^]]*txn_month", plan)


def test_totals_from_the_index(lake):
    for filters in ({}, {"status": "Failed"}, {"payment_method": " UPI ", "is_fraud": 0}, {"city": "no index"}):
        with_index = transactions.page_total(lake.transactions, index=lake.transaction_counts, **filters).first()
        assert with_index == transactions.page_total(lake.transactions, **filters).first()
