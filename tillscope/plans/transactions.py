"""Transaction directory, lookup and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import columns as c
from tillscope.operators import paging
from tillscope.operators.count_index import CountIndex, count_index
from tillscope.operators.star import with_names

SORTABLE = ("timestamp", "amount", "status", "category", "risk_level")


def filtered(
    tx: DataFrame, *, status=None, category=None, city=None, payment_method=None,
    is_fraud=None, risk_level=None, date_from=None, date_to=None,
) -> DataFrame:
    """AND of the given filters. Methods are stored in lower case."""
    method = payment_method.strip().lower() if payment_method else None
    tx = paging.where_equal(
        tx, status=status, category=category, city=city, payment_method=method,
        is_fraud=is_fraud, risk_level=risk_level,
    )
    return c.in_range(tx, since=date_from or None, until=date_to or None)


def page(
    tx: DataFrame, customers: DataFrame, merchants: DataFrame, *,
    page: int = 1, limit: int = 25, sort_by: str = "timestamp", sort_order: str = "desc",
    index: CountIndex | None = None, **filters,
) -> DataFrame:
    """One page with names. The page is cut before the dimension joins; rows whose
    customer or merchant is unknown (NULL key) are left out first, as the joins would.

    With the count index of ``tx`` a page by time reads the months that hold it, no others.
    """
    by, descending = sort_by if sort_by in SORTABLE else "timestamp", sort_order == "desc"
    rows = filtered(tx, **filters).where("customer_id IS NOT NULL AND merchant_id IS NOT NULL")
    if index is not None and by == "timestamp" and index.covers(filters):
        cut = _indexed_page(rows, index, page, limit, descending, linked=True, **_stored(filters))
    else:
        cut = paging.far_page(rows, by, "transaction_id", page, limit, descending)
    order = paging.page_order(by, descending, "transaction_id")
    return with_names(cut, customers, merchants).orderBy(*order)


def _stored(filters: dict) -> dict:
    """Filter values as they are stored."""
    method = filters.get("payment_method")
    return {**filters, "payment_method": method.strip().lower() if method else None}


def _indexed_page(rows, index: CountIndex, page: int, limit: int, descending: bool, **filters) -> DataFrame:
    paging.check_page(page, limit)
    offset = (page - 1) * limit
    months, before = index.parts_of(offset, limit, descending, **filters)
    return paging.rows_from(
        index.only(rows, months), "timestamp", "transaction_id", offset - before, limit, descending
    )


def counted(tx: DataFrame) -> CountIndex:
    """The count index that pages of ``tx`` use: rows by month and by every filter with few values."""
    dims = {name: F.col(name) for name in ("status", "category", "payment_method", "is_fraud", "risk_level")}
    dims["linked"] = F.col("customer_id").isNotNull() & F.col("merchant_id").isNotNull()
    return count_index(tx, "txn_month", dims)


def page_total(tx: DataFrame, index: CountIndex | None = None, **filters) -> DataFrame:
    if index is not None and index.covers(filters):
        return index.total(**_stored(filters))
    return paging.total_of(filtered(tx, **filters))


def get(tx: DataFrame, customers: DataFrame, merchants: DataFrame, transaction_id: str) -> DataFrame:
    """One transaction with names; empty when unknown."""
    return with_names(tx.where(F.col("transaction_id") == F.lit(transaction_id)), customers, merchants)


def get_many(tx: DataFrame, customers: DataFrame, merchants: DataFrame, keys: DataFrame) -> DataFrame:
    """The transactions whose ids ``keys`` lists, with names, in one job."""
    wanted = tx.join(keys.select("transaction_id"), "transaction_id", "left_semi")
    return with_names(wanted, customers, merchants)


def stats(tx: DataFrame) -> DataFrame:
    """One row. Revenue and average are those of Success rows."""
    n = F.count(F.lit(1))
    return tx.agg(
        n.alias("total_transactions"),
        c.rounded(c.or_zero(c.sum_where(c.success(), "amount"))).alias("total_revenue"),
        c.rounded(c.or_zero(c.avg_where(c.success(), "amount"))).alias("avg_transaction_value"),
        c.rounded(c.percent(F.count_if(c.success()), n)).alias("success_rate"),
        c.rounded(c.percent(F.count_if(c.failed()), n)).alias("failure_rate"),
        c.rounded(c.percent(F.count_if(c.refunded()), n)).alias("refund_rate"),
    )
