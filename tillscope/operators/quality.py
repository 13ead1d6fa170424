"""Table contracts as counts of violations, and the split of bad rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.operators.cleanse import orphans
from tillscope.tables import Tables


@dataclass(frozen=True)
class Contract:
    """What a table promises. A NULL passes ranges and lengths."""

    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)  # column -> table


# The limits of the warehouse tables.
CONTRACTS = {
    "customers": Contract(
        key=("customer_id",),
        not_null=("customer_id", "customer_name"),
        lengths={
            "customer_id": 10, "customer_name": 100, "email": 100, "phone": 20,
            "city": 50, "state": 50, "device_preference": 20,
        },
    ),
    "merchants": Contract(
        key=("merchant_id",),
        not_null=("merchant_id", "merchant_name"),
        ranges={"risk_score": (0, 100)},
        lengths={
            "merchant_id": 10, "merchant_name": 200, "category": 50,
            "city": 50, "state": 50, "status": 20,
        },
    ),
    "transactions": Contract(
        key=("transaction_id",),
        not_null=("transaction_id", "amount", "timestamp"),
        ranges={"transaction_hour": (0, 23)},
        lengths={
            "transaction_id": 15, "customer_id": 10, "merchant_id": 10, "payment_method": 20,
            "category": 50, "city": 50, "state": 50, "status": 20, "device_type": 20, "risk_level": 10,
        },
        references={"customer_id": "customers", "merchant_id": "merchants"},
    ),
    "reviews": Contract(key=("review_id",), not_null=("review_id",), ranges={"rating": (1, 5)}),
    "tickets": Contract(key=("ticket_id",), not_null=("ticket_id",)),
}


def row_checks(contract: Contract, columns: list[str]) -> dict[str, Column]:
    """Name -> true for a bad row, for the checks a row alone decides."""
    checks = {f"not_null:{c}": F.col(c).isNull() for c in contract.not_null if c in columns}
    for c, (low, high) in contract.ranges.items():
        if c in columns:
            checks[f"range:{c}"] = ~F.col(c).between(low, high)
    for c, most in contract.lengths.items():
        if c in columns:
            checks[f"length:{c}"] = F.length(c) > most
    return checks


def duplicates(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row: how many rows share their key with an earlier one."""
    return (
        df.groupBy(*key)
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations"))
    )


def _table_report(name: str, df: DataFrame, contract: Contract, tables: dict) -> list[DataFrame]:
    checks = row_checks(contract, df.columns)
    unique = f"unique:{','.join(contract.key)}"
    # What a row alone decides is one sum per task; only keys and references need their rows together.
    counts = df.agg(*[F.count_if(bad).alias(rule) for rule, bad in checks.items()])
    parts = [duplicates(df, contract.key).select(F.lit(unique).alias("rule"), "violations")]
    if checks:
        parts.append(counts.unpivot([], [F.col(f"`{rule}`") for rule in checks], "rule", "violations"))
    for column, target in contract.references.items():
        # Counted per key first: a key moves once, however many rows it has.
        keys = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        lost = orphans(keys, tables[target], column).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        parts.append(lost.select(F.lit(f"reference:{column}").alias("rule"), "violations"))
    return [p.select("rule", F.lit(name).alias("table_name"), "violations") for p in parts]


def quality_report(tables: Tables, contracts: dict[str, Contract] = CONTRACTS) -> DataFrame:
    """(rule, table_name, violations). Per table one pass without a shuffle for the row
    checks, one count per key, and one anti join per reference."""
    named = dict(tables.items())
    parts = [
        part
        for name, contract in contracts.items()
        for part in _table_report(name, named[name], contract, named)
    ]
    return reduce(DataFrame.unionByName, parts)


def quarantine(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the list of rules they break)."""
    checks = row_checks(contract, df.columns)
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in checks.items()]))
    marked = df.withColumn("broken_rules", broken)
    good = marked.where(F.size("broken_rules") == 0).drop("broken_rules")
    return good, marked.where(F.size("broken_rules") > 0)


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(load_order, table_name, row_count), dimensions before the fact."""
    order = ["customers", "merchants", "transactions"]
    parts = [
        tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(i).alias("load_order"), F.lit(name).alias("table_name"), "row_count"
        )
        for i, name in enumerate(order, 1)
    ]
    return reduce(DataFrame.unionByName, parts)
