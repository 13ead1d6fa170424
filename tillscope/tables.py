"""The five entities an operator works on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    customers: DataFrame
    merchants: DataFrame
    transactions: DataFrame
    reviews: DataFrame
    tickets: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        names = ("customers", "merchants", "transactions", "reviews", "tickets")
        return [(name, getattr(self, name)) for name in names]
