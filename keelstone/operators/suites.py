"""The configured checks of the daily inputs, as data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from keelstone import params
from keelstone.operators import quality as q

POSITIVE_BALANCE = q.Rule(
    "positive_balance", "outstanding_balance > 0", "a loan needs a balance above zero"
)
VALID_ASSET_CLASS = q.Rule(
    "valid_asset_class",
    "asset_class IN (" + ", ".join(f"'{c}'" for c in params.KNOWN_ASSET_CLASSES) + ")",
    "the product maps to no known class",
)


def source_suite(
    loan_rows: tuple[int, int] = params.LOAN_ROWS,
    collateral_rows: tuple[int, int] = params.COLLATERAL_ROWS,
    rating_rows: tuple[int, int] = params.RATING_ROWS,
) -> dict[str, list]:
    """Checks by table. The class rule needs the derived class, so it looks at the
    classified loans (same rows as the raw ones, nothing filtered)."""
    return {
        "loans": [
            q.RowCount(*loan_rows),
            q.Nulls(["loan_id", "customer_id", "outstanding_balance", "asset_class"], 0.1),
            q.Unique(["loan_id"]),
            q.Rules([POSITIVE_BALANCE, VALID_ASSET_CLASS]),
        ],
        "collateral": [
            q.RowCount(*collateral_rows),
            q.Nulls(["collateral_id", "market_value"], 0.1),
        ],
        "ratings": [
            q.RowCount(*rating_rows),
            q.Nulls(["customer_id", "rating"], 0.0),
        ],
    }


def run_source_suite(tables: Mapping[str, DataFrame], **ranges) -> DataFrame:
    return q.run_suite(tables, source_suite(**ranges))
