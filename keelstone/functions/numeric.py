"""Number handling: the same formula in doubles or in fixed-point decimals."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Numeric:
    """Working types of a calculation.

    In double mode every amount is a double and rounding is left to the output.
    In exact mode amounts are ``decimal(18,2)`` and ratios ``decimal(9,6)``,
    fixed after every step, so that sums do not depend on task order.
    """

    exact: bool = False

    def money(self, value: Column) -> Column:
        return value.cast("decimal(18,2)" if self.exact else "double")

    def ratio(self, value: Column) -> Column:
        return value.cast("decimal(9,6)" if self.exact else "double")

    def rate(self, value: Column) -> Column:
        return value.cast("decimal(18,8)" if self.exact else "double")

    def constant(self, value: float) -> Column:
        return F.lit(Decimal(str(value)).quantize(Decimal("0.000001")) if self.exact else float(value))


def percent_change(now: Column, before: Column) -> Column:
    """``(now - before) / before * 100``; NULL when ``before`` is 0 or NULL."""
    return F.try_divide(now - before, before) * F.lit(100.0)


def share(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL when ``whole`` is 0 or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
