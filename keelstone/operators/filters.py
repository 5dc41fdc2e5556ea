"""Row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(day: dt.date | str | Column) -> Column:
    """A run date given as a date, an ISO string or a date column."""
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def positive_balance(df: DataFrame, balance: str = "outstanding_balance") -> DataFrame:
    """Keep rows with a balance above 0; NULL balances go too."""
    return df.where(F.col(balance) > 0)


def unmatured(df: DataFrame, as_of, maturity: str = "maturity_date") -> DataFrame:
    """Keep loans that mature after the run date."""
    return df.where(F.col(maturity) > as_date(as_of))


def date_slice(df: DataFrame, as_of, column: str = "calculation_date") -> DataFrame:
    return df.where(F.col(column) == as_date(as_of))


def high_risk_only(df: DataFrame, flag: str = "high_risk_flag") -> DataFrame:
    return df.where(F.col(flag))


def rule_violations(df: DataFrame, condition: str) -> DataFrame:
    """Rows that break ``condition``. A NULL outcome is not a violation."""
    return df.where(~F.expr(condition))


def outliers(df: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """Rows strictly outside mean +- k sample deviations of ``column``.

    The two statistics come from a scalar subquery, so there is no driver round
    trip. With a deviation of 0 or NULL no row is an outlier.
    """
    value = F.col(column).cast("double")
    band = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev(value).alias("std"))).scalar()
    mean, std = band.getField("mean"), band.getField("std")
    return df.where((std > 0) & (F.abs(value - mean) > std * F.lit(float(k))))
