"""Raw snapshots to clean tables. Each function is one projection (plus filters)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.functions import codes
from keelstone.operators import filters, ratings as rating_ops
from keelstone.operators.filters import as_date
from keelstone.params import DEFAULTS


def cast_cols(df: DataFrame, types: Mapping[str, object], lenient: bool = False) -> DataFrame:
    """Cast the named columns. ``lenient`` gives NULL instead of an error on bad text."""
    cast = {c: F.col(c).try_cast(t) if lenient else F.col(c).cast(t) for c, t in types.items()}
    return df.withColumns(cast)


def normalise_codes(
    df: DataFrame, upper: Sequence[str] = (), trim_only: Sequence[str] = ()
) -> DataFrame:
    """Trim the named code columns; those in ``upper`` are also upper-cased."""
    changes = {c: codes.clean_code(F.col(c)) for c in upper}
    changes |= {c: F.trim(F.col(c)) for c in trim_only}
    return df.withColumns(changes)


def with_tenor(df: DataFrame, as_of) -> DataFrame:
    """Days left to maturity and days since origination, both at the run date."""
    day = as_date(as_of)
    return df.withColumns(
        {
            "days_to_maturity": F.datediff(F.col("maturity_date"), day),
            "loan_age_days": F.datediff(day, F.col("origination_date")),
        }
    )


def with_valuation_age(df: DataFrame, as_of) -> DataFrame:
    return df.withColumn(
        "days_since_valuation", F.datediff(as_date(as_of), F.col("valuation_date"))
    )


def with_asset_class(df: DataFrame, product: str = "product_type") -> DataFrame:
    return df.withColumn("asset_class", codes.asset_class(F.col(product)))


def apply_haircut(
    df: DataFrame, value: str = "market_value", haircut: str = "haircut_percentage"
) -> DataFrame:
    """Market value less its haircut, in exact decimal arithmetic."""
    return df.withColumn("adjusted_collateral_value", F.col(value) * (F.lit(1) - F.col(haircut)))


def flag_stale(df: DataFrame, days: int = DEFAULTS.stale_after_days) -> DataFrame:
    """Flag valuations older than ``days``; an unknown age is not stale."""
    old = F.col("days_since_valuation") > days
    return df.withColumn("valuation_stale_flag", F.coalesce(old, F.lit(False)))


def with_rating_numeric(df: DataFrame, rating: str = "rating") -> DataFrame:
    return df.withColumn("rating_numeric", codes.rating_numeric(F.col(rating)))


def standardise_loans(
    df: DataFrame, as_of, drop_invalid: bool = True, drop_matured: bool = True
) -> DataFrame:
    """Typed, cleaned, dated and classified loans; dead loans removed."""
    out = cast_cols(df, {"outstanding_balance": schemas.MONEY})
    out = normalise_codes(
        out, upper=["currency", "product_type", "country_code", "internal_rating"]
    )
    if drop_invalid:
        out = filters.positive_balance(out)
    if drop_matured:
        out = filters.unmatured(out, as_of)
    return with_asset_class(with_tenor(out, as_of))


def standardise_collateral(
    df: DataFrame, as_of, stale_after_days: int = DEFAULTS.stale_after_days
) -> DataFrame:
    out = cast_cols(df, {"market_value": schemas.MONEY, "haircut_percentage": schemas.RATIO})
    out = normalise_codes(out, upper=["collateral_type"])
    return flag_stale(with_valuation_age(apply_haircut(out), as_of), stale_after_days)


def standardise_counterparty(df: DataFrame) -> DataFrame:
    return cast_cols(
        normalise_codes(df, upper=["customer_type"]), {"total_assets": schemas.MONEY}
    )


def standardise_ratings(
    df: DataFrame, tie_break: Sequence[str] = (), common_scale: bool = False
) -> DataFrame:
    """Clean symbols, newest row per customer and agency, with its ordinal."""
    out = normalise_codes(df, upper=["rating_agency", "rating"])
    if common_scale:
        out = out.withColumn("rating", codes.common_notch(F.col("rating")))
    return with_rating_numeric(rating_ops.latest_rating(out, tie_break=tie_break))


def standardise_fx(df: DataFrame) -> DataFrame:
    return cast_cols(normalise_codes(df, upper=["currency_pair"]), {"rate": schemas.RATE})


def stage_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table: one scan per table, one small result."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
