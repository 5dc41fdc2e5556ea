"""The per-loan capital calculation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.functions import codes, risk
from keelstone.functions.numeric import Numeric
from keelstone.operators import fx as fx_ops
from keelstone.operators import joins
from keelstone.operators.filters import as_date
from keelstone.params import DEFAULTS, Settings
from keelstone.sources import reference


def with_rating(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    final = risk.final_rating(F.col("rating"), F.col("internal_rating"), settings)
    return df.withColumn("final_rating", final).withColumn(
        "rating_bucket", codes.rating_bucket(F.col("final_rating"), settings)
    )


def with_exposure(
    df: DataFrame, ccf: DataFrame | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Exposure type, conversion factor and exposure at default."""
    num = Numeric(settings.exact)
    ccf = reference.ccf_table(df.sparkSession) if ccf is None else ccf
    typed = df.withColumn("exposure_type", codes.exposure_type(F.col("product_type")))
    converted = joins.attach_ccf(typed, ccf, settings, num)
    return converted.withColumn(
        "exposure_at_default",
        risk.exposure_at_default(
            F.col("outstanding_balance_usd"), F.col("credit_conversion_factor"), num
        ),
    )


def with_mitigation(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Collateral coverage and the exposure left after it."""
    num = Numeric(settings.exact)
    ead = F.col("exposure_at_default")
    covered = risk.collateral_coverage(F.col("adjusted_collateral_value_usd"), ead, num)
    return df.withColumn("collateral_coverage_ratio", covered).withColumn(
        "ead_after_crm", risk.ead_after_mitigation(ead, F.col("collateral_coverage_ratio"), num)
    )


def with_capital(
    df: DataFrame, weights: DataFrame | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Risk weight, floor, risk-weighted assets and capital (all after the floor)."""
    num = Numeric(settings.exact)
    weights = reference.risk_weights(df.sparkSession) if weights is None else weights
    weighted = joins.attach_risk_weight(df, weights, settings, num)
    floored = risk.floored_weight(F.col("asset_class"), F.col("risk_weight"), settings, num)
    return (
        weighted.withColumn("risk_weight_floored", floored)
        .withColumn(
            "risk_weighted_assets",
            risk.risk_weighted_assets(F.col("ead_after_crm"), F.col("risk_weight_floored"), num),
        )
        .withColumn(
            "regulatory_capital",
            risk.regulatory_capital(F.col("risk_weighted_assets"), settings, num),
        )
    )


def with_loss(
    df: DataFrame, lgd: DataFrame | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Probability of default, loss given default and expected loss."""
    num = Numeric(settings.exact)
    lgd = reference.lgd_table(df.sparkSession) if lgd is None else lgd
    pd = risk.probability_of_default(F.col("rating_bucket"), settings, num)
    valued = joins.attach_lgd(df, lgd, settings, num).withColumn("probability_of_default", pd)
    return valued.withColumn(
        "expected_loss",
        risk.expected_loss(
            F.col("ead_after_crm"),
            F.col("probability_of_default"),
            F.col("loss_given_default"),
            num,
        ),
    )


def with_flags(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.withColumns(
        {
            "high_risk_flag": risk.high_risk(
                F.col("risk_weight"),
                F.col("probability_of_default"),
                F.col("days_to_maturity"),
                settings,
            ),
            "data_quality_score": risk.quality_score(F.col("rating"), F.col("internal_rating")),
            "geography": codes.geography(F.col("country_code")),
        }
    )


def with_metadata(
    df: DataFrame, as_of, created: dt.datetime | Column | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Run date, method and creation time. The time is given, so reruns are equal."""
    day = as_date(as_of)
    if created is None:
        created = day
    elif not isinstance(created, Column):
        created = F.lit(created.isoformat(sep=" "))
    return df.withColumns(
        {
            "calculation_date": day,
            "calculation_method": F.lit(settings.method),
            "basel_version": F.lit(settings.version),
            "created_timestamp": created.cast("timestamp_ntz"),
        }
    )


def calculate(
    enriched: DataFrame,
    as_of,
    settings: Settings = DEFAULTS,
    created: dt.datetime | Column | None = None,
    weights: DataFrame | None = None,
    ccf: DataFrame | None = None,
    lgd: DataFrame | None = None,
) -> DataFrame:
    """All per-loan steps over an enriched loan frame."""
    out = with_rating(enriched, settings)
    out = with_exposure(out, ccf, settings)
    out = with_mitigation(out, settings)
    out = with_capital(out, weights, settings)
    out = with_loss(out, lgd, settings)
    out = with_flags(out, settings)
    return with_metadata(out, as_of, created, settings)


def converted_collateral(
    collateral: DataFrame, fx: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    return fx_ops.to_reporting_ccy(
        collateral, fx, "adjusted_collateral_value", "adjusted_collateral_value_usd",
        settings=settings,
    )


def detail(
    loans: DataFrame,
    ratings: DataFrame,
    collateral: DataFrame,
    fx: DataFrame,
    as_of,
    settings: Settings = DEFAULTS,
    salts: int = 10,
    profile: DataFrame | None = None,
    null_keys: str = "spread",
    unique_collateral: bool = False,
    **options,
) -> DataFrame:
    """Standardised tables to the 25-column fact, one row per loan.

    None of the result's columns comes from the counterparty, and its left join
    cannot change the rows, so it is not part of this plan; see ``joins.enrich``.
    """
    converted = fx_ops.to_reporting_ccy(
        loans, fx, "outstanding_balance", "outstanding_balance_usd", settings=settings
    )
    enriched = joins.enrich(
        converted, ratings, converted_collateral(collateral, fx, settings),
        settings=settings, salts=salts, profile=loans if profile is None else profile,
        null_keys=null_keys, unique_collateral=unique_collateral,
    )
    return calculate(enriched, as_of, settings, **options).select(*schemas.DETAIL_COLUMNS)
