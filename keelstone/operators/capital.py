"""Documented capital rules beyond the daily calculation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone import params
from keelstone.functions.codes import recode
from keelstone.operators.joins import skew_join, spread_keys


def drawn_undrawn_ead(drawn: Column, limit: Column, commitment: Column) -> Column:
    """Drawn balance in full plus the unused limit at its conversion factor."""
    undrawn = F.greatest(limit - drawn, F.lit(0.0))
    return drawn + undrawn * recode(commitment, params.UNDRAWN_CONVERSION, 1.0)


def capital_layers(
    countercyclical: float = 0.0, systemic: float | None = None
) -> list[tuple[str, float, bool]]:
    """Minimum layers and buffers; a ranged buffer is checked against its range."""
    low, high = params.COUNTERCYCLICAL_RANGE
    if not low <= countercyclical <= high:
        raise ValueError(f"countercyclical rate {countercyclical} outside [{low}, {high}]")
    layers = [*params.CAPITAL_LAYERS, ("COUNTERCYCLICAL_BUFFER", countercyclical, True)]
    if systemic is not None:
        low, high = params.SYSTEMIC_RANGE
        if not low <= systemic <= high:
            raise ValueError(f"systemic rate {systemic} outside [{low}, {high}]")
        layers.append(("SYSTEMIC_BUFFER", systemic, True))
    return layers


def capital_stack(
    totals: DataFrame, layers: list[tuple[str, float, bool]], rwa: str = "total_rwa"
) -> DataFrame:
    """Every capital layer of every row of ``totals``.

    The handful of layers is a literal array that each row unfolds: no join.
    """
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("layer"),
                F.lit(float(rate)).alias("layer_rate"),
                F.lit(buffer).alias("is_buffer"),
            )
            for name, rate, buffer in layers
        ]
    )
    return totals.select("*", F.inline(table)).withColumn(
        "capital_amount", F.col(rwa).cast("double") * F.col("layer_rate")
    )


def output_floor(model_rwa: Column, standard_rwa: Column, floor: float = params.OUTPUT_FLOOR) -> Column:
    """Portfolio total not below its share of the standardised total."""
    return F.greatest(model_rwa, standard_rwa * F.lit(floor))


def sme_weight(
    asset_class: Column, weight: Column, qualifies: Column, reduction: float = params.SME_REDUCTION
) -> Column:
    """Weight of a qualifying small-business exposure after its reduction."""
    reduced = weight * F.lit(1.0 - reduction)
    return F.when((asset_class == "CORPORATE_SME") & qualifies, reduced).otherwise(weight)


def with_standard_haircut(
    collateral: DataFrame, haircuts: DataFrame, value: str = "market_value"
) -> DataFrame:
    """Documented haircut of the collateral's class; a class without one gets no credit."""
    haircut = F.coalesce(F.col("standard_haircut"), F.lit(1.0))
    joined = collateral.join(F.broadcast(haircuts), "collateral_type", "left")
    return joined.select(
        *collateral.columns,
        haircut.alias("standard_haircut"),
        (F.col(value).cast("double") * (F.lit(1.0) - haircut)).alias("standard_value"),
    )


def ltv_weight(
    asset_class: Column,
    weight: Column,
    ltv: Column,
    bands: list[tuple[float, float]],
) -> Column:
    """Mortgage weight by loan-to-value.

    ``bands`` lists ``(above, weight)``; the highest band below the ratio applies
    when it is higher than the loan's own weight. An unknown ratio changes nothing.
    """
    banded = F.lit(None).cast("double")
    for above, band_weight in sorted(bands):
        banded = F.when(ltv > above, F.lit(band_weight)).otherwise(banded)
    return F.when(asset_class == "RETAIL_MORTGAGE", F.greatest(weight, banded)).otherwise(weight)


def eligible_only(collateral: DataFrame, value: str, flag: str = "legal_enforceability_flag") -> DataFrame:
    """Collateral that cannot be enforced gets the value 0; an unknown flag counts as not."""
    enforceable = F.coalesce(F.col(flag), F.lit(False))
    return collateral.withColumn(
        value, F.when(enforceable, F.col(value)).otherwise(F.lit(0).cast("double"))
    )


def allocate_collateral(
    loans: DataFrame,
    key: str = "collateral_id",
    ead: str = "exposure_at_default",
    value: str = "adjusted_collateral_value_usd",
    out: str = "allocated_collateral_usd",
    exposures: DataFrame | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Share a collateral between its loans in proportion to their exposure.

    The totals per collateral are a combined aggregate joined back, not a window:
    one collateral behind a third of all loans would be one window partition, but
    is a single row here. Loans without collateral keep NULL.

    ``exposures`` (key and exposure of every loan) and ``profile`` (key of every
    loan, to find hot ones) may be narrower frames than ``loans``, which is their
    default: give stored or join-free ones where ``loans`` is long to compute.
    """
    exposures = loans if exposures is None else exposures
    pledged = exposures.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(ead).alias("_pledged_ead")
    )
    hot = spread_keys(loans if profile is None else profile, key)
    joined = skew_join(loans, pledged, key, "loan_id", hot=hot)
    part = F.try_divide(F.col(ead), F.col("_pledged_ead"))
    return joined.withColumn(out, F.col(value) * part).drop("_pledged_ead")
