"""Per-loan formulas as column functions.

Each takes the columns it needs and returns one column; nothing here touches a
DataFrame, so the whole chain ends up in one generated projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keelstone.functions.codes import recode
from keelstone.functions.numeric import Numeric
from keelstone.params import DEFAULTS, Settings

DOUBLES = Numeric()


def final_rating(external: Column, internal: Column, settings: Settings = DEFAULTS) -> Column:
    """External rating first, then the bank's own, then the default."""
    return F.coalesce(external, internal, F.lit(settings.default_rating))


def exposure_at_default(balance: Column, ccf: Column, num: Numeric = DOUBLES) -> Column:
    return num.money(balance * ccf)


def collateral_coverage(collateral: Column, ead: Column, num: Numeric = DOUBLES) -> Column:
    """Covered share of the exposure, at most 1; 0 without collateral.

    ``least`` ignores NULL, so an exposure of 0 with collateral is fully covered.
    """
    capped = F.least(F.try_divide(collateral, ead), num.constant(1.0))
    return num.ratio(F.when(collateral.isNull(), num.constant(0.0)).otherwise(capped))


def ead_after_mitigation(ead: Column, coverage: Column, num: Numeric = DOUBLES) -> Column:
    return num.money(ead * (F.lit(1) - coverage))


def floored_weight(
    asset_class: Column, weight: Column, settings: Settings = DEFAULTS, num: Numeric = DOUBLES
) -> Column:
    """Weight not below the floor of its class; classes without a floor keep it."""
    floor = recode(asset_class, {k: float(v) for k, v in settings.weight_floors.items()})
    return num.ratio(F.greatest(weight, num.ratio(floor)))


def risk_weighted_assets(ead: Column, weight: Column, num: Numeric = DOUBLES) -> Column:
    return num.money(ead * weight)


def regulatory_capital(
    rwa: Column, settings: Settings = DEFAULTS, num: Numeric = DOUBLES
) -> Column:
    return num.money(rwa * num.constant(settings.capital_requirement))


def probability_of_default(
    bucket: Column, settings: Settings = DEFAULTS, num: Numeric = DOUBLES
) -> Column:
    return num.ratio(recode(bucket, settings.default_probabilities))


def expected_loss(ead: Column, pd: Column, lgd: Column, num: Numeric = DOUBLES) -> Column:
    return num.money(ead * pd * lgd)


def high_risk(
    weight: Column, pd: Column, days_to_maturity: Column, settings: Settings = DEFAULTS
) -> Column:
    risky = (
        (weight > settings.high_risk_weight)
        | (pd > settings.high_risk_pd)
        | (days_to_maturity < settings.high_risk_days)
    )
    return F.coalesce(risky, F.lit(False))


def quality_score(external: Column, internal: Column) -> Column:
    """1.0 with an external rating, 0.8 with only an internal one, else 0.5."""
    return F.when(external.isNotNull(), 1.0).when(internal.isNotNull(), 0.8).otherwise(0.5)
