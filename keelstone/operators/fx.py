"""Conversion into the reporting currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.functions.numeric import Numeric
from keelstone.params import DEFAULTS, Settings


def conversion_rates(fx: DataFrame, ccy: str = DEFAULTS.reporting_currency) -> DataFrame:
    """One factor into ``ccy`` per currency.

    A pair quoted in ``ccy`` gives its rate, a pair based on ``ccy`` its inverse.
    When a currency has several, a direct quote beats an inverse and a newer date
    beats an older one, so the join below can never multiply rows.
    """
    base = F.substring("currency_pair", 1, 3)
    quote = F.substring("currency_pair", 4, 3)
    rate = F.col("rate").cast("double")
    dated = F.col("date") if "date" in fx.columns else F.lit(None).cast("date")
    quoted = fx.select(
        F.when(quote == ccy, base).when(base == ccy, quote).alias("fx_currency"),
        F.when(quote == ccy, rate).otherwise(F.try_divide(F.lit(1.0), rate)).alias("fx_rate"),
        F.struct((quote == ccy).alias("direct"), dated.alias("dated"), rate.alias("rate")).alias(
            "rank"
        ),
    ).where(F.col("fx_currency").isNotNull() & (F.col("fx_currency") != ccy))
    return quoted.groupBy("fx_currency").agg(F.max_by("fx_rate", "rank").alias("fx_rate"))


def with_rate(
    df: DataFrame, fx: DataFrame, currency: str = "currency", settings: Settings = DEFAULTS
) -> DataFrame:
    """Add ``fx_rate``: 1 for the reporting currency, NULL where there is no rate.

    The rate side carries no broadcast hint: it is one row per currency, which
    Spark sees from its statistics and broadcasts below its own size threshold.
    """
    rates = conversion_rates(fx, settings.reporting_currency)
    joined = df.join(rates, F.col(currency) == F.col("fx_currency"), "left").drop("fx_currency")
    own = F.when(F.col(currency) == settings.reporting_currency, F.lit(1.0))
    return joined.withColumn("fx_rate", F.coalesce("fx_rate", own))


def without_rate(
    df: DataFrame, fx: DataFrame, currency: str = "currency", settings: Settings = DEFAULTS
) -> DataFrame:
    """Rows that cannot be converted, with the reason: what ``quarantine`` sets aside."""
    missing = with_rate(df, fx, currency, settings).where("fx_rate IS NULL").drop("fx_rate")
    return missing.withColumn("reject_reasons", F.array(F.lit(f"no_rate_{currency}")))


def to_reporting_ccy(
    df: DataFrame,
    fx: DataFrame,
    amount: str,
    out: str,
    currency: str = "currency",
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Add ``out`` = ``amount`` in the reporting currency.

    By ``settings.missing_fx`` a currency without a rate counts as 1 (``one``), gives
    NULL (``null``), or leaves the row out (``quarantine``; see ``without_rate``).
    """
    if settings.missing_fx not in ("one", "null", "quarantine"):
        raise ValueError(
            f"missing_fx must be 'one', 'null' or 'quarantine', got {settings.missing_fx!r}"
        )
    num = Numeric(settings.exact)
    joined = with_rate(df, fx, currency, settings)
    if settings.missing_fx == "quarantine":
        joined = joined.where("fx_rate IS NOT NULL")
    rate = F.col("fx_rate")
    if settings.missing_fx == "one":
        rate = F.coalesce(rate, F.lit(1.0))
    value = num.money(num.money(F.col(amount)) * num.rate(rate))
    return joined.withColumn(out, value).drop("fx_rate")
