"""Reconciliation of calculated results with the source and with earlier days."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone.functions.numeric import percent_change
from keelstone.operators import aggregates, trend

PASSED, FAILED, WARNING, SKIPPED = "PASSED", "FAILED", "WARNING", "SKIPPED"
CLASS_KEYS = ["calculation_date", "asset_class"]


def variance_pct(calculated: Column, source: Column) -> Column:
    """Absolute deviation from the source in percent; NULL unless the source is above 0."""
    return F.when(source > 0, F.try_divide(F.abs(calculated - source), source) * F.lit(100.0))


def reconcile_totals(fact: DataFrame, source: DataFrame, tolerance_pct: float = 0.01) -> DataFrame:
    """Exposure within tolerance and exactly equal loan count, per calculation date."""
    return reconcile_totals_of(aggregates.customer_day_totals(fact), source, tolerance_pct)


def reconcile_totals_of(
    totals: DataFrame, source: DataFrame, tolerance_pct: float = 0.01
) -> DataFrame:
    """The same from customer totals.

    ``source`` has one row per ``calculation_date`` with ``source_exposure`` and
    ``source_loan_count``. Two frames with a row per date are joined; a date on
    one side only counts as 0 on the other.
    """
    calculated = aggregates.recon_totals_of(totals)
    zero, none = F.lit(0.0), F.lit(0).cast("long")
    both = calculated.join(source, "calculation_date", "full_outer").select(
        "calculation_date",
        F.coalesce("total_exposure", zero).alias("calculated_exposure"),
        F.coalesce("source_exposure", zero).alias("source_exposure"),
        F.coalesce("loan_count", none).alias("calculated_loan_count"),
        F.coalesce("source_loan_count", none).alias("source_loan_count"),
    )
    off = variance_pct(F.col("calculated_exposure"), F.col("source_exposure"))
    failed = F.coalesce(F.col("exposure_variance_pct") > tolerance_pct, F.lit(False)) | (
        F.col("calculated_loan_count") != F.col("source_loan_count")
    )
    return both.withColumn("exposure_variance_pct", off).withColumn(
        "status", F.when(failed, FAILED).otherwise(PASSED)
    )


def day_over_day(
    fact: DataFrame, as_of: dt.date | None = None, threshold_pct: float = 10.0
) -> DataFrame:
    """Change of the totals against the calendar day before.

    For one date, or for every date of the frame. SKIPPED without usable totals of
    the day before, WARNING when the risk-weighted assets moved by more than the
    threshold, else PASSED.
    """
    if as_of is not None:  # before the aggregation, where it prunes partitions
        fact = fact.where(F.col("calculation_date").isin(as_of, as_of - dt.timedelta(days=1)))
    zero = F.lit(0.0)
    totals = fact.groupBy("calculation_date").agg(
        F.coalesce(F.sum("outstanding_balance_usd").cast("double"), zero).alias("total_exposure"),
        F.coalesce(F.sum("risk_weighted_assets").cast("double"), zero).alias("total_rwa"),
    )
    return _compared_days(totals, as_of, threshold_pct)


def day_over_day_of(
    totals: DataFrame, as_of: dt.date | None = None, threshold_pct: float = 10.0
) -> DataFrame:
    """The same from customer totals."""
    if as_of is not None:
        days = (as_of, as_of - dt.timedelta(days=1))
        totals = totals.where(F.col("calculation_date").isin(*days))
    return _compared_days(aggregates.recon_totals_of(totals), as_of, threshold_pct)


def _compared_days(totals: DataFrame, as_of: dt.date | None, threshold_pct: float) -> DataFrame:
    pairs = trend.day_pairs(totals, {"total_rwa": "rwa", "total_exposure": "exposure"})
    if as_of is not None:
        pairs = pairs.where(F.col("calculation_date") == F.lit(as_of))
    change = percent_change(F.col("current_rwa"), F.col("previous_rwa"))
    exposure = percent_change(F.col("current_exposure"), F.col("previous_exposure"))
    status = (
        F.when(F.col("rwa_change_pct").isNull(), SKIPPED)
        .when(F.abs("rwa_change_pct") > threshold_pct, WARNING)
        .otherwise(PASSED)
    )
    return pairs.select(
        "calculation_date",
        "previous_date",
        "current_rwa",
        "previous_rwa",
        change.alias("rwa_change_pct"),
        exposure.alias("exposure_change_pct"),
    ).withColumn("status", status)


def reconcile_asset_class(
    fact: DataFrame, source: DataFrame, tolerance_pct: float = 0.1
) -> DataFrame:
    """Exposure per asset class against the source's ``source_exposure``."""
    return _compared_classes(aggregates.by_asset_class(fact, CLASS_KEYS), source, tolerance_pct)


def reconcile_asset_class_of(
    totals: DataFrame, source: DataFrame, tolerance_pct: float = 0.1
) -> DataFrame:
    """The same from customer-class totals."""
    return _compared_classes(aggregates.by_asset_class_of(totals, CLASS_KEYS), source, tolerance_pct)


def _compared_classes(calculated: DataFrame, source: DataFrame, tolerance_pct: float) -> DataFrame:
    """Both sides have one row per class and date. A class on one side only fails."""
    keys = CLASS_KEYS
    zero = F.lit(0.0)
    both = calculated.join(source.select(*keys, "source_exposure"), keys, "full_outer").select(
        *keys,
        F.coalesce(F.col("calculated_exposure").cast("double"), zero).alias("calculated_exposure"),
        F.coalesce(F.col("calculated_rwa").cast("double"), zero).alias("calculated_rwa"),
        F.coalesce("loan_count", F.lit(0).cast("long")).alias("loan_count"),
        F.coalesce("source_exposure", zero).alias("source_exposure"),
    )
    off = F.coalesce(
        variance_pct(F.col("calculated_exposure"), F.col("source_exposure")),
        F.when(F.col("calculated_exposure") == 0, F.lit(0.0)).otherwise(F.lit(100.0)),
    )
    status = F.when(F.col("variance_pct") > tolerance_pct, FAILED).otherwise(PASSED)
    return both.withColumn("variance_pct", off).withColumn("status", status)


def report(**checks: DataFrame) -> DataFrame:
    """Outcomes of several checks as one table: check, date, item, status."""
    parts = []
    for name, frame in checks.items():
        item = F.col("asset_class") if "asset_class" in frame.columns else F.lit("total")
        parts.append(
            frame.select(
                F.lit(name).alias("check_name"), "calculation_date", item.alias("item"), "status"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def summary(outcomes: DataFrame) -> DataFrame:
    """Number of outcomes by status per date, and the overall status.

    A date passes when nothing failed; warnings and skipped checks do not fail it.
    """
    status = F.col("status")
    return outcomes.groupBy("calculation_date").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(status == PASSED).alias("passed"),
        F.count_if(status == FAILED).alias("failed"),
        F.count_if(status == WARNING).alias("warnings"),
        F.count_if(status == SKIPPED).alias("skipped"),
        F.when(F.bool_and(status != FAILED), PASSED).otherwise(FAILED).alias("overall_status"),
    )
