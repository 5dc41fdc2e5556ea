"""Comparisons between calculation dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelstone.functions.numeric import percent_change
from keelstone.operators.aggregates import top_k

GROUP = ("asset_class", "geography", "rating_bucket")


def lag_change(summary: DataFrame, keys=GROUP, total: str = "total_rwa") -> DataFrame:
    """Add each group's previous available total and the change in percent.

    Works on summary rows (one per group and date), never on the fact.
    """
    history = Window.partitionBy(*keys).orderBy("calculation_date")
    before = F.lag(total, 1).over(history)
    return summary.withColumn("prev_total_rwa", before).withColumn(
        "rwa_change_pct", percent_change(F.col(total), F.col("prev_total_rwa"))
    )


def with_history(today: DataFrame, history: DataFrame | None) -> DataFrame:
    """Today's summary rows over earlier ones, whose missing columns become NULL."""
    return today if history is None else today.unionByName(history, allowMissingColumns=True)


def daily_trend(today: DataFrame, history: DataFrame | None, as_of: dt.date) -> DataFrame:
    """Today's summary with its change since each group's previous date.

    The date filter stays above the window, which needs the history rows.
    """
    changed = lag_change(with_history(today, history))
    return changed.where(F.col("calculation_date") == F.lit(as_of)).drop("prev_total_rwa")


def day_pairs(totals: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Each date's totals beside those of the calendar day before.

    ``totals`` has one row per date, so this joins two tiny frames. ``measures``
    maps a total to its name stem: current_<stem>, previous_<stem>.
    """
    now = totals.select(
        "calculation_date",
        F.date_sub("calculation_date", 1).alias("previous_date"),
        *[F.col(c).alias(f"current_{stem}") for c, stem in measures.items()],
    )
    before = totals.select(
        F.col("calculation_date").alias("previous_date"),
        *[F.col(c).alias(f"previous_{stem}") for c, stem in measures.items()],
    )
    return now.join(before, "previous_date", "left")


def customer_moves(
    fact: DataFrame, as_of: dt.date, previous: dt.date | None = None
) -> DataFrame:
    """Per customer: total of two days, change, and change in percent.

    A full outer join of the two days' totals, written as conditional sums: both
    days are partitions of one scan and the customers are shuffled once. Like the
    join, a customer absent on a day has no total there: its change counts from 0,
    its percentage is NULL.
    """
    previous = previous or as_of - dt.timedelta(days=1)
    day, rwa = F.col("calculation_date"), F.col("risk_weighted_assets")
    both = fact.where(day.isin(as_of, previous)).groupBy("customer_id").agg(
        F.sum(F.when(day == F.lit(as_of), rwa)).alias("now"),
        F.sum(F.when(day == F.lit(previous), rwa)).alias("before"),
    )
    now, before = F.coalesce("now", F.lit(0.0)), F.coalesce("before", F.lit(0.0))
    return both.select(
        "customer_id",
        now.alias("current_rwa"),
        before.alias("previous_rwa"),
        (now - before).alias("rwa_change"),
        F.when(F.col("before") > 0, percent_change(F.col("now"), F.col("before"))).alias(
            "change_pct"
        ),
    )


def top_movers(
    fact: DataFrame, as_of: dt.date, n: int = 20, previous: dt.date | None = None
) -> DataFrame:
    """The ``n`` customers whose total moved most in either direction."""
    return top_k(customer_moves(fact, as_of, previous), F.abs("rwa_change"), "customer_id", n)
