"""Reduce agency ratings to one per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POLICIES = ("worst", "best", "second_best", "latest")


def latest_rating(
    df: DataFrame,
    keys: Sequence[str] = ("customer_id", "rating_agency"),
    order: str = "rating_date",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest row of every key.

    The maximum of a struct combines on the map side, so a customer with a very long history
    is reduced before the shuffle; a ranking window would sort it in one task.
    Rows of the same day are ordered by ``tie_break``, then by all other columns,
    so the winner does not depend on the order of arrival.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [order, *tie_break] + sorted(c for c in rest if c not in (order, *tie_break))
    newest = df.groupBy(*keys).agg(F.max(F.struct(*rank)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def rating_per_customer(df: DataFrame, policy: str = "worst", key: str = "customer_id") -> DataFrame:
    """One rating per customer from one rating per customer and agency.

    worst: highest ordinal. best: lowest ordinal. latest: newest date.
    second_best: the better of two counts as the worse of two, as usual for
    several eligible assessments; a single rating stands alone.
    Symbols without an ordinal only win when nothing else is known.
    """
    if policy not in POLICIES:
        raise ValueError(f"rating policy must be one of {POLICIES}, got {policy!r}")
    if policy == "second_best":
        # at most one row per agency and customer reaches this window
        per_customer = Window.partitionBy(key)
        place = F.row_number().over(
            per_customer.orderBy(
                F.col("rating_numeric").asc_nulls_last(),
                F.col("rating_date").desc(),
                F.col("rating_agency"),
            )
        )
        known = F.count("rating_numeric").over(per_customer)
        wanted = F.least(F.lit(2), F.greatest(known, F.lit(1)))
        return (
            df.withColumns({"_place": place, "_wanted": wanted})
            .where(F.col("_place") == F.col("_wanted"))
            .select(key, "rating", "rating_numeric", "rating_date", "rating_agency")
        )
    rank = {
        "worst": [],
        # negated, so that an unknown symbol (NULL) loses against any known one
        "best": [(-F.col("rating_numeric")).alias("negated")],
        "latest": [F.col("rating_date"), F.col("rating_numeric")],
    }[policy]
    columns = ["rating_numeric", "rating_date", "rating_agency", "rating"]
    first = [F.struct(*rank).alias("rank")] if rank else []
    best = df.groupBy(key).agg(F.max(F.struct(*first, *columns)).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in reversed(columns)])
