"""Values in force on a date, by a sorted union, and a check of validity ranges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stands for an open end; later than any date of a book.
OPEN = "9999-12-31"


def _ends(end: str) -> Column:
    return F.coalesce(F.col(end), F.to_date(F.lit(OPEN)))


def validity_problems(
    ref: DataFrame, keys: Sequence[str], eff: str = "effective_date", end: str = "end_date"
) -> DataFrame:
    """Ranges ``[eff, end)`` that are empty, or that overlap or leave a gap to the next of their key.

    One row per problem: the keys, the range, where the next begins, and ``problem``. An
    open end is NULL; an open range before another overlaps it.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(eff), _ends(end))
    following = ref.select(*keys, eff, end, F.lead(eff).over(order).alias("next_effective"))
    after = F.col("next_effective")
    problem = (
        F.when(F.col(eff).isNull(), "no begin")
        .when(F.col(end) <= F.col(eff), "empty")
        .when(after.isNotNull() & (F.col(end).isNull() | (after < F.col(end))), "overlap")
        .when(after > F.col(end), "gap")
    )
    return following.withColumn("problem", problem).where("problem IS NOT NULL")


def as_of_union(
    fact: DataFrame,
    ref: DataFrame,
    keys: Sequence[str],
    date: str = "calculation_date",
    eff: str = "effective_date",
    end: str = "end_date",
    values: Sequence[str] = ("risk_weight",),
) -> DataFrame:
    """The fact with the values in force on its date, exactly one row for each of its rows.

    Versions and the dates asked for are sorted together once per key, and each date
    takes the last version that began: a key with many versions costs their number, not
    their number times its rows. Only distinct keys and dates are sorted, so a key behind
    a third of the fact is a few rows here. Where ranges overlap, the version that began
    last holds (of those that began together the one that ends last);
    ``validity_problems`` reports them.
    """
    version = F.struct(
        _ends(end).alias("ends"), *[F.col(v).alias(f"effective_{v}") for v in values]
    )
    known = ref.where(F.col(eff).isNotNull()).select(*keys, F.col(eff).alias("_at"), version.alias("_version"))
    asked = fact.select(*keys, F.col(date).alias("_at")).distinct()
    asked = asked.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in [*keys, "_at"])))
    events = known.withColumn("_asks", F.lit(False)).unionByName(
        asked.withColumn("_asks", F.lit(True)), allowMissingColumns=True
    )
    order = Window.partitionBy(*keys).orderBy("_at", "_asks", "_version")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = events.withColumn("_last", F.last("_version", ignorenulls=True).over(order)).where("_asks")
    in_force = F.col("_at") < F.col("_last.ends")
    found = seen.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        "_at",
        *[F.when(in_force, F.col(f"_last.effective_{v}")).alias(f"effective_{v}") for v in values],
    )
    same = [F.col(k) == F.col(f"_k_{k}") for k in keys] + [F.col(date) == F.col("_at")]
    return fact.join(found, same, "left").drop(*[f"_k_{k}" for k in keys], "_at")
