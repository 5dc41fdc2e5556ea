"""Dashboard measures as partial states that merge: sums, counts and exact distinct counts.

A distinct count cannot be added up over classes or days, a bitmap can be merged. Keys
get dense numbers from a table that only grows; the numbers of a class and date set bits
in maps of 32,768, and the count of a merged map is the exact distinct count of what was
merged. Nothing expands the fact: sums, loans and customers are three narrow
aggregations over a stored table, each reading the columns it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelstone.operators.aggregates import with_ratios

SLICE = ["calculation_date", "asset_class"]
KEYS = ("loan_id", "customer_id")
#: New keys are numbered within so many hash buckets, each sorted by itself.
BUCKETS = 4096

_SUMS = {
    "exposure": "outstanding_balance_usd",
    "rwa": "risk_weighted_assets",
    "capital": "regulatory_capital",
    "weights": "risk_weight",
    "scores": "data_quality_score",
}
#: What a fact needs to have for its states.
COLUMNS = [*SLICE, *KEYS, *_SUMS.values(), "high_risk_flag"]


def number_keys(
    rows: DataFrame, key: str, known: DataFrame | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """``key`` and a ``number`` from 1 for every key of ``rows`` that ``known`` does not have.

    Numbers have no gaps and go on after those of ``known``. They depend on the keys
    alone, so a recomputed task gives the same ones. NULL keys get none. No window
    spans the table: keys are counted per bucket and numbered within it.
    """
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
    if known is not None:
        keys = keys.join(known.select(key), key, "left_anti")
    placed = keys.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")
    )
    last = F.lit(0).cast("long")
    if known is not None:
        last = F.coalesce(known.agg(F.max("number")).scalar(), last)
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    # a row for each bucket, so always small enough to broadcast
    return placed.join(F.broadcast(starts), "_bucket").select(
        key, (last + F.col("_start") + within).alias("number")
    )


def bitmaps(rows: DataFrame, by: Sequence[str], key: str, numbers: DataFrame) -> DataFrame:
    """``by``, ``bucket`` and ``bits``: which numbers of ``key`` each group holds.

    Each key of a group is sent once, and a map takes at most 32,768 of them, so no
    key and no group makes a large task. Positions travel as numbers, not as maps: a
    task that meets a few keys of every map would otherwise send each as 4 kB.
    """
    held = rows.select(*by, key).where(F.col(key).isNotNull()).distinct().join(numbers, key)
    placed = held.select(
        *by,
        F.bitmap_bucket_number("number").alias("bucket"),
        F.bitmap_bit_position("number").alias("_bit"),
    )
    return placed.repartition(*by, "bucket").groupBy(*by, "bucket").agg(
        F.bitmap_construct_agg("_bit").alias("bits")
    )


def merged(maps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Maps of several groups as maps of the coarser groups ``by``."""
    return maps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def kpi_states(fact: DataFrame, numbers: dict[str, DataFrame], by: Sequence[str] = SLICE) -> DataFrame:
    """Rows of kind ``sums`` (one per group) and of the kind of each key (one per map).

    Give it a stored fact: it is read three times, a few columns each.
    """
    value = {name: F.col(column).cast("double") for name, column in _SUMS.items()}
    sums = fact.groupBy(*by).agg(
        *[F.sum(v).alias(name) for name, v in value.items()],
        F.count("risk_weight").alias("weighted"),
        F.count("data_quality_score").alias("scored"),
        F.count_if("high_risk_flag").alias("high_risk"),
    )
    out = sums.withColumn("kind", F.lit("sums"))
    for key in KEYS:
        maps = bitmaps(fact, by, key, numbers[key]).withColumn("kind", F.lit(key))
        out = out.unionByName(maps, allowMissingColumns=True)
    return out


def kpis_of_states(states: DataFrame, by: Sequence[str] = ("calculation_date",)) -> DataFrame:
    """The dashboard measures of merged states; the same row as ``daily_kpis`` of their fact.

    With no ``by``, one row over all dates: a customer of two days counts once.
    """

    if not by:
        whole = states.withColumn("_all", F.lit(True))
        return kpis_of_states(whole, ("_all",)).drop("_all")

    def mean(total: str, n: str, name: str):
        return F.try_divide(F.sum(total), F.sum(n)).alias(name)

    sums = states.where("kind = 'sums'").groupBy(*by).agg(
        F.sum("exposure").alias("total_exposure"),
        F.sum("rwa").alias("total_rwa"),
        F.sum("capital").alias("total_capital"),
        mean("weights", "weighted", "avg_risk_weight"),
        F.sum("high_risk").alias("high_risk_loans"),
        mean("scores", "scored", "avg_data_quality"),
    )
    maps = merged(states.where("kind <> 'sums'"), [*by, "kind"])

    def distinct(kind: str, name: str):
        held = F.when(F.col("kind") == kind, F.bitmap_count("bits"))
        return F.coalesce(F.sum(held), F.lit(0)).alias(name)

    counts = maps.groupBy(*by).agg(
        distinct("loan_id", "total_loans"), distinct("customer_id", "unique_customers")
    )
    names = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("total_loans", "unique_customers")}
    joined = sums.join(counts, list(by), "left")
    measures = joined.select(*by, *names.values(), *[c for c in sums.columns if c not in by])
    return with_ratios(measures, "total_capital")
