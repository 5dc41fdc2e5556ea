"""Clustering on several columns for data skipping (Z-order)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelstone.functions.literals import literal_array
from keelstone.sinks.writers import row_hash


def ordinal(df: DataFrame, column: str) -> Column:
    """A value that sorts like the column: a number, or the whole text."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def text_bounds(df: DataFrame, column: str, bits: int) -> Column:
    """Up to ``2^bits`` bounds of a text column: the highest values of a range partitioning.

    The distinct values are ranged, not the rows, so a value that many rows have is one
    row of one task. Spark places the ranges by whole values, so texts that begin alike
    are told apart.
    """
    values = df.select(F.col(column).alias("value")).dropna().distinct()
    ranged = values.repartitionByRange(2**bits, "value")
    highest = ranged.groupBy(F.spark_partition_id().alias("place")).agg(F.max("value").alias("top"))
    return highest.agg(F.array_sort(F.collect_set("top"))).scalar()


def with_z_value(
    df: DataFrame, columns: Sequence[str], bits: int = 8, out: str = "_z"
) -> DataFrame:
    """Add the interleaved bits of the columns' quantile ranks.

    Numbers get up to ``2^bits`` quantile bounds from one aggregation, texts from a range
    partitioning of the one column; a value's rank is the number of bounds below it. Few
    distinct values give few bounds, so the rank is dense either way, and no column is
    ranked by a global window. NULL ranks lowest.
    """
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in columns if c not in texts]
    bounds = {c: text_bounds(df, c, bits) for c in texts}
    if numbers:
        marks = literal_array(i / 2**bits for i in range(1, 2**bits))
        quantiles = df.agg(
            F.struct(
                *[
                    F.array_distinct(F.percentile_approx(ordinal(df, c), marks, F.lit(10_000))).alias(c)
                    for c in numbers
                ]
            )
        ).scalar()
        bounds |= {c: quantiles.getField(c) for c in numbers}
    # ranks get a projection of their own, so that each is computed once per row
    def rank(column: str) -> Column:
        value = ordinal(df, column)
        below = F.filter(F.col(f"_bounds_{column}"), lambda bound: bound < value)
        return F.coalesce(F.size(below), F.lit(0)).cast("long")

    placed = df.withColumns({f"_bounds_{c}": b for c, b in bounds.items()})
    ranked = placed.withColumns({f"_rank_{c}": rank(c) for c in columns})
    one = F.lit(1).cast("long")
    pieces = [
        F.shiftleft(
            F.shiftright(F.col(f"_rank_{c}"), bit).bitwiseAND(one), bit * len(columns) + position
        )
        for position, c in enumerate(columns)
        for bit in range(bits)
    ]
    z = reduce(lambda a, b: a.bitwiseOR(b), pieces)
    return ranked.select(*df.columns, z.alias(out))


def cluster(df: DataFrame, columns: Sequence[str], files: int, bits: int = 8) -> DataFrame:
    """Rows in ``files`` ranges of the Z-order, sorted within each.

    Rows with equal values have the same Z-value; a row hash as second range key
    lets such a group, however large, be cut between files. Spark samples the
    frame to place the ranges, so give it a stored table, not a long computation.
    """
    tie = row_hash(df)
    placed = with_z_value(df, columns, bits).withColumn("_tie", tie)
    return (
        placed.repartitionByRange(files, "_z", "_tie")
        .sortWithinPartitions("_z", *columns)
        .drop("_z", "_tie")
    )
