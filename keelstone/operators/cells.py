"""Counting keys in two passes, so that only rows that can matter are shuffled.

Keys are hashed into a bounded array of cells. A cell's count is that of all its keys
together, so it only overestimates: a key in a cell that stays below the threshold is
below it too, and its rows can be left out without losing any. The rows that remain are
counted exactly. Every task sends at most one row per cell for the first pass, and for
the second only the rows of candidate cells, combined by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of one array. Fewer than this many longs are ever broadcast.
WIDTH = 1 << 20
#: Arrays with hashes of their own. A key is left out where any of them says so.
DEPTH = 2


def _cell(keys: Sequence[str], row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), *keys), F.lit(width).cast("long"))


def large_cells(
    df: DataFrame, keys: Sequence[str], threshold: int, depth: int = DEPTH, width: int = WIDTH
) -> DataFrame:
    """``array`` and ``cell`` of the cells with more than ``threshold`` rows: a count-min sketch.

    At most ``depth * width`` rows, and in each array fewer than rows / threshold.
    """
    cells = F.array(*[_cell(keys, row, width) for row in range(depth)])
    return (
        df.select(F.posexplode(cells).alias("array", "cell"))
        .groupBy("array", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > threshold)
        .select("array", "cell")
    )


def candidates(
    df: DataFrame, keys: Sequence[str], threshold: int, depth: int = DEPTH, width: int = WIDTH
) -> DataFrame:
    """The rows whose keys may have more than ``threshold`` rows: all that do, and few others."""
    cells = large_cells(df, keys, threshold, depth, width)
    for row in range(depth):
        own = cells.where(F.col("array") == row).select(F.col("cell").alias("_cell"))
        # fewer than ``width`` rows of one number, whatever the table
        df = df.withColumn("_cell", _cell(keys, row, width)).join(F.broadcast(own), "_cell", "left_semi")
        df = df.drop("_cell")
    return df


def keys_above(
    df: DataFrame, key: str, threshold: int = 100, depth: int = DEPTH, width: int = WIDTH
) -> DataFrame:
    """All non-NULL keys with more than ``threshold`` rows and their exact ``key_rows``."""
    rows = candidates(df.select(key).where(F.col(key).isNotNull()), [key], threshold, depth, width)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))
    return counts.where(F.col("key_rows") > threshold)


def duplicates(df: DataFrame, keys: Sequence[str], width: int = WIDTH) -> DataFrame:
    """Keys that occur more than once, with their exact ``row_count``; NULL is a value.

    Pays where repeats are few and distinct keys are not many times ``width``; otherwise
    most cells hold two and every row is a candidate.
    """
    rows = candidates(df.select(*keys), keys, 1, 1, width)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
