"""Zone maps: the range of chosen columns in every file, and reads that skip files by them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "_metadata.file_path"


def zone_map(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per file of a stored table: its rows and the least and greatest value of each column.

    Reads only those columns. NULLs are in no range; a column that is NULL throughout a
    file has NULL bounds.
    """
    bounds = [f(c).alias(f"{c}_{f.__name__}") for c in columns for f in (F.min, F.max)]
    return table.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), *bounds)


def write_zone_map(spark: SparkSession, path: str, columns: Sequence[str], zones: str) -> None:
    """Store the zone map of the table at ``path`` at ``zones``, a folder outside of it."""
    found = zone_map(spark.read.parquet(path), columns)
    found.coalesce(1).write.mode("overwrite").parquet(zones)


def meets(ranges: Mapping[str, tuple], low: str = "{}", high: str = "{}") -> Column:
    """Whether values between the columns ``low`` and ``high`` can lie in all ranges, ends included.

    An end of None is open. With one column for both it is the filter on the rows themselves.
    """
    tests = [F.lit(True)]
    for column, (least, greatest) in ranges.items():
        known = F.col(low.format(column)).isNotNull()
        if least is not None:
            known &= F.col(high.format(column)) >= F.lit(least)
        if greatest is not None:
            known &= F.col(low.format(column)) <= F.lit(greatest)
        tests.append(known)
    return reduce(lambda a, b: a & b, tests)


def read_ranges(spark: SparkSession, path: str, zones: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """Rows of the table at ``path`` with every column in its range; NULLs are in none.

    Files whose zones miss a range are named in a filter on the file, which Spark applies
    to its listing, so they are not opened. Files that came after the zone map are in no
    zone and are always read: an old map costs time, never rows. The names are as many as
    the files Spark lists for the table anyway. A range on a column without zones is only
    a filter on the rows.
    """
    table, known = spark.read.parquet(path), spark.read.parquet(zones)
    mapped = {c: r for c, r in ranges.items() if f"{c}_min" in known.columns}
    missed = known.where(~meets(mapped, "{}_min", "{}_max")).select("file")
    skipped = [row["file"] for row in missed.collect()]
    rows = table.where(meets(ranges))
    return rows.where(~F.col(FILE).isin(skipped)) if skipped else rows
