"""Sinks. Parquet tables with whole-slice replacement and evenly sized files.

A plain ``repartition(columns)`` puts each partition value into one task, which a
class with a third of all rows does not survive. The writers therefore ask Spark
to *rebalance* by those columns: adaptive execution splits what is too big and
merges what is too small. With a fixed number of files a row hash is added.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keelstone import schemas


def optimise_partitions(df: DataFrame, columns: Sequence[str], n: int = 200) -> DataFrame:
    """``n`` hash partitions by the given columns."""
    return df.repartition(n, *columns)


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row (maps cannot be hashed and are left out)."""
    return F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind])


def spread(df: DataFrame, by: Sequence[str], n: int | None = None, ways: int = 16) -> DataFrame:
    """Rows laid out by ``by`` for writing, with large values cut into several tasks."""
    if n is None:
        return df.hint("rebalance", *by) if by else df.hint("rebalance")
    if not by:
        return df.repartition(n)
    piece = F.pmod(row_hash(df), F.lit(ways))
    return df.repartition(n, *[F.col(c) for c in by], piece)


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], n: int | None = None, mode: str = "overwrite"
) -> None:
    spread(df, by, n).write.mode(mode).partitionBy(*by).parquet(path)


def write_table(df: DataFrame, path: str, n: int | None = None) -> None:
    spread(df, [], n).write.mode("overwrite").parquet(path)


def only_date(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    """The frame, failing as it is computed on a row of another date."""
    wanted = F.lit(day)
    wrong = F.raise_error(
        F.concat(F.lit(f"{column} is not {day}: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
    )
    return df.withColumn(
        column, F.when(F.col(column) == wanted, wanted).otherwise(wrong.cast("date"))
    )


def _slice_files(spark: SparkSession, folder: str) -> list:
    """The file system and data files below the folder of a slice; none where it does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    if fs.exists(place):
        files = fs.listFiles(place, True)
        while files.hasNext():
            file = files.next().getPath()
            if not file.getName().startswith(("_", ".")):
                found.append(file)
    return [fs, found]


def _remove_left_over(fs, files: list) -> None:
    """Delete the files of an earlier run that the present one has not replaced."""
    for folder in {f.getParent() for f in files if fs.exists(f) and fs.delete(f, False)}:
        if not len(fs.listStatus(folder)):
            fs.delete(folder, True)


def replace_slice(
    df: DataFrame,
    path: str,
    column: str,
    day: dt.date,
    by: Sequence[str] = (),
    n: int | None = None,
    seen: Observation | None = None,
) -> None:
    """Replace one date of a table; the other dates stay as they are.

    ``seen`` observes the headline numbers in the stage that writes.

    The new rows are staged and swapped in when the job commits, so a run that fails
    anywhere leaves the old slice as it was. Classes that only the earlier run had are
    removed after that, so a rerun leaves none behind; where removal itself is cut
    short, the next run of the date completes it.
    """
    spark, folder = df.sparkSession, f"{path}/{column}={day.isoformat()}"
    checked = only_date(df, column, day).where(F.col(column).isNotNull())
    placed = spread(checked, by, n)
    fs, before = _slice_files(spark, folder)
    writer = (placed if seen is None else watched(placed, seen)).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(column, *by)
    writer.parquet(path)
    _remove_left_over(fs, before)
    if not by and not _slice_files(spark, folder)[1]:  # a date without rows still has a schema
        spark.createDataFrame([], checked.drop(column).schema).coalesce(1).write.mode("overwrite").parquet(folder)


def export_parquet(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    files: int | None = None,
    max_records: int | None = None,
) -> None:
    """Export chosen columns. ``files`` sets their number, ``max_records`` their size."""
    chosen = df.select(*columns) if columns else df
    writer = spread(chosen, [], files).write.mode("overwrite")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def to_warehouse_types(
    df: DataFrame, types: Sequence[tuple[str, str, int | None]] = tuple(schemas.WAREHOUSE_DETAIL)
) -> DataFrame:
    """Columns in warehouse order and type; long strings are cut, absent columns are NULL."""
    out = []
    for name, kind, length in types:
        value = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        if length is not None:
            value = F.left(value, F.lit(length))
        out.append(value.alias(name))
    return df.select(*out)


def compact(
    spark: SparkSession,
    path: str,
    day: dt.date,
    files: int | None = None,
    column: str = "calculation_date",
    by: Sequence[str] = (),
) -> None:
    """Rewrite one slice into fewer, larger files: evenly sized ones, or ``files``.

    The new files are staged and swapped in when the job commits, so the slice
    can be read while it is rewritten. Its rows, hence partitions, are the same.
    """
    slice_ = spark.read.parquet(path).where(F.col(column) == F.lit(day))
    spread(slice_, by if files is None else [], files).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        column, *by
    ).parquet(path)


def write_report(results: DataFrame, path: str, fmt: str = "json", date: str = "date") -> None:
    """Store a check or reconciliation report as JSON or CSV under its date.

    Reports of the same date are replaced, those of other dates stay.
    """
    if fmt not in ("json", "csv"):
        raise ValueError(f"report format must be json or csv, got {fmt!r}")
    writer = results.write.mode("overwrite").partitionBy(date)
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def watched(df: DataFrame, seen: Observation) -> DataFrame:
    """Count a run's headline numbers while the frame is written: no extra job.

    Call it on what is written, above every shuffle: a map stage that is run again after
    a lost executor would count its rows twice.
    """
    return df.observe(
        seen,
        F.sum("risk_weighted_assets").alias("TotalRWA"),
        F.count(F.lit(1)).alias("ProcessedLoans"),
        F.count_if(F.col("high_risk_flag")).alias("HighRiskLoans"),
    )
