"""Readers. Every reader takes an explicit schema and filters on partition columns."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelstone import schemas

#: Folder of the rows without a partition value.
MISSING = "__HIVE_DEFAULT_PARTITION__"
PARTITIONS_PER_CALL = 500


def read_snapshot(
    spark: SparkSession,
    root: str,
    as_of: dt.date,
    schema: T.StructType | None = None,
    partition: str = "date",
) -> DataFrame:
    """One day of a snapshot table stored as ``root/<partition>=YYYY-MM-DD/``.

    The table is opened at its root and the day is a partition filter, so only
    that day's files are listed and read.
    """
    reader = spark.read
    if schema is not None:
        if partition not in schema.fieldNames():
            schema = T.StructType(schema.fields).add(partition, T.DateType())
        reader = reader.schema(schema)
    return reader.parquet(root).where(F.col(partition) == F.lit(as_of))


def read_ratings_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.RATINGS,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Headered CSV of agency ratings.

    Fields that do not parse become NULL; with ``corrupt_column`` the raw line
    is kept beside them so that it can be quarantined.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = T.StructType(schema.fields).add(corrupt_column, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def read_fx_json(
    spark: SparkSession, path: str, multiline: bool = True, schema: T.StructType = schemas.FX
) -> DataFrame:
    """FX rates from JSON: an array document per file, or one object or array per line."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_fact(
    spark: SparkSession,
    path: str,
    as_of: dt.date | None = None,
    partition: str = "calculation_date",
    schema: T.StructType | None = None,
) -> DataFrame:
    """A stored result table, whole or for one calculation date (partition pruned)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    return table if as_of is None else table.where(F.col(partition) == F.lit(as_of))


def trailing_days(
    table: DataFrame, as_of: dt.date, days: int = 7, partition: str = "calculation_date"
) -> DataFrame:
    """The ``days`` calendar days before ``as_of``; ``as_of`` itself is not history."""
    first = as_of - dt.timedelta(days=days)
    last = as_of - dt.timedelta(days=1)
    return table.where(F.col(partition).between(F.lit(first), F.lit(last)))


def new_partitions(spark: SparkSession, name: str, path: str, column: str) -> list[str]:
    """Values of ``column`` that have a folder below ``path`` but are no partitions yet.

    One listing of the table's folder; what lies in the folders is not looked at.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    names = {x.getPath().getName() for x in found if x.isDirectory()}
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    return sorted(x.partition("=")[2] for x in names - known if x.startswith(f"{column}="))


def register_external(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partition: tuple[str, str] = ("snapshot_date", "date"),
) -> DataFrame:
    """Register a date-partitioned Parquet folder as a table, or its new days if it is one.

    Only folders that came since the last call are registered, by name; the others are
    not listed again. Rows without a date lie in the folder of missing values, for which
    Spark has no name: it is found by a repair of the table, once.
    """
    column, kind = partition
    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != column
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}, `{column}` {kind}) "
        f"USING parquet PARTITIONED BY (`{column}`) LOCATION '{path}'"
    )
    new = [unquote(x) for x in new_partitions(spark, name, path, column)]
    if MISSING in new:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        return spark.table(name)
    for at in range(0, len(new), PARTITIONS_PER_CALL):
        parts = " ".join(f"PARTITION (`{column}` = '{x}')" for x in new[at : at + PARTITIONS_PER_CALL])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    return spark.table(name)


def source_totals(
    loans: DataFrame, date_column: str | None = None, balance: str = "outstanding_balance"
) -> DataFrame:
    """Control totals of a raw snapshot: total balance and number of loans."""
    keys = [date_column] if date_column else []
    return loans.groupBy(*keys).agg(
        F.sum(F.col(balance).cast("double")).alias("source_exposure"),
        F.count(F.lit(1)).alias("source_loan_count"),
    )
