"""Catalog tables: star schema and optimizer statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.sources import reference

FACT = "rwa_calculations"
SUMMARY = "rwa_summary"

COMMENTS = {
    FACT: "Capital calculation per loan and date",
    SUMMARY: "Capital measures by class, geography and rating bucket",
    "dim_date": "Calendar",
    "dim_asset_class": "Asset classes and their exposure class",
    "dim_geography": "Countries, regions and country weight",
    "ref_risk_weights": "Risk weights by class and bucket with their validity",
}
COLUMN_COMMENTS = {
    (FACT, "ead_after_crm"): "Exposure left after collateral",
    (FACT, "risk_weight_floored"): "Risk weight not below the floor of its class",
}


def _columns(table: str, types: Sequence[tuple[str, str, int | None]], first: Sequence[str]) -> str:
    """Column list with the partition columns last, as Spark stores them."""
    ordered = [t for t in types if t[0] not in first] + [t for t in types if t[0] in first]
    out = []
    for name, kind, _ in ordered:
        note = COLUMN_COMMENTS.get((table, name))
        out.append(f"`{name}` {kind}" + (f" COMMENT '{note}'" if note else ""))
    return ", ".join(out)


def _create(spark, db: str, table: str, columns: str, location: str, by: Sequence[str] = ()) -> None:
    parts = f"PARTITIONED BY ({', '.join(by)}) " if by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {db}.{table} ({columns}) USING parquet {parts}"
        f"LOCATION '{location}/{table}' COMMENT '{COMMENTS[table]}'"
    )


def _frame_columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def create_star(spark: SparkSession, db: str, location: str) -> None:
    """Create the two facts, three dimensions and the weight table below ``location``.

    Fixed dimensions are filled; facts are partitioned by date (the detail also by
    asset class) and filled by ``load``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{location}'")
    detail_by = ["calculation_date", "asset_class"]
    _create(spark, db, FACT, _columns(FACT, schemas.WAREHOUSE_DETAIL, detail_by), location, detail_by)
    summary_by = ["calculation_date"]
    _create(
        spark, db, SUMMARY, _columns(SUMMARY, schemas.WAREHOUSE_SUMMARY, summary_by), location,
        summary_by,
    )
    calendar = reference.calendar_columns(
        spark.range(0).select(F.lit(None).cast("date").alias("date_key"))
    )
    _create(spark, db, "dim_date", _frame_columns(calendar), location)
    fixed = {
        "dim_asset_class": reference.dim_asset_class(spark),
        "dim_geography": reference.dim_geography(spark),
        "ref_risk_weights": reference.effective_risk_weights(spark),
    }
    for name, frame in fixed.items():
        _create(spark, db, name, _frame_columns(frame), location)
        frame.write.insertInto(f"{db}.{name}", overwrite=True)


def load(df: DataFrame, table: str, partition: dict[str, object] | None = None) -> None:
    """Insert a frame by column name, replacing the table or one partition of it.

    ``partition`` fixes leading partition columns, e.g. the date: exactly that
    slice is replaced, whatever classes it held before.
    """
    spark = df.sparkSession
    partition = partition or {}
    names = spark.table(table).columns
    chosen = ", ".join(f"`{c}`" for c in names if c not in partition)
    where = ""
    if partition:
        by = [f.name for f in spark.catalog.listColumns(table) if f.isPartition]
        spec = [
            f"`{c}` = '{partition[c]}'" if c in partition else f"`{c}`" for c in by
        ]
        where = f" PARTITION ({', '.join(spec)})"
    spark.sql(f"INSERT OVERWRITE TABLE {table}{where} SELECT {chosen} FROM {{rows}}", rows=df)


def analyze(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """Collect optimizer statistics and return them, one row per column and measure."""
    names = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {names}")
    parts = [
        spark.sql(f"DESCRIBE EXTENDED {table} `{c}`").select(
            F.lit(c).alias("column_name"), "info_name", "info_value"
        )
        for c in columns
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
