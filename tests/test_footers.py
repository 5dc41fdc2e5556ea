"""Schemas of single files."""

from __future__ import annotations

import pathlib

from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.sources import footers


def drift(spark, path, expected=None):
    rows = footers.schema_drift(footers.file_schemas(spark, path), expected).collect()
    return sorted((r.file.rpartition("/")[2], r.item or "", r.problem, r.expected, r.actual) for r in rows)


def test_one_file_of_another_type_is_named(spark, folder):
    path = folder + "/date=2025-01-01"
    days = spark.range(30).select(
        "id", F.lit("x").alias("s"), F.col("id").cast("decimal(18,2)").alias("amount"),
        F.current_timestamp().alias("at"), F.current_date().alias("day"), F.array("id").alias("list"),
    )
    days.repartition(4, "id").write.parquet(path)
    assert drift(spark, path) == []
    before = set(pathlib.Path(path).glob("*.parquet"))
    days.withColumn("amount", F.col("amount").cast("double")).drop("s").withColumn("more", F.lit(1)).coalesce(1).write.mode("append").parquet(path)
    (odd,) = set(pathlib.Path(path).glob("*.parquet")) - before
    assert drift(spark, path) == [
        (odd.name, "amount", "type", "decimal(18,2)", "double"),
        (odd.name, "more", "extra", None, "int"),
        (odd.name, "s", "missing", "string", None),
    ]
    pathlib.Path(path, "broken.parquet").write_text("no footer")
    pathlib.Path(path, "empty.parquet").write_bytes(b"")
    found = drift(spark, folder)  # from the root of the table as well
    assert [x for x in found if x[2] == "unreadable"] == [("broken.parquet", "", "unreadable", None, None)]
    assert len(found) == 4


def test_against_a_given_schema(spark, folder):
    spark.createDataFrame([], schemas.LOANS).coalesce(1).write.parquet(folder + "/a b%+")
    assert drift(spark, folder, schemas.LOANS) == []
    first = schemas.LOANS.fieldNames()[0]
    spark.createDataFrame([], schemas.LOANS).drop(first).coalesce(1).write.parquet(folder + "/b")
    ((_, item, problem, _, _),) = drift(spark, folder, schemas.LOANS)
    assert (item, problem) == (first, "missing")


def test_no_files(spark, folder):
    assert drift(spark, folder) == [] and drift(spark, folder, schemas.LOANS) == []
