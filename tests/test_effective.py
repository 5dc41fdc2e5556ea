"""Effective-dated lookups by union, checks of validity ranges, and external tables."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keelstone.operators import effective, joins
from keelstone.sources import readers

DAY = dt.date(2020, 1, 1)
FACT = "loan_id long, asset_class string, rating_bucket string, calculation_date date"
REF = "asset_class string, rating_bucket string, effective_date date, end_date date, risk_weight double"
KEYS = ["asset_class", "rating_bucket"]


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def versions(key, bounds):
    """Ranges between the bounds of one key; the last is open."""
    ends = [*bounds[1:], None]
    return [(*key, day(a), day(b), float(k)) for k, (a, b) in enumerate(zip(bounds, ends, strict=True))]


def facts(spark, n=3000, seed=2):
    rng = random.Random(seed)
    rows = [
        (k, rng.choice(["P", "P", "P", "Q", "R", None]), rng.choice(["A", "B", None]), day(rng.choice([None, *range(-3, 1200)])))
        for k in range(n)
    ]
    return spark.createDataFrame(rows, FACT)


def test_equal_to_the_range_join_on_a_thousand_versions(spark, rows):
    ref = versions(("P", "A"), range(0, 1000)) + versions(("P", "B"), [0, 5, 400]) + versions(("Q", "A"), [50])
    ref += [("Q", "B", day(3), day(9), 7.0), ("Q", "B", day(20), day(30), 8.0), (None, "A", day(0), None, 9.0)]
    ref = spark.createDataFrame(ref, REF)
    fact = facts(spark)
    got = effective.as_of_union(fact, ref, KEYS)
    assert rows(got) == rows(joins.as_of_lookup(fact, ref, KEYS))
    assert effective.validity_problems(ref, KEYS).select("problem").collect() == [("gap",)]


def test_overlaps_are_reported_and_do_not_double_rows(spark):
    ref = [
        ("P", "A", day(0), day(10), 1.0), ("P", "A", day(5), day(8), 2.0), ("P", "B", day(0), None, 3.0),
        ("P", "B", day(4), None, 4.0), ("Q", "A", day(7), day(7), 5.0), ("Q", "B", None, day(7), 6.0),
        ("R", "A", day(0), day(3), 7.0), ("R", "A", day(0), None, 8.0), ("R", "B", day(0), day(3), 1.0),
    ]
    ref = spark.createDataFrame(ref, REF)
    found = effective.validity_problems(ref, KEYS).select(*KEYS, "problem").collect()
    assert sorted(map(tuple, found)) == [
        ("P", "A", "overlap"), ("P", "B", "overlap"), ("Q", "A", "empty"), ("Q", "B", "no begin"), ("R", "A", "overlap"),
    ]
    asked = [(k, c, b, day(d)) for k, (c, b, d) in enumerate([("P", "A", 6), ("P", "A", 9), ("P", "B", 5), ("R", "A", 1), ("Q", "A", 7)])]
    out = effective.as_of_union(spark.createDataFrame(asked * 3, FACT), ref, KEYS).collect()
    assert len(out) == 15
    # the version that began last holds, also where it has ended before an earlier one
    assert {(r["loan_id"], r["effective_risk_weight"]) for r in out} == {(0, 2.0), (1, None), (2, 4.0), (3, 8.0), (4, None)}


def test_empty_sides(spark):
    fact, ref = facts(spark, 5), spark.createDataFrame(versions(("P", "A"), [0]), REF)
    assert effective.as_of_union(fact.limit(0), ref, KEYS).count() == 0
    out = effective.as_of_union(fact, ref.limit(0), KEYS)
    assert out.count() == 5 and out.where("effective_risk_weight IS NOT NULL").count() == 0
    assert effective.validity_problems(ref.limit(0), KEYS).count() == 0


def test_only_new_days_are_registered(spark, folder, monkeypatch):
    table = f"external_{uuid.uuid4().hex}"
    frame = spark.range(12).withColumn("snapshot_date", F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")))
    frame.write.partitionBy("snapshot_date").parquet(f"{folder}/t")
    statements, run = [], SparkSession.sql
    monkeypatch.setattr(SparkSession, "sql", lambda self, text, *a, **k: statements.append(text) or run(self, text, *a, **k))
    assert readers.register_external(spark, table, f"{folder}/t", frame.schema).count() == 12
    new = spark.range(5).withColumn("snapshot_date", F.lit(day(9)))
    new.write.mode("append").partitionBy("snapshot_date").parquet(f"{folder}/t")
    statements.clear()
    assert readers.register_external(spark, table, f"{folder}/t", frame.schema).count() == 17
    changes = [s for s in statements if not s.startswith(("CREATE", "SHOW"))]
    assert changes == [f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (`snapshot_date` = '{day(9)}')"]
    statements.clear()
    assert readers.register_external(spark, table, f"{folder}/t", frame.schema).count() == 17
    assert not [s for s in statements if s.startswith(("ALTER", "MSCK"))]
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("per_call", [1, 2, 100])
def test_rows_without_a_date(spark, folder, monkeypatch, per_call):
    monkeypatch.setattr(readers, "PARTITIONS_PER_CALL", per_call)
    table = f"external_{uuid.uuid4().hex}"
    frame = spark.range(9).withColumn("snapshot_date", F.when(F.col("id") > 2, F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int"))))
    frame.where("snapshot_date IS NOT NULL").write.partitionBy("snapshot_date").parquet(f"{folder}/t")
    assert readers.register_external(spark, table, f"{folder}/t", frame.schema).count() == 6
    frame.where("snapshot_date IS NULL").write.mode("append").partitionBy("snapshot_date").parquet(f"{folder}/t")
    for _ in range(2):
        assert readers.register_external(spark, table, f"{folder}/t", frame.schema).count() == 9
    spark.sql(f"DROP TABLE {table}")
