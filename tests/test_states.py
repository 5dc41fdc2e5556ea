"""Bitmap states of the dashboard measures, their refresh, and slices that survive a failure."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keelstone.operators import aggregates as agg, states
from keelstone.sinks import writers
from keelstone.sinks.states import KpiStates

A, B = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
SCHEMA = (
    "calculation_date date, asset_class string, loan_id string, customer_id long, "
    "outstanding_balance_usd double, risk_weighted_assets double, regulatory_capital double, "
    "risk_weight double, data_quality_score double, high_risk_flag boolean"
)


def facts(spark, days=(A, B), classes=("P", "Q", "R"), n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for day in days:
        for k in range(n):
            customer = None if k % 50 == 0 else rng.choice([7, rng.randint(0, 60), rng.randint(0, 10**12)])
            value = float(rng.randint(1, 10**6))
            rows.append(
                (day, classes[k % len(classes)], f"L{k if k % 3 else k * 7919}", customer, value, value / 2, value / 16,
                 rng.choice([0.5, 1.0, None]), 0.5, k % 9 == 0)
            )
    return spark.createDataFrame(rows, SCHEMA)


def numbers_of(fact):
    return {key: states.number_keys(fact, key, buckets=16) for key in states.KEYS}


def comparable(frame):
    columns = sorted(frame.columns)
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in frame.collect()
    )


def test_numbers_are_dense_and_go_on(spark):
    first = spark.range(1000).select((F.col("id") * 37).alias("k"))
    one = states.number_keys(first.unionByName(first.limit(5)), "k", buckets=8)
    got = {r["k"]: r["number"] for r in one.collect()}
    assert sorted(got.values()) == list(range(1, 1001))
    assert {r["k"]: r["number"] for r in states.number_keys(first.repartition(5), "k", buckets=8).collect()} == got
    known = spark.createDataFrame(list(got.items()), "k long, number long")
    more = first.unionByName(spark.createDataFrame([(-1,), (-2,), (None,), (-1,)], "k long"))
    assert sorted(r["number"] for r in states.number_keys(more, "k", known, buckets=8).collect()) == [1001, 1002]
    assert states.number_keys(first, "k", known).count() == 0


def test_states_give_the_plain_measures(spark):
    fact = facts(spark)
    made = states.kpi_states(fact, numbers_of(fact))
    wanted = agg.daily_kpis(fact)
    assert comparable(states.kpis_of_states(made).select(*wanted.columns)) == comparable(wanted)


def test_states_of_two_days_merge(spark):
    """Distinct counts over both days, though each day's state was made by itself."""
    fact = facts(spark)
    numbers = numbers_of(fact)
    one, two = (states.kpi_states(fact.where(F.col("calculation_date") == F.lit(day)), numbers) for day in (A, B))
    got = states.kpis_of_states(one.unionByName(two), by=()).first()
    wanted = fact.agg(F.countDistinct("loan_id").alias("l"), F.countDistinct("customer_id").alias("c")).first()
    assert (got["total_loans"], got["unique_customers"]) == (wanted["l"], wanted["c"])
    single = {r["unique_customers"] for r in states.kpis_of_states(one.unionByName(two)).collect()}
    assert got["unique_customers"] > max(single)  # and more than the larger day has


def test_no_row_of_the_fact_is_expanded(spark, plan_text, folder):
    facts(spark).write.parquet(f"{folder}/f")
    fact = spark.read.parquet(f"{folder}/f")
    plan = plan_text(states.kpis_of_states(states.kpi_states(fact, numbers_of(fact))))
    assert "Expand" not in plan and "bitmap_construct_agg" in plan
    assert "Expand" in plan_text(agg.daily_kpis(fact))


def test_refresh_reads_the_changed_class_only(spark, folder, plan_text, monkeypatch):
    path = f"{folder}/fact"
    writers.write_partitioned(facts(spark), path, states.SLICE)
    kpis = KpiStates(spark, path, f"{folder}/kpis")
    kpis.build()

    def stored():
        return comparable(spark.read.parquet(f"{folder}/kpis/kpis").withColumn("calculation_date", F.col("calculation_date").cast("date")))

    def recomputed():
        return comparable(agg.daily_kpis(spark.read.parquet(path)))

    assert stored() == recomputed()
    assert kpis.refresh(B) == []

    new = facts(spark, days=(B,), classes=("Q",), n=90, seed=5).withColumn("customer_id", F.col("customer_id") + 5)
    new.drop("calculation_date", "asset_class").write.mode("overwrite").parquet(f"{path}/calculation_date={B}/asset_class=Q")
    before = stored()
    assert kpis.changed(B) == [("Q", False)]
    rows = kpis.rows_of(B, ["Q"])
    assert rows.count() == 90
    files = {r[0].rsplit("/", 2)[1] for r in rows.select(F.input_file_name()).distinct().collect()}
    assert files == {"asset_class=Q"}
    plan = plan_text(rows)
    assert "asset_class" in plan.split("PartitionFilters")[1].split("\n")[0]
    monkeypatch.setattr(KpiStates, "rows_of", lambda self, day, classes: rows if classes == ["Q"] else None)
    other_day = sorted(os.listdir(f"{folder}/kpis/states/calculation_date={A}"))
    assert kpis.refresh(B) == ["Q"]
    assert sorted(os.listdir(f"{folder}/kpis/states/calculation_date={A}")) == other_day
    assert stored() == recomputed() != before
    assert kpis.refresh(B) == []


def test_refresh_when_a_class_vanishes_or_appears(spark, folder):
    path = f"{folder}/fact"
    writers.write_partitioned(facts(spark), path, states.SLICE)
    kpis = KpiStates(spark, path, f"{folder}/kpis")
    kpis.build()
    other = facts(spark, days=(B,), classes=("P", "S"), n=120, seed=8)
    writers.replace_slice(other, path, "calculation_date", B, ["asset_class"])
    assert kpis.refresh(B) == ["P", "Q", "R", "S"]
    got = spark.read.parquet(f"{folder}/kpis/kpis").withColumn("calculation_date", F.col("calculation_date").cast("date"))
    assert comparable(got) == comparable(agg.daily_kpis(spark.read.parquet(path)))


@pytest.mark.parametrize("by", [[], ["asset_class"]])
def test_a_slice_survives_a_failure_while_it_is_written(spark, folder, rows, monkeypatch, by):
    path = f"{folder}/t"
    good = facts(spark, n=30).select("calculation_date", "asset_class", "loan_id")
    for day in (A, B):
        writers.replace_slice(good.where(F.col("calculation_date") == F.lit(day)), path, "calculation_date", day, by)
    before = rows(spark.read.parquet(path).select(*good.columns))
    # without the exchange the failing expression is computed by the tasks that write
    monkeypatch.setattr(writers, "spread", lambda df, by, n=None: df)
    broken = good.where(F.col("calculation_date") == F.lit(B)).repartition(3, "loan_id").withColumn(
        "loan_id", F.when(F.col("loan_id") == "L7", F.raise_error(F.lit("lost"))).otherwise(F.col("loan_id"))
    )
    with pytest.raises(PySparkException, match="lost"):
        writers.replace_slice(broken, path, "calculation_date", B, by)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path).select(*good.columns)) == before


def test_a_date_without_rows(spark, folder):
    path = f"{folder}/t"
    good = facts(spark, days=(A,), n=30).select("calculation_date", "asset_class", "loan_id")
    for by in ([], ["asset_class"]):
        writers.replace_slice(good, path + str(len(by)), "calculation_date", A, by)
        writers.replace_slice(good.limit(0), path + str(len(by)), "calculation_date", A, by)
    assert spark.read.parquet(path + "0").count() == 0
    assert not os.path.exists(f"{path}1/calculation_date={A}/asset_class=P")
