"""Joins over co-located tables: the rows of the plain join, without an exchange."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from keelstone.operators import joins
from keelstone.sinks.bucketed import CoLocated


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sides(spark):
    rng = random.Random(6)
    keys = ["hot"] * 300 + [None] * 300 + [f"c{rng.randint(0, 80)}" for _ in range(300)]
    loans = spark.createDataFrame([(f"L{i}", k) for i, k in enumerate(keys)], "loan_id string, collateral_id string")
    side = [(f"c{k}", float(k)) for k in range(60)] + [("hot", 1.5), ("hot", 0.5), ("unused", 2.0), (None, 9.0)]
    return loans, spark.createDataFrame(side, "collateral_id string, value double")


@pytest.mark.parametrize("least", [100, 10**9, 1])
def test_rows_of_the_plain_join(spark, rows, least):
    loans, side = sides(spark)
    wanted = rows(loans.join(joins.one_per_key(side, "collateral_id"), "collateral_id", "left"))
    stored = CoLocated(spark, "collateral_id", 4)
    stored.store_rows(loans, joins.spread_keys(loans, "collateral_id", least=least))
    stored.store_side(side)
    assert rows(stored.joined()) == wanted
    stored.drop()


def test_nothing_is_exchanged(spark, no_broadcast, plan_text):
    loans, side = sides(spark)
    stored = CoLocated(spark, "collateral_id", 4)
    stored.store_rows(loans)
    stored.store_side(side)
    joined = stored.joined()
    names = [line.strip(" :+-*").split(" ")[0] for line in plan_text(joined).split("\n(1)")[0].splitlines()]
    # the one exchange combines the hot keys, which are then broadcast
    assert names.count("Exchange") <= 1 and names.count("SortMergeJoin") == 1
    scan = spark.table(stored.rows).join(spark.table(stored.side).hint("merge"), "collateral_id", "left")
    assert "Exchange" not in plan_text(scan) and "Bucketed: true" in plan_text(scan)
    # hot and missing keys are not in the buckets, where one task would read them all
    assert spark.table(stored.rows).where("collateral_id = 'hot' OR collateral_id IS NULL").count() == 0
    largest = scan.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 300
    stored.drop()


def test_empty_sides(spark, rows):
    loans, side = sides(spark)
    for a, b in ((loans.limit(0), side), (loans, side.limit(0))):
        stored = CoLocated(spark, "collateral_id", 2)
        stored.store_rows(a)
        stored.store_side(b)
        wanted = rows(a.join(joins.one_per_key(b, "collateral_id"), "collateral_id", "left"))
        assert rows(stored.joined()) == wanted
        stored.drop()
