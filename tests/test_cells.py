"""Two-pass counts: equal to the full counts, with fewer rows in the shuffle."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from keelstone.operators import aggregates as agg, cells, joins


def skewed(spark, n=20_000):
    """A third of the rows on one key, some keys around the threshold, a long tail."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.pmod(F.xxhash64("id"), F.lit(60)))
    return spark.range(n, numPartitions=8).select(
        key.otherwise(1000 + F.col("id")).cast("long").alias("k"), F.col("id").alias("row")
    )


def shuffled_rows(frame):
    """Rows written by each shuffle of the frame's last run."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in text
    found, nodes = [], [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        for inner in ("executedPlan", "finalPhysicalPlan", "plan"):
            if re.match("AdaptiveSparkPlan|ResultQueryStage|ShuffleQueryStage|BroadcastQueryStage", name):
                try:
                    nodes.append(getattr(node, inner)())
                    break
                except Exception:
                    continue
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
    return found


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 20])
def test_hot_keys_equal_the_full_count(spark, rows, width):
    df = skewed(spark).unionByName(spark.createDataFrame([(None, 1)] * 500, "k long, row long"))
    for threshold in (0, 1, 100, 110, 5000, 10**6):
        wanted = rows(joins.keys_above(df, "k", threshold))
        assert rows(cells.keys_above(df, "k", threshold, width=width)) == wanted
    assert wanted == []


def test_random_keys(spark, rows):
    rng = random.Random(3)
    data = [(rng.choice("abcdefgh") * rng.randint(1, 3), rng.randint(0, 3) or None) for _ in range(400)]
    df = spark.createDataFrame(data, "a string, b int")
    for width in (1, 5, 1 << 16):
        assert rows(cells.duplicates(df, ["a", "b"], width)) == rows(agg.duplicates(df, ["a", "b"]))
        assert rows(cells.duplicates(df, ["b"], width)) == rows(agg.duplicates(df, ["b"]))
    assert cells.duplicates(df.limit(0), ["a", "b"]).count() == 0
    assert cells.keys_above(df.limit(0), "a", 3).count() == 0


def test_a_cell_that_two_keys_share_reports_neither(spark):
    """Keys that meet in a cell are candidates, but the exact count drops them."""
    df = spark.range(1000).select(F.col("id").alias("k"))
    crowded = cells.candidates(df, ["k"], 1, 1, 64)
    assert crowded.count() == 1000 and cells.duplicates(df, ["k"], 64).count() == 0


def test_fewer_rows_are_shuffled(spark):
    df = skewed(spark, 60_000)
    full = shuffled_rows(joins.keys_above(df, "k", 500))
    two = shuffled_rows(cells.keys_above(df, "k", 500, depth=1, width=256))
    assert max(full) > 15_000  # the tail of single keys
    assert sum(two) < 0.3 * sum(full)
    wide = df.select("row").unionByName(df.select("row").where("row < 5"))
    full = shuffled_rows(agg.duplicates(wide, ["row"]))
    second = cells.candidates(wide, ["row"], 1, 1, 1 << 20)
    assert max(full) >= 60_000 and second.count() < 10_000


def test_what_is_broadcast_is_bounded(spark):
    df = skewed(spark)
    assert cells.large_cells(df, ["k"], 0, 2, 64).count() <= 2 * 64
    assert cells.large_cells(df, ["k"], 1000, 2, 1 << 20).count() <= 2 * 20
