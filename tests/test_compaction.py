"""Zone maps and the merging of small files."""

from __future__ import annotations

import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from keelstone.sinks import compaction, layout, zones

A = dt.date(2025, 1, 1)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_size for p in pathlib.Path(path).rglob("*.parquet")}


def files_read(df):
    """Result rows and the number of files the scan opened."""
    df._jdf.queryExecution().executedPlan()
    rows = df.collect()
    todo, read = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.startswith("Scan parquet"):
            read += node.metrics().get("numFiles").get().value()
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return rows, read


@pytest.fixture
def clustered(spark, folder):
    n = F.xxhash64("id")
    frame = spark.range(8_000).select(
        "id", F.concat(F.lit("G "), F.pmod(n, F.lit(16)) + 10).alias("geography"),
        F.when(F.col("id") % 100 > 0, F.pmod(F.shiftright(n, 8), F.lit(1000))).alias("amount"),
    )
    layout.cluster(frame, ["geography", "amount"], files=16).write.parquet(folder + "/z")
    zones.write_zone_map(spark, folder + "/z", ["geography", "amount"], folder + "/zones")
    return folder


def test_a_filter_on_two_columns_opens_only_files_that_meet_it(spark, clustered):
    ranges = {"geography": ("G 12", "G 13"), "amount": (100, 180)}
    got, read = files_read(zones.read_ranges(spark, clustered + "/z", clustered + "/zones", ranges))
    everything = spark.read.parquet(clustered + "/z").collect()
    wanted = [r for r in everything if "G 12" <= r.geography <= "G 13" and r.amount is not None and 100 <= r.amount <= 180]
    assert sorted(r.id for r in got) == sorted(r.id for r in wanted) and wanted
    table = spark.read.parquet(clustered + "/zones").collect()
    meet = [z for z in table if z.geography_max >= "G 12" and z.geography_min <= "G 13" and z.amount_max >= 100 and z.amount_min <= 180]
    assert read == len(meet) <= 6 < len(table)


def test_open_ends_unknown_columns_and_new_files(spark, clustered):
    path, known = clustered + "/z", clustered + "/zones"
    whole = spark.read.parquet(path)
    assert zones.read_ranges(spark, path, known, {}).count() == 8_000
    assert zones.read_ranges(spark, path, known, {"amount": (None, None)}).count() == whole.where("amount IS NOT NULL").count()
    assert zones.read_ranges(spark, path, known, {"id": (None, 9), "geography": ("G", None)}).count() == 10
    assert zones.read_ranges(spark, path, known, {"geography": ("Z", None)}).count() == 0
    whole.limit(5).withColumn("geography", F.lit("Z 1")).write.mode("append").parquet(path)
    assert zones.read_ranges(spark, path, known, {"geography": ("Z", None)}).count() == 5


def test_zones_of_partitioned_tables(spark, folder):
    rows = spark.range(40).select("id", F.when(F.col("id") < 20, "a b%+").otherwise("ü=/").alias("c"))
    rows.repartition(2, "id").write.partitionBy("c").parquet(folder + "/t")
    zones.write_zone_map(spark, folder + "/t", ["id"], folder + "/zones")
    got, read = files_read(zones.read_ranges(spark, folder + "/t", folder + "/zones", {"id": (30, None)}))
    assert sorted(r.id for r in got) == list(range(30, 40)) and {r.c for r in got} == {"ü=/"} and read <= 2


def test_first_fit_decreasing():
    sizes = {"a/1": 40, "a/2": 30, "a/3": 30, "a/4": 20, "a/5": 50, "a/6": 100, "b/1": 10, "c/1": 0, "c/2": 0}
    assert compaction.bins(sizes, 100) == [["a/1", "a/2", "a/3"], ["c/1", "c/2"]]
    assert compaction.bins({}, 100) == [] and compaction.bins({"x": 1}, 100) == []
    many = {f"k/{i}": 1 + i % 49 for i in range(500)}
    found = compaction.bins(many, 100)
    assert all(sum(many[x] for x in names) <= 100 for names in found)
    assert len(found) <= 11 / 9 * sum(many.values()) / 100 + 1


@pytest.fixture
def scattered(spark, folder):
    """A slice with large and small files in classes with awkward names, and another date."""
    path = folder + "/t"
    rows = spark.range(30_000).select(
        F.lit(A).alias("calculation_date"), F.lit("a b%+").alias("asset_class"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    small = spark.range(60).select(
        F.lit(A).alias("calculation_date"),
        F.when(F.col("id") % 2 == 0, "a b%+").when(F.col("id") % 3 == 0, "ü=/").alias("asset_class"),
        F.col("id").cast("string").alias("x"),
    )
    by = ["calculation_date", "asset_class"]
    rows.coalesce(1).write.partitionBy(*by).parquet(path)
    large = set(files(path))
    for _ in range(2):
        small.repartition(3, "x").write.mode("append").partitionBy(*by).parquet(path)
    small.withColumn("calculation_date", F.lit(dt.date(2025, 1, 2))).write.mode("append").partitionBy(*by).parquet(path)
    return path, large


def test_only_small_files_are_rewritten(spark, scattered, rows):
    path, large = scattered
    before, contents = files(path), rows(spark.read.parquet(path))
    gone = compaction.compact_small(spark, path, A, by=["asset_class"], target=1 << 20)
    after = files(path)
    of_day = [n for n in before if n.startswith("calculation_date=2025-01-01")]
    assert gone == len(set(of_day) - large) > 6
    assert large <= set(after) and all(after[n] == before[n] for n in large)
    assert {n for n in before if n not in of_day} <= set(after)
    assert len([n for n in after if n.startswith("calculation_date=2025-01-01")]) == 4  # one for each class, and the large one
    assert rows(spark.read.parquet(path)) == contents
    assert compaction.compact_small(spark, path, A, by=["asset_class"], target=1 << 20) == 0
    assert compaction.compact_small(spark, path, dt.date(1999, 1, 1), target=1 << 20) == 0


def test_a_compaction_that_is_cut_short(monkeypatch, spark, scattered, rows):
    path, _ = scattered
    contents, before = rows(spark.read.parquet(path)), files(path)
    write, move = compaction.Folder.write, compaction.Folder.move

    def broken(*_):
        raise OSError("cut short")

    monkeypatch.setattr(compaction.Folder, "write", broken)  # before the journal
    with pytest.raises(OSError):
        compaction.compact_small(spark, path, A, by=["asset_class"], target=1 << 20)
    assert rows(spark.read.parquet(path)) == contents and set(before) <= set(files(path))
    monkeypatch.setattr(compaction.Folder, "write", write)
    moves = []

    def once(self, source, target):
        if len(moves) == 2:
            raise OSError("cut short")
        moves.append(source)
        move(self, source, target)

    monkeypatch.setattr(compaction.Folder, "move", once)  # the journal and one file are in place
    with pytest.raises(OSError):
        compaction.compact_small(spark, path, A, by=["asset_class"], target=1 << 20)
    monkeypatch.setattr(compaction.Folder, "move", move)
    folder = f"{path}/calculation_date={A}"
    assert len(compaction.Folder(spark, folder).staged()) == 1  # not that of the first attempt
    assert json.loads(pathlib.Path(folder, compaction.JOURNAL).read_text())["add"]
    assert compaction.recover(spark, folder) and not compaction.recover(spark, folder)
    assert rows(spark.read.parquet(path)) == contents


def test_a_slice_without_classes(spark, folder, rows):
    frame = spark.range(100).select(F.lit(A).alias("calculation_date"), "id")
    frame.repartition(5).write.partitionBy("calculation_date").parquet(folder + "/t")
    before = rows(spark.read.parquet(folder + "/t"))
    assert compaction.compact_small(spark, folder + "/t", A) == 5
    assert len(files(folder + "/t")) == 1 and rows(spark.read.parquet(folder + "/t")) == before
