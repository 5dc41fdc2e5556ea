"""Sources and sinks on files."""

from __future__ import annotations

import datetime as dt
import json
import pathlib
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.operators import standardise
from keelstone.sinks import layout, scratch, tables, writers
from keelstone.sources import generator, readers, reference, testviews as tv

A, B = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


def parquet_files(path):
    return sorted(str(p) for p in pathlib.Path(path).rglob("*.parquet"))


def day_rows(spark, day, *classes):
    return spark.createDataFrame(
        [(day, c, i) for i, c in enumerate(classes)],
        "calculation_date date, asset_class string, n int",
    )


def test_indented_json_array(spark, folder):
    pairs = [{"currency_pair": " eurusd ", "rate": 1.1, "date": "2025-01-01", "source": "X"},
             {"currency_pair": "GBPUSD", "rate": 1.27, "date": "2025-01-01", "source": "X"}]
    pathlib.Path(folder, "fx.json").write_text(json.dumps(pairs, indent=2))
    clean = standardise.standardise_fx(readers.read_fx_json(spark, folder + "/fx.json"))
    got = {r.currency_pair: float(r.rate) for r in clean.collect()}
    assert got == {"EURUSD": 1.1, "GBPUSD": 1.27}
    assert clean.schema["rate"].dataType == schemas.RATE


def test_json_lines(spark, folder):
    pathlib.Path(folder, "fx.json").write_text(
        '{"currency_pair":"EURUSD","rate":1.1}\n{"currency_pair":"GBPUSD","rate":1.2}\n'
    )
    assert readers.read_fx_json(spark, folder + "/fx.json", multiline=False).count() == 2


def test_csv_keeps_bad_lines(spark, folder):
    pathlib.Path(folder, "r.csv").write_text(
        "customer_id,rating_agency,rating,rating_date,outlook\n"
        "C1,S&P,AAA,2025-01-01,STABLE\nC2,FITCH,BB,not a date,STABLE\n"
    )
    got = readers.read_ratings_csv(spark, folder + "/r.csv", corrupt_column="_bad").orderBy(
        "customer_id"
    ).collect()
    assert got[0].rating_date == A and got[0]._bad is None
    assert got[1].rating_date is None and "not a date" in got[1]._bad


def test_slice_is_replaced_as_a_whole(spark, folder, rows):
    """A rerun with fewer classes leaves none of the first run's behind."""
    path = folder + "/t"
    writers.replace_slice(day_rows(spark, A, "P", "Q"), path, "calculation_date", A, ["asset_class"])
    writers.replace_slice(day_rows(spark, B, "P", "Q"), path, "calculation_date", B, ["asset_class"])
    for _ in range(2):
        writers.replace_slice(day_rows(spark, B, "R"), path, "calculation_date", B, ["asset_class"])
    got = readers.read_fact(spark, path).select("calculation_date", "asset_class", "n")
    assert rows(got) == [(A, "P", 0), (A, "Q", 1), (B, "R", 0)]
    assert readers.read_fact(spark, path, A).count() == 2


@pytest.mark.parametrize("other", [B, None])
def test_foreign_dates_are_refused(spark, folder, other):
    mixed = day_rows(spark, A, "P").unionByName(day_rows(spark, other, "P"))
    with pytest.raises(PySparkException, match="calculation_date is not 2025-01-01"):
        writers.replace_slice(mixed, folder + "/t", "calculation_date", A)


def test_trailing_days_exclude_the_day_itself(spark):
    days = spark.range(20).select(
        F.date_add(F.lit(A), F.col("id").cast("int")).alias("calculation_date")
    )
    got = readers.trailing_days(days, dt.date(2025, 1, 15), 7).collect()
    assert [min(got)[0], max(got)[0], len(got)] == [dt.date(2025, 1, 8), dt.date(2025, 1, 14), 7]


def test_hot_partition_value_is_written_by_several_tasks(spark, folder):
    frame = spark.range(20_000).select(
        "id", F.when(F.col("id") % 10 < 9, "BIG").otherwise("SMALL").alias("asset_class")
    )
    writers.write_partitioned(frame, folder + "/t", ["asset_class"], n=8)
    files = parquet_files(folder + "/t/asset_class=BIG")
    assert len(files) >= 4
    assert spark.read.parquet(folder + "/t").count() == 20_000


def test_compaction_keeps_rows_and_cuts_files(spark, folder, rows):
    path = folder + "/t"
    many = day_rows(spark, A, *"PQRSTUVW").unionByName(day_rows(spark, B, "P"))
    many.repartition(8).write.partitionBy("calculation_date").parquet(path)
    before = rows(spark.read.parquet(path))
    untouched = parquet_files(f"{path}/calculation_date={B}")
    assert len(parquet_files(f"{path}/calculation_date={A}")) > 2
    writers.compact(spark, path, A, files=1)
    assert len(parquet_files(f"{path}/calculation_date={A}")) == 1
    assert parquet_files(f"{path}/calculation_date={B}") == untouched
    assert rows(spark.read.parquet(path)) == before


def test_clustering_narrows_the_range_per_file(spark, folder):
    n = F.xxhash64("id")
    frame = spark.range(8_000).select(
        "id", F.concat(F.lit("G"), F.pmod(n, F.lit(16)) + 10).alias("geography"),
        F.concat(F.lit("B"), F.pmod(F.shiftright(n, 8), F.lit(16)) + 10).alias("bucket"),
    )
    layout.cluster(frame, ["geography", "bucket"], files=16).write.parquet(folder + "/z")
    files = spark.read.parquet(folder + "/z").groupBy(F.input_file_name().alias("f")).agg(
        F.countDistinct("geography").alias("g"), F.countDistinct("bucket").alias("b"),
        F.count(F.lit(1)).alias("n"),
    )
    got = files.collect()
    assert sum(r.n for r in got) == 8_000
    assert max(r.n for r in got) < 2 * 8_000 / len(got)
    # both columns are narrowed, which sorting by one column would not do
    assert sum(r.g for r in got) / len(got) < 10
    assert sum(r.b for r in got) / len(got) < 10


def test_equal_z_values_are_cut_between_files(spark, folder):
    frame = spark.range(8_000).select("id", F.lit("US").alias("geography"))
    layout.cluster(frame, ["geography"], files=8).write.parquet(folder + "/z")
    assert len(parquet_files(folder + "/z")) == 8


def test_ordinals_keep_order(spark):
    frame = spark.createDataFrame(
        [("", dt.date(1969, 1, 1)), ("A", A), ("AB", B), ("B", B), ("Zürich", B), ("é", B)],
        "s string, d date",
    )
    got = frame.select(layout.ordinal(frame, "s").alias("s"), layout.ordinal(frame, "d").alias("d")).collect()
    assert [r.s for r in got] == sorted({r.s for r in got})
    assert got[0].d < got[1].d < got[2].d


def test_texts_that_begin_alike_get_different_ranks(spark):
    frame = spark.range(4_000).select(
        F.format_string("L%07d", F.col("id")).alias("loan"),
        F.element_at(
            F.array(*map(F.lit, ["RETAIL_MORTGAGE", "RETAIL_OTHER", "CORPORATE_SME", "CORPORATE_LARGE"])),
            (F.col("id") % 4 + 1).cast("int"),
        ).alias("asset_class"),
    )
    classes = layout.with_z_value(frame, ["asset_class"]).groupBy("asset_class").agg(
        F.min("_z").alias("low"), F.max("_z").alias("high")
    ).orderBy("asset_class").collect()
    assert [r.low for r in classes] == [r.high for r in classes] == sorted({r.low for r in classes})
    assert len(classes) == 4
    ranks = layout.with_z_value(frame, ["loan"]).groupBy("_z").count().collect()
    assert len(ranks) > 100 and max(r["count"] for r in ranks) < 200


def test_warehouse_types_cut_strings(spark, sf_dir):
    fact = tv.fact(spark, sf_dir).withColumn("product_type", F.lit("X" * 30))
    typed = writers.to_warehouse_types(fact)
    assert [f.name for f in typed.schema.fields] == [n for n, _, _ in schemas.WAREHOUSE_DETAIL]
    row = typed.first()
    assert len(row.product_type) == 20
    assert row.basel_version is None
    assert typed.schema["risk_weight"].dataType.simpleString() == "decimal(5,4)"


def test_metrics_come_with_the_write(spark, folder, sf_dir):
    fact = tv.fact(spark, sf_dir)
    seen = Observation("test-metrics")
    writers.replace_slice(fact, folder + "/t", "calculation_date", tv.AS_OF, ["asset_class"], seen=seen)
    totals = fact.agg(F.sum("risk_weighted_assets"), F.count(F.lit(1)), F.count_if("high_risk_flag")).first()
    assert seen.get["ProcessedLoans"] == totals[1]
    assert seen.get["HighRiskLoans"] == totals[2]
    assert seen.get["TotalRWA"] == pytest.approx(totals[0])


def test_export_bounds_files(spark, folder):
    writers.export_parquet(spark.range(1000).withColumn("x", F.lit(1)), folder + "/e", ["id"], files=3)
    assert len(parquet_files(folder + "/e")) == 3
    assert spark.read.parquet(folder + "/e").columns == ["id"]


def test_star_load_replaces_one_date(spark, folder):
    db = "star_" + pathlib.Path(folder).name.replace("-", "_")
    tables.create_star(spark, db, folder + "/star")
    summary = reference.literal_table(
        spark, [("calculation_date", "date"), ("asset_class", "string"), ("total_rwa", "double")],
        [(A, "P", 1.0), (A, "Q", 2.0)],
    )
    name = f"{db}.{tables.SUMMARY}"
    for day in (A, B):
        typed = writers.to_warehouse_types(
            summary.withColumn("calculation_date", F.lit(day)), schemas.WAREHOUSE_SUMMARY
        )
        tables.load(typed, name, {"calculation_date": day})
    tables.load(typed.where("asset_class = 'P'"), name, {"calculation_date": B})
    got = spark.table(name).groupBy("calculation_date").count().orderBy("calculation_date").collect()
    assert [tuple(r) for r in got] == [(A, 2), (B, 1)]
    assert spark.table(f"{db}.ref_risk_weights").count() == 24


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.new_path(spark, "x"), scratch.new_path(spark, "x")
    assert one.startswith(configured) and one != two


def test_library_has_no_local_checkpoint_or_collecting_loops():
    root = pathlib.Path(__file__).resolve().parents[1] / "keelstone"
    text = "\n".join(p.read_text() for p in root.rglob("*.py"))
    assert not re.search(r"localCheckpoint|toPandas|\.rdd\b|crossJoin|@F\.udf|pandas_udf", text)


# Generator ------------------------------------------------------------------------


def test_portfolio_is_deterministic_and_consistent(spark, rows):
    small = generator.generate_portfolio(spark, 2_000, 200, 300)
    again = generator.generate_portfolio(spark, 2_000, 200, 300)
    assert rows(small["loans"].repartition(3)) == rows(again["loans"])
    other = generator.generate_portfolio(spark, 2_000, 200, 300, seed=7)
    assert rows(small["loans"]) != rows(other["loans"])
    loans, cpty = small["loans"], small["counterparty"]
    joined = loans.join(cpty, "customer_id")
    assert joined.count() == 2_000
    assert joined.where(
        (loans.internal_rating != cpty.internal_rating) | (loans.country_code != cpty.country_code)
    ).count() == 0
    assert loans.join(small["collateral"], "collateral_id", "left_anti").where(
        "collateral_id is not null"
    ).count() == 0
    assert small["collateral"].where("haircut_percentage not between 0 and 1").count() == 0
    twice = small["ratings"].groupBy("customer_id", "rating_agency").count().where("count > 1")
    assert twice.count() == 0


def test_portfolio_shares(spark):
    loans = generator.generate_portfolio(spark, 20_000, 2_000, 300, heavy=20)["loans"]
    heavy = loans.where("customer_id <= 'C000020'").count() / 20_000
    pledged = loans.where("collateral_id is not null").count() / 20_000
    assert 0.18 < heavy < 0.24
    assert 0.48 < pledged < 0.52
    assert loans.where("exposure_at_default < outstanding_balance").count() == 0
