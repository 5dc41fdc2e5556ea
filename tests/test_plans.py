"""Physical plans: pruning, pushdown, broadcasts and top-k."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from keelstone.operators import aggregates, detail, joins, quality as q
from keelstone.sinks import writers
from keelstone.sources import readers, reference, testviews as tv


def test_fixed_tables_are_local_relations(spark, plan_text):
    for table in (reference.risk_weights(spark), reference.ccf_table(spark)):
        assert "LocalTableScan" in plan_text(table)


def test_lookups_are_broadcast(spark, sf_dir, plan_text):
    loans = tv.clean_loans(spark, sf_dir).withColumn("rating_bucket", F.lit("A"))
    text = plan_text(joins.attach_risk_weight(loans, reference.risk_weights(spark)))
    assert "BroadcastHashJoin LeftOuter" in text
    assert "SortMergeJoin" not in text


def test_no_python_in_the_fact(spark, sf_dir, plan_text):
    text = plan_text(tv.fact(spark, sf_dir))
    assert not re.search("Python|CartesianProduct|BroadcastNestedLoop", text)


def test_scan_reads_only_needed_columns(spark, sf_dir, plan_text):
    text = plan_text(joins.key_counts(tv.loan_keys(spark, sf_dir), "customer_id"))
    assert re.findall(r"ReadSchema: (\S+)", text) == ["struct<o_custkey:bigint>"]


def test_filter_reaches_the_scan(spark, sf_dir, plan_text):
    text = plan_text(tv.table(spark, sf_dir, "orders").where("o_orderkey > 100"))
    assert "GreaterThan(o_orderkey,100)" in text


def test_date_is_a_partition_filter(spark, folder, plan_text):
    import datetime as dt

    days = spark.range(10).select(
        "id", F.date_add(F.lit(dt.date(2025, 1, 1)), F.col("id").cast("int")).alias("date")
    )
    writers.write_partitioned(days, folder + "/t", ["date"])
    one = readers.read_snapshot(spark, folder + "/t", dt.date(2025, 1, 3))
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(date" in plan_text(one)
    assert len(one.inputFiles()) == 1 or "PartitionFilters" in plan_text(one)


def test_top_customers_is_a_top_k(spark, sf_dir, plan_text):
    text = plan_text(aggregates.top_customers(tv.fact(spark, sf_dir)))
    assert "TakeOrderedAndProject" in text


def test_all_row_checks_share_one_scan(spark, sf_dir, plan_text):
    loans = tv.loans(spark, sf_dir, with_customer=False)
    checks = [q.RowCount(0, 1), q.Nulls(["loan_id"]), q.Rules([q.Rule("r", "outstanding_balance > 0")])]
    assert len(re.findall(r"Scan parquet", plan_text(q.one_pass(loans, "loans", checks)))) == 2


def test_report_levels_scan_the_fact_once(spark, folder, sf_dir, plan_text):
    writers.write_table(tv.fact(spark, sf_dir), folder + "/fact")
    stored = spark.read.parquet(folder + "/fact")
    text = plan_text(aggregates.multi_level(stored))
    # once in the tree, once in the details
    assert len(re.findall(r"Scan parquet", text)) == 2


def test_large_collateral_is_joined_by_key_and_salt(spark, folder, sf_dir, plan_text):
    """Beyond the broadcast threshold: every side once, by key and salt, ratings too."""
    tables = {
        "loans": tv.clean_loans(spark, sf_dir), "ratings": tv.clean_ratings(spark, sf_dir),
        "collateral": tv.clean_collateral(spark, sf_dir),
    }
    for name, frame in tables.items():
        writers.write_table(frame, f"{folder}/{name}")
    stored = {n: spark.read.parquet(f"{folder}/{n}") for n in tables}
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        main, doubtful = (
            plan_text(
                detail.detail(
                    stored["loans"], stored["ratings"], stored["collateral"], tv.clean_fx(spark),
                    tv.AS_OF, unique_collateral=unique,
                )
            ).split("===== Subqueries =====")[0]
            for unique in (True, False)
        )
    finally:
        spark.conf.set(threshold, before)
    salted = re.findall(r"Arguments: hashpartitioning\(collateral_id#\d+L?, _salt#\d+L?", main)
    assert len(salted) == 2
    rated = re.findall(r"Arguments: hashpartitioning\(customer_id#\d+L?, _salt#\d+L?", main)
    assert len(rated) == 2
    # unique collateral is shuffled for its join only, not to make it unique
    by_id = r"Arguments: hashpartitioning\(collateral_id#\d+L?, \d+\)"
    assert len(re.findall(by_id, main)) == len(re.findall(by_id, doubtful)) - 1
    assert not re.search("CartesianProduct|BroadcastNestedLoop", main)


def test_narrow_queries_read_what_they_show(spark, sf_dir, plan_text):
    from keelstone import catalog

    queries = catalog.all_queries()

    def scanned(name):
        return set(re.findall(r"Location: \S+ \[file:\S*/(\w+)\.parquet", plan_text(queries[name](spark, sf_dir))))

    for name in ("rk_geography", "rk_metadata", "rk_ead", "rk_exposure_type", "flt_date_slice"):
        assert scanned(name) <= {"orders", "customer"}, name
    for name in ("rk_final_rating", "rk_rating_bucket", "rk_pd", "rk_risk_weight", "rk_quality_score"):
        assert scanned(name) == {"orders", "customer", "events"}, name


def test_distinct_counts_do_not_expand_the_fact(spark, folder, sf_dir, plan_text):
    writers.write_table(tv.fact(spark, sf_dir), folder + "/fact")
    fact = spark.read.parquet(folder + "/fact")
    for frame in (aggregates.recon_totals(fact), aggregates.daily_kpis_of(aggregates.customer_class_totals(fact))):
        assert "Expand" not in plan_text(frame)
    keyed, exact = aggregates.recon_totals(fact).first(), aggregates.recon_totals(fact, "exact").first()
    assert (keyed.loan_count, keyed.customer_count) == (exact.loan_count, exact.customer_count)
