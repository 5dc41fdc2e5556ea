"""Checks, their report, the gate and the quarantine."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelstone.operators import quality as q, reconcile as rc, suites, trend

LOANS = [
    ("L001", "C001", 100_000.0), ("L002", None, -50_000.0), ("L003", "C003", None),
    ("L003", "C003", 10.0),
]


@pytest.fixture(scope="module")
def loans(spark):
    return spark.createDataFrame(LOANS, "loan_id string, customer_id string, balance double")


def found(results):
    return {(r.check_type, r.item): r for r in results.collect()}


def test_checks_of_one_table(loans):
    checks = [
        q.RowCount(4, 4), q.Nulls(["customer_id", "balance", "ghost"], 25.0), q.Unique(["loan_id"]),
        q.Rules([q.Rule("positive", "balance > 0", "must be positive")]),
        q.SumMatches("balance", 50_010.0),
    ]
    got = found(q.run_checks(loans, "loans", checks))
    assert got["row_count_check", "rows"].is_valid
    assert got["null_check", "customer_id"].metric == 25.0
    assert got["null_check", "customer_id"].is_valid
    assert ("null_check", "ghost") not in got
    assert got["duplicate_check", "loan_id"].metric == 1.0
    rule = got["business_rules", "positive"]
    assert (rule.metric, rule.is_valid) == (1.0, False)
    assert rule.detail == {"unknown": "1", "message": "must be positive"}
    assert got["reconciliation", "balance"].is_valid


def test_empty_table(spark):
    empty = spark.createDataFrame([], "loan_id string, balance double")
    checks = [
        q.Nulls(["loan_id"], 0.0), q.RowCount(1, 2), q.SumMatches("balance", 5.0),
        q.Anomalies(["balance"]), q.Unique(["loan_id"]),
    ]
    got = found(q.run_checks(empty, "t", checks))
    assert got["null_check", "loan_id"].is_valid
    assert not got["row_count_check", "rows"].is_valid
    assert (got["reconciliation", "balance"].metric, got["reconciliation", "balance"].is_valid) == (100.0, False)
    assert ("anomaly_detection", "balance") not in got
    assert got["duplicate_check", "loan_id"].is_valid


def test_anomalies_are_strict_and_skip_constants(spark):
    frame = spark.createDataFrame([(float(x), 7.0) for x in [1] * 30 + [100]], "x double, c double")
    got = found(q.check_anomalies(frame, "t", q.Anomalies(["x", "c", "ghost"])))
    assert set(got) == {("anomaly_detection", "x")}
    assert got["anomaly_detection", "x"].metric == 1.0


def test_schema(spark):
    frame = spark.createDataFrame([], "a string, b int, extra int")
    wanted = T.StructType().add("a", "string").add("b", "double").add("c", "date")
    got = {r.item: (r.is_valid, r.detail["problem"]) for r in q.validate_schema(frame, wanted, "t").collect()}
    assert got == {
        "a": (True, ""), "b": (False, "type"), "c": (False, "missing"), "extra": (True, "extra"),
    }


def test_summary_and_gate(loans):
    good = q.run_checks(loans, "loans", [q.RowCount(1, 10)])
    q.gate(good)
    both = q.log_results(good, q.run_checks(loans, "loans", [q.Unique(["loan_id"])]))
    row = q.summary(both).first()
    assert (row.total_checks, row.passed, row.failed, row.pass_rate) == (2, 1, 1, 50.0)
    with pytest.raises(q.QualityError, match="1 of 2"):
        q.gate(both)


def test_quarantine_and_accepted_are_complements(spark):
    frame = spark.createDataFrame(
        [("1", 5.0, "12.5"), ("2", -1.0, "x"), ("3", None, None), ("4", 2.0, "y")],
        "id string, balance double, amount string",
    )
    rules, casts = [q.Rule("positive", "balance > 0")], {"amount": "decimal(18,2)"}
    bad = {r.id: r.reject_reasons for r in q.quarantine(frame, rules, casts).collect()}
    assert bad == {"2": ["positive", "cast_amount"], "3": ["positive"], "4": ["cast_amount"]}
    assert [r.id for r in q.accepted(frame, rules, casts).collect()] == ["1"]


def test_source_suite_is_configurable(spark):
    loans = spark.createDataFrame(
        [("L1", "C1", 1.0, "OTHER")],
        "loan_id string, customer_id string, outstanding_balance double, asset_class string",
    )
    collateral = spark.createDataFrame([("K1", 1.0)], "collateral_id string, market_value double")
    ratings = spark.createDataFrame([("C1", "A")], "customer_id string, rating string")
    results = suites.run_source_suite(
        {"loans": loans, "collateral": collateral, "ratings": ratings},
        loan_rows=(1, 1), collateral_rows=(1, 1), rating_rows=(1, 1),
    )
    failed = [r.item for r in results.where(~F.col("is_valid")).collect()]
    assert failed == ["valid_asset_class"]


def test_invariants(spark):
    schema = (
        "outstanding_balance_usd double, risk_weighted_assets double, regulatory_capital double, "
        "risk_weight double, customer_id string, high_risk_flag boolean"
    )
    fine = spark.createDataFrame([(100.0, 120.0, 9.6, 1.2, "c", False)], schema)
    assert all(r.is_valid for r in q.calc_invariants(fine).collect())
    odd = spark.createDataFrame([(100.0, 160.0, 9.6, 1.6, "c", False)], schema)
    assert [r.item for r in q.calc_invariants(odd).collect() if not r.is_valid] == ["plausible_rwa"]
    nothing = spark.createDataFrame([], schema)
    assert not any(r.is_valid for r in q.calc_invariants(nothing).collect())


# Reconciliation ------------------------------------------------------------------

FACT = (
    "calculation_date date, loan_id string, customer_id string, asset_class string, "
    "outstanding_balance_usd double, risk_weighted_assets double, regulatory_capital double"
)


@pytest.fixture(scope="module")
def fact(spark):
    import datetime as dt

    a, b, c = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 5)
    rows = [
        (a, "1", "x", "P", 100.0, 100.0, 8.0), (a, "2", "y", "Q", 50.0, 50.0, 4.0),
        (b, "1", "x", "P", 100.0, 103.0, 8.0), (b, "3", "z", "Q", 60.0, 60.0, 4.8),
        (c, "1", "x", "P", 100.0, 200.0, 8.0),
    ]
    return spark.createDataFrame(rows, FACT), (a, b, c)


def test_totals_against_source(spark, fact):
    frame, (a, b, c) = fact
    source = spark.createDataFrame(
        [(a, 150.0, 2), (b, 160.0, 3), (c, 0.0, 1)],
        "calculation_date date, source_exposure double, source_loan_count long",
    )
    got = {r.calculation_date: r for r in rc.reconcile_totals(frame, source).collect()}
    assert [got[d].status for d in (a, b, c)] == ["PASSED", "FAILED", "PASSED"]
    assert got[c].exposure_variance_pct is None
    absent = rc.reconcile_totals(frame, source.where(F.col("calculation_date") != F.lit(a)))
    assert {r.calculation_date: r.status for r in absent.collect()}[a] == "FAILED"


def test_day_over_day(fact):
    frame, (a, b, c) = fact
    got = {r.calculation_date: r for r in rc.day_over_day(frame).collect()}
    assert [got[d].status for d in (a, b, c)] == ["SKIPPED", "PASSED", "SKIPPED"]
    assert got[b].rwa_change_pct == pytest.approx(13 / 150 * 100)
    (one,) = rc.day_over_day(frame, b, threshold_pct=5.0).collect()
    assert (one.status, one.previous_date) == ("WARNING", a)


def test_asset_classes_on_one_side_only_fail(spark, fact):
    frame, (a, b, c) = fact
    source = spark.createDataFrame(
        [(a, "P", 100.05), (a, "R", 5.0)],
        "calculation_date date, asset_class string, source_exposure double",
    )
    today = frame.where(F.col("calculation_date") == F.lit(a))
    got = {r.asset_class: r.status for r in rc.reconcile_asset_class(today, source).collect()}
    assert got == {"P": "PASSED", "Q": "FAILED", "R": "FAILED"}


def test_movers_equal_the_full_outer_join(fact):
    frame, (a, b, _) = fact
    got = {r.customer_id: r for r in trend.top_movers(frame, b).collect()}
    assert (got["x"].rwa_change, got["x"].change_pct) == (3.0, pytest.approx(3.0))
    assert (got["y"].rwa_change, got["y"].change_pct) == (-50.0, None)
    assert (got["z"].rwa_change, got["z"].change_pct) == (60.0, None)
    assert [r.customer_id for r in trend.top_movers(frame, b, 2).collect()] == ["z", "y"]


def test_overall_status(fact):
    frame, (a, b, c) = fact
    outcomes = rc.report(days=rc.day_over_day(frame))
    got = {r.calculation_date: r for r in rc.summary(outcomes).collect()}
    assert (got[a].skipped, got[a].overall_status) == (1, "PASSED")
    assert (got[b].passed, got[b].total_checks) == (1, 1)
