"""The daily run end to end on a synthetic portfolio."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keelstone.operators import capital, quality
from keelstone.params import Settings
from keelstone.plans import daily
from keelstone.sources import generator, readers

DAY = generator.BASE_DATE
NEXT = DAY + dt.timedelta(days=1)
RANGES = {"loan_rows": (1, 10**6), "collateral_rows": (1, 10**6), "rating_rows": (1, 10**6)}


@pytest.fixture(scope="module")
def portfolio(spark):
    return generator.generate_portfolio(spark, 3_000, 300, 500)


@pytest.fixture(scope="module")
def outcome(spark, portfolio):
    import tempfile

    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    # the portfolio has products without an own class, which the class rule reports
    plan = daily.Plan(root, row_ranges=RANGES, strict=False, cluster_files=4)
    first = daily.run(portfolio, DAY, plan)
    grown = {**portfolio, "loans": portfolio["loans"].withColumn(
        "outstanding_balance", F.col("outstanding_balance") * 1.2)}
    before = daily.run(grown, NEXT, plan)["fact"].count()
    # the rerun replaces the files of the run before it
    second = daily.run(grown, NEXT, plan)
    return plan, first, second, before


def test_every_loan_is_calculated_once(portfolio, outcome):
    _, first, _, _ = outcome
    fact = first["fact"]
    assert fact.count() == portfolio["loans"].count() == first["metrics"]["ProcessedLoans"]
    assert fact.select("loan_id").distinct().count() == fact.count()


def test_invariants_of_the_fact(outcome):
    fact = outcome[1]["fact"]
    off = fact.where(
        "collateral_coverage_ratio not between 0 and 1 or ead_after_crm > exposure_at_default or "
        "abs(risk_weighted_assets - ead_after_crm * risk_weight_floored) > 0.01 or "
        "abs(regulatory_capital - 0.08 * risk_weighted_assets) > 0.01"
    )
    assert off.count() == 0


def test_groups_add_up(outcome):
    _, first, _, _ = outcome
    total = first["metrics"]["TotalRWA"]
    reports = first["reports"]
    for name, column in [("rwa_summary", "total_rwa"), ("geographic_concentration", "geo_rwa"),
                         ("regulatory_exposure_class", "rwa"), ("pillar1", "total_rwa")]:
        assert reports[name].agg(F.sum(column)).first()[0] == pytest.approx(total)


def test_first_day_has_no_trend_second_has(outcome):
    _, first, second, _ = outcome
    assert first["reports"]["rwa_summary"].where("rwa_change_pct is not null").count() == 0
    changes = second["reports"]["rwa_summary"]
    assert changes.where("rwa_change_pct is not null").count() > 0


def test_derived_reports_equal_those_made_from_the_fact(outcome, rows):
    from keelstone.operators import aggregates as agg

    fact, reports = outcome[1]["fact"], outcome[1]["reports"]

    def close(a, b):
        columns = sorted(a.columns)
        for x, y in zip(rows(a.select(*columns)), rows(b.select(*columns)), strict=True):
            for p, q in zip(x, y, strict=True):
                assert p == q or p == pytest.approx(q, rel=1e-9)

    close(reports["rwa_statistics"].drop("calculation_date"), agg.statistics(fact))
    close(reports["geographic_concentration"], agg.geo_concentration(fact))
    close(reports["pillar1"], agg.pillar1(fact))
    close(reports["regulatory_exposure_class"], agg.exposure_class(fact))
    close(reports["top_customers"].drop("calculation_date"), agg.top_customers(fact))
    close(reports["kpi_dashboard"], agg.daily_kpis(fact))


def test_rerun_replaces_and_keeps_other_days(spark, outcome):
    plan, first, second, before = outcome
    for table in ("rwa_detail", "rwa_summary", "kpi_dashboard", "pillar1", "top_customers"):
        stored = readers.read_fact(spark, plan.path("processed", table))
        per_day = {r[0]: r[1] for r in stored.groupBy("calculation_date").count().collect()}
        assert set(per_day) == {DAY, NEXT}
    assert second["fact"].count() == before
    kpis = readers.read_fact(spark, plan.path("processed", "kpi_dashboard"))
    assert kpis.count() == 2


def test_reconciliation(outcome):
    _, first, second, _ = outcome
    status = lambda run: {
        (r.check_name, r.item): r.status for r in run["reconciliation"].collect()
    }
    assert status(first)["totals", "total"] == "PASSED"
    assert status(first)["day_over_day", "total"] == "SKIPPED"
    assert status(second)["day_over_day", "total"] == "WARNING"
    assert "FAILED" not in status(second).values()


def test_report_is_stored_before_the_gate_closes(spark, portfolio, folder):
    plan = daily.Plan(folder, row_ranges={**RANGES, "loan_rows": (1, 10)})
    with pytest.raises(quality.QualityError):
        daily.run(portfolio, DAY, plan)
    stored = spark.read.json(f"{folder}/validation/source/date={DAY}")
    assert stored.where("not is_valid").count() >= 1


def test_invariants_are_stored_before_the_gate_closes(spark, portfolio, folder):
    # a floor that makes the weighted assets implausibly larger than the exposure
    classes = ("RETAIL_MORTGAGE", "RETAIL_OTHER", "CORPORATE_SME", "CORPORATE_LARGE", "OTHER")
    steep = Settings(weight_floors=dict.fromkeys(classes, 9.0))
    plan = daily.Plan(folder, settings=steep, check_sources=False)
    with pytest.raises(quality.QualityError):
        daily.run(portfolio, DAY, plan)
    stored = spark.read.json(f"{folder}/validation/calculation/date={DAY}")
    assert stored.count() == 3 and stored.where("not is_valid").count() >= 1


def test_metrics_are_those_of_the_stored_slice(outcome):
    _, first, _, _ = outcome
    row = first["fact"].agg(F.sum("risk_weighted_assets"), F.count("*"), F.count_if("high_risk_flag")).first()
    metrics = first["metrics"]
    assert metrics["TotalRWA"] == pytest.approx(row[0])
    assert (metrics["ProcessedLoans"], metrics["HighRiskLoans"]) == (row[1], row[2])


def test_staged_and_rejected_are_all_loans(spark, portfolio, folder):
    n = F.substring("loan_id", -4, 4).cast("int")
    loans = portfolio["loans"].withColumns({
        "outstanding_balance": F.when(n % 10 == 0, -1.0).otherwise(F.col("outstanding_balance")),
        "maturity_date": F.when(n % 7 == 0, F.lit(DAY)).otherwise(F.col("maturity_date")),
        "currency": F.when(n % 5 == 1, "XXX").otherwise(F.col("currency")),
    })
    settings = Settings(missing_fx="quarantine")
    plan = daily.Plan(folder, settings=settings, check_sources=False, strict=False)
    staged = daily.standardise_all({**portfolio, "loans": loans}, plan, DAY)
    rejected = staged["rejected_loans"]
    assert staged["loans"].count() + rejected.count() == loans.count()
    assert staged["loans"].join(rejected, "loan_id").count() == 0
    reasons = {r[0] for r in rejected.select(F.explode("reject_reasons")).distinct().collect()}
    assert reasons == {"positive_balance", "unmatured", "no_rate_currency"}
    counts = {r.table_name: r.row_count for r in readers.read_fact(
        spark, plan.path("staging", "row_counts"), DAY, "as_of_date").collect()}
    assert counts["loans"] == staged["loans"].count() and counts["rejected_loans"] == rejected.count()


def test_clustered_copy_and_export_hold_the_same_rows(spark, outcome):
    plan, first, _, _ = outcome
    n = first["fact"].count()
    for zone, table in [("processed", "rwa_detail_clustered"), ("warehouse", "rwa_calculations")]:
        assert readers.read_fact(spark, plan.path(zone, table), DAY).count() == n


# Documented rules ----------------------------------------------------------------------


def test_drawn_and_undrawn(spark):
    frame = spark.createDataFrame([(3e6, 1e7, "COMMITTED"), (3e6, 1e7, "UNCOMMITTED")], "d double, l double, c string")
    ead = capital.drawn_undrawn_ead(F.col("d"), F.col("l"), F.col("c"))
    assert [r[0] for r in frame.select(ead).collect()] == [6.5e6, 3e6]


def test_standard_haircut_example(spark):
    from keelstone.sources import reference

    frame = spark.createDataFrame(
        [("REAL_ESTATE_RESIDENTIAL", 500_000.0), ("ART", 10.0)], "collateral_type string, market_value double"
    )
    out = capital.with_standard_haircut(frame, reference.standard_haircuts(spark))
    got = {r.collateral_type: r.standard_value for r in out.collect()}
    assert got == {"REAL_ESTATE_RESIDENTIAL": pytest.approx(325_000), "ART": 0.0}


def test_capital_stack_and_ranges(spark):
    totals = spark.createDataFrame([(1000.0,)], "total_rwa double")
    stack = capital.capital_stack(totals, capital.capital_layers(0.01, 0.02))
    got = {r.layer: r.capital_amount for r in stack.collect()}
    assert got["TOTAL"] == pytest.approx(80.0)
    assert got["SYSTEMIC_BUFFER"] == pytest.approx(20.0)
    with pytest.raises(ValueError, match="outside"):
        capital.capital_layers(countercyclical=0.03)


def test_allocation_never_exceeds_the_collateral(spark):
    loans = spark.createDataFrame(
        [("1", "K", 100.0, 50.0), ("2", "K", 300.0, 50.0), ("3", None, 10.0, None)],
        "loan_id string, collateral_id string, exposure_at_default double, "
        "adjusted_collateral_value_usd double",
    )
    got = {r.loan_id: r.allocated_collateral_usd for r in capital.allocate_collateral(loans).collect()}
    assert got == {"1": 12.5, "2": 37.5, "3": None}
