"""The daily run: one Spark application from raw snapshots to reports.

Stored tables are the only boundaries between stages. The fact is computed and
written once, with its headline numbers observed on the way; everything after
that reads the stored slice.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.operators import (
    aggregates,
    detail,
    joins,
    quality,
    reconcile,
    standardise,
    suites,
    trend,
)
from keelstone.operators.fx import to_reporting_ccy, with_rate, without_rate
from keelstone.params import DEFAULTS, Settings
from keelstone.sinks import layout, writers
from keelstone.sources import readers

DATE = "calculation_date"
REPORT = (
    "check_type string, table_name string, item string, is_valid boolean, metric double, "
    "threshold double, detail string, date date"
)


@dataclass(frozen=True)
class Plan:
    """Where a run reads and writes, and how."""

    root: str
    settings: Settings = DEFAULTS
    salts: int = 10
    # acceptance ranges of the source suite, where they differ from the standard ones
    row_ranges: dict = field(default_factory=dict)
    check_sources: bool = True
    # stop on a failed check (after its report is stored)
    strict: bool = True
    cluster_files: int | None = None
    history_days: int = 7

    def path(self, zone: str, table: str) -> str:
        return f"{self.root}/{zone}/{table}"


def validate_sources(tables: dict[str, DataFrame], plan: Plan, as_of: dt.date) -> DataFrame:
    """Run the source suite, store its report, then decide."""
    spark = next(iter(tables.values())).sparkSession
    classified = standardise.with_asset_class(
        standardise.normalise_codes(tables["loans"], upper=["product_type"])
    )
    results = suites.run_source_suite({**tables, "loans": classified}, **plan.row_ranges)
    path = plan.path("validation", "source")
    report = results.withColumns({"date": F.lit(as_of), "detail": F.to_json("detail")})
    writers.write_report(report, path, "json")
    stored = spark.read.schema(REPORT).json(path).where(F.col("date") == F.lit(as_of))
    if plan.strict:
        quality.gate(stored)
    return stored


def rejected_loans(
    loans: DataFrame, fx: DataFrame, plan: Plan, as_of: dt.date
) -> DataFrame:
    """Raw loans that do not reach the staged table, each with its reasons."""
    every = standardise.standardise_loans(loans, as_of, drop_invalid=False, drop_matured=False)
    live = [
        quality.Rule("positive_balance", "outstanding_balance > 0"),
        quality.Rule("unmatured", f"maturity_date > DATE '{as_of.isoformat()}'"),
    ]
    out = quality.quarantine(every, live)
    if plan.settings.missing_fx == "quarantine":
        out = out.unionByName(without_rate(quality.accepted(every, live), fx, settings=plan.settings))
    return out


def standardise_all(
    tables: dict[str, DataFrame], plan: Plan, as_of: dt.date
) -> dict[str, DataFrame]:
    """Clean every table into the day's slice of its staging table and read it back.

    Collateral gets one row per id here, once. Loans that are left out are stored beside
    the staged ones with the reasons, and so is the number of rows of every table.
    """
    rates = standardise.standardise_fx(tables["fx"])
    loans = standardise.standardise_loans(tables["loans"], as_of)
    if plan.settings.missing_fx == "quarantine":
        loans = with_rate(loans, rates, settings=plan.settings).where("fx_rate IS NOT NULL").drop("fx_rate")
    clean = {
        "loans": loans,
        "collateral": joins.one_per_key(
            standardise.standardise_collateral(
                tables["collateral"], as_of, plan.settings.stale_after_days
            ),
            "collateral_id",
            ["valuation_date"],
        ),
        "counterparty": standardise.standardise_counterparty(tables["counterparty"]),
        "ratings": standardise.standardise_ratings(tables["ratings"]),
        "fx": rates,
        "rejected_loans": rejected_loans(tables["loans"], rates, plan, as_of),
    }
    split = {"loans": ["asset_class"], "collateral": ["collateral_type"]}
    out = {}
    for name, frame in clean.items():
        path = plan.path("staging", name)
        dated = frame.withColumn("as_of_date", F.lit(as_of))
        writers.replace_slice(dated, path, "as_of_date", as_of, split.get(name, ()))
        out[name] = readers.read_fact(frame.sparkSession, path, as_of, "as_of_date").select(
            *frame.columns
        )
    counts = standardise.stage_counts(out).withColumn("as_of_date", F.lit(as_of))
    writers.replace_slice(counts, plan.path("staging", "row_counts"), "as_of_date", as_of, n=1)
    return out


def calculate(
    staged: dict[str, DataFrame], plan: Plan, as_of: dt.date, created: dt.datetime | None = None
) -> tuple[DataFrame, dict]:
    """Compute and store the fact's slice; returns it with the metrics observed in its write."""
    fact = detail.detail(
        staged["loans"], staged["ratings"], staged["collateral"], staged["fx"], as_of,
        plan.settings, plan.salts, null_keys="split", unique_collateral=True, created=created,
    )
    path = plan.path("processed", "rwa_detail")
    metrics = Observation(f"run-{as_of.isoformat()}")
    writers.replace_slice(fact, path, DATE, as_of, ["asset_class"], seen=metrics)
    stored = readers.read_fact(fact.sparkSession, path, as_of)
    if plan.cluster_files:
        clustered = plan.path("processed", "rwa_detail_clustered")
        rows = layout.cluster(stored, ["geography", "rating_bucket"], plan.cluster_files)
        rows.drop(DATE).write.mode("overwrite").parquet(f"{clustered}/{DATE}={as_of.isoformat()}")
    return stored, metrics.get


def validate_result(fact: DataFrame, plan: Plan, as_of: dt.date) -> DataFrame:
    """Store the invariants of the finished calculation, then decide."""
    path = plan.path("validation", "calculation")
    results = quality.calc_invariants(fact)
    writers.write_report(results.withColumns({"date": F.lit(as_of), "detail": F.to_json("detail")}), path, "json")
    stored = fact.sparkSession.read.schema(REPORT).json(path).where(F.col("date") == F.lit(as_of))
    if plan.strict:
        quality.gate(stored)
    return stored


def stored_history(spark: SparkSession, path: str, as_of: dt.date, days: int) -> DataFrame | None:
    """Summary rows of the days before, or None on the first run."""
    try:
        return readers.trailing_days(spark.read.parquet(path), as_of, days)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def aggregate(fact: DataFrame, plan: Plan, as_of: dt.date) -> dict[str, DataFrame]:
    """Store every report of the day and return them as stored.

    The fact is read twice, for the summary and for the totals by customer; all
    other reports are made from these two small stored tables.
    """
    spark = fact.sparkSession
    out: dict[str, DataFrame] = {}

    def store(name: str, frame: DataFrame, n: int | None = 1) -> DataFrame:
        path = plan.path("processed", name)
        writers.replace_slice(frame.withColumn(DATE, F.lit(as_of)), path, DATE, as_of, n=n)
        out[name] = readers.read_fact(spark, path, as_of)
        return out[name]

    history = stored_history(spark, plan.path("processed", "rwa_summary"), as_of, plan.history_days)
    summary = store("rwa_summary", trend.daily_trend(aggregates.summary(fact), history, as_of))
    customers = store("customer_class_totals", aggregates.customer_class_totals(fact), n=None)
    store("rwa_statistics", aggregates.statistics_of(summary))
    store("geographic_concentration", aggregates.geo_concentration_of(summary))
    store("pillar1", aggregates.pillar1_of(summary))
    store("regulatory_exposure_class", aggregates.exposure_class_of(customers))
    store("top_customers", aggregates.top_customers_of(customers))
    store("kpi_dashboard", aggregates.daily_kpis_of(customers))
    return out


def export(fact: DataFrame, summary: DataFrame, plan: Plan, as_of: dt.date) -> None:
    """Warehouse-ready files of the day, in warehouse types."""
    typed = writers.to_warehouse_types(fact.withColumn("basel_version", F.lit(plan.settings.version)))
    writers.replace_slice(typed, plan.path("warehouse", "rwa_calculations"), DATE, as_of)
    typed = writers.to_warehouse_types(summary, schemas.WAREHOUSE_SUMMARY)
    writers.replace_slice(typed, plan.path("warehouse", "rwa_summary"), DATE, as_of, n=1)


def reconcile_day(
    totals: DataFrame, loans: DataFrame, fx: DataFrame, plan: Plan, as_of: dt.date
) -> DataFrame:
    """Compare the stored result with its source and with the day before; store the outcome.

    ``totals`` are the stored customer-class totals of all days; the fact is not read.
    """
    spark = totals.sparkSession
    today = totals.where(F.col(DATE) == F.lit(as_of))
    in_usd = to_reporting_ccy(
        loans, fx, "outstanding_balance", "outstanding_balance_usd", settings=plan.settings
    ).withColumn(DATE, F.lit(as_of))
    source = readers.source_totals(in_usd, DATE, "outstanding_balance_usd")
    by_class = in_usd.groupBy(DATE, "asset_class").agg(
        F.sum("outstanding_balance_usd").cast("double").alias("source_exposure")
    )
    outcomes = reconcile.report(
        totals=reconcile.reconcile_totals_of(today, source),
        asset_class=reconcile.reconcile_asset_class_of(today, by_class),
        day_over_day=reconcile.day_over_day_of(totals, as_of),
    ).withColumnRenamed(DATE, "date")
    path = plan.path("reconciliation", "report")
    writers.write_report(outcomes, path, "json")
    stored = spark.read.schema("check_name string, item string, status string, date date").json(path)
    return stored.where(F.col("date") == F.lit(as_of)).withColumnRenamed("date", DATE)


def run(
    tables: dict[str, DataFrame],
    as_of: dt.date,
    plan: Plan,
    created: dt.datetime | None = None,
) -> dict[str, object]:
    """Validate, standardise, calculate, aggregate, export and reconcile one day.

    ``tables`` holds raw loans, collateral, counterparty, ratings and fx. A rerun of
    a date replaces that date everywhere and nothing else.
    """
    if plan.check_sources:
        validate_sources(
            {k: tables[k] for k in ("loans", "collateral", "ratings")}, plan, as_of
        )
    staged = standardise_all(tables, plan, as_of)
    fact, metrics = calculate(staged, plan, as_of, created)
    validate_result(fact, plan, as_of)
    reports = aggregate(fact, plan, as_of)
    export(fact, reports["rwa_summary"], plan, as_of)
    totals = readers.read_fact(fact.sparkSession, plan.path("processed", "customer_class_totals"))
    outcomes = reconcile_day(totals, staged["loans"], staged["fx"], plan, as_of)
    return {"fact": fact, "metrics": metrics, "reports": reports, "reconciliation": outcomes}
