"""Reports over the per-loan fact. One scan and one hash aggregation each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone.functions.numeric import share
from keelstone.params import PILLAR1_REPORT

SUMMARY_KEYS = ["calculation_date", "asset_class", "geography", "rating_bucket"]


def _total(column: str, name: str) -> Column:
    return F.sum(column).alias(name)


def _mean(column: str, name: str) -> Column:
    return F.avg(F.col(column).cast("double")).alias(name)


def conditional_count(flag: str | Column, name: str) -> Column:
    """Number of rows for which ``flag`` is true."""
    return F.count_if(F.col(flag) if isinstance(flag, str) else flag).alias(name)


def _high_risk(name: str = "high_risk_count") -> Column:
    return conditional_count("high_risk_flag", name)


def validation_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_loans"),
        _total("outstanding_balance_usd", "total_exposure"),
        _total("risk_weighted_assets", "total_rwa"),
        _total("regulatory_capital", "total_capital"),
        _mean("risk_weight", "avg_risk_weight"),
        F.countDistinct("customer_id").alias("unique_customers"),
        _high_risk(),
    )


def statistics(fact: DataFrame) -> DataFrame:
    return fact.groupBy("asset_class", "geography", "rating_bucket").agg(
        F.count(F.lit(1)).alias("loan_count"),
        _total("outstanding_balance_usd", "total_exposure"),
        _total("risk_weighted_assets", "total_rwa"),
        _mean("risk_weight", "avg_risk_weight"),
        _total("regulatory_capital", "total_capital"),
        _mean("probability_of_default", "avg_pd"),
        _high_risk(),
    )


def with_ratios(df: DataFrame, capital: str = "total_regulatory_capital") -> DataFrame:
    exposure = F.col("total_exposure")
    return df.withColumns(
        {
            "capital_ratio": share(F.col(capital), exposure),
            "rwa_density": share(F.col("total_rwa"), exposure),
        }
    )


def summary(fact: DataFrame, keys: Sequence[str] = tuple(SUMMARY_KEYS)) -> DataFrame:
    measures = fact.groupBy(*keys).agg(
        F.count("loan_id").alias("loan_count"),
        _total("outstanding_balance_usd", "total_exposure"),
        _total("exposure_at_default", "total_ead"),
        _total("risk_weighted_assets", "total_rwa"),
        _total("regulatory_capital", "total_regulatory_capital"),
        _total("expected_loss", "total_expected_loss"),
        _mean("risk_weight", "avg_risk_weight"),
        _mean("probability_of_default", "avg_pd"),
        _mean("loss_given_default", "avg_lgd"),
        _high_risk(),
        _mean("data_quality_score", "avg_data_quality"),
    )
    return with_ratios(measures)


def pillar1(fact: DataFrame) -> DataFrame:
    """Total capital requirement per calculation date."""
    return fact.groupBy("calculation_date").agg(
        _total("risk_weighted_assets", "total_rwa"),
        _total("regulatory_capital", "total_capital_req"),
    ).withColumn("report_type", F.lit(PILLAR1_REPORT))


CUSTOMER_CLASS = ["calculation_date", "asset_class", "customer_id"]


def customer_class_totals(fact: DataFrame) -> DataFrame:
    """Totals per date, class and customer, from which customer reports are derived.

    Means travel as sums beside the number of loans. Distinct customers are plain
    rows here, so nothing above this level has to expand the fact.
    """
    return fact.groupBy(*CUSTOMER_CLASS).agg(
        _total("outstanding_balance_usd", "exposure"),
        _total("ead_after_crm", "after_crm"),
        _total("risk_weighted_assets", "rwa"),
        _total("regulatory_capital", "capital"),
        _total("risk_weight", "weights"),
        _total("data_quality_score", "scores"),
        F.count("loan_id").alias("loans"),
        _high_risk("high_risk"),
    )


def _mean_of(total: str, name: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum("loans")).alias(name)


def exposure_class(fact: DataFrame) -> DataFrame:
    """Report by exposure class, with loans and true obligors counted apart."""
    return exposure_class_of(customer_class_totals(fact))


def exposure_class_of(totals: DataFrame) -> DataFrame:
    """The exposure-class report from customer-class totals."""
    return totals.groupBy("calculation_date", "asset_class").agg(
        _total("exposure", "original_exposure"),
        _total("after_crm", "exposure_after_crm"),
        F.sum("rwa").alias("rwa"),
        _mean_of("weights", "average_risk_weight"),
        _total("loans", "loan_count"),
        F.count("customer_id").alias("obligors"),
    )


def top_customers_of(totals: DataFrame, k: int = 20) -> DataFrame:
    """Largest customers of one date from customer-class totals."""
    per_customer = totals.groupBy("customer_id").agg(
        _total("rwa", "customer_rwa"),
        _total("exposure", "customer_exposure"),
        _total("loans", "loan_count"),
    )
    return top_k(per_customer, "customer_rwa", "customer_id", k)


def daily_kpis_of(totals: DataFrame) -> DataFrame:
    """Dashboard measures per date from customer-class totals.

    Trusts (date, loan) to be the key of the fact, like ``daily_kpis`` with "keyed".
    """
    measures = totals.groupBy("calculation_date").agg(
        _total("loans", "total_loans"),
        F.countDistinct("customer_id").alias("unique_customers"),
        _total("exposure", "total_exposure"),
        _total("rwa", "total_rwa"),
        _total("capital", "total_capital"),
        _mean_of("weights", "avg_risk_weight"),
        _total("high_risk", "high_risk_loans"),
        _mean_of("scores", "avg_data_quality"),
    )
    return with_ratios(measures, "total_capital")


def statistics_of(summary_rows: DataFrame) -> DataFrame:
    """The monitoring statistics of one date: columns of its summary."""
    return summary_rows.select(
        "asset_class", "geography", "rating_bucket", "loan_count", "total_exposure", "total_rwa",
        "avg_risk_weight", F.col("total_regulatory_capital").alias("total_capital"), "avg_pd",
        "high_risk_count",
    )


def geo_concentration_of(summary_rows: DataFrame) -> DataFrame:
    return summary_rows.groupBy("calculation_date", "geography").agg(
        _total("total_rwa", "geo_rwa"), _total("total_exposure", "geo_exposure")
    )


def pillar1_of(summary_rows: DataFrame) -> DataFrame:
    return summary_rows.groupBy("calculation_date").agg(
        F.sum("total_rwa").alias("total_rwa"),
        _total("total_regulatory_capital", "total_capital_req"),
    ).withColumn("report_type", F.lit(PILLAR1_REPORT))


def geo_concentration(fact: DataFrame) -> DataFrame:
    return fact.groupBy("calculation_date", "geography").agg(
        _total("risk_weighted_assets", "geo_rwa"),
        _total("outstanding_balance_usd", "geo_exposure"),
    )


def customer_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(
        _total("risk_weighted_assets", "customer_rwa"),
        _total("outstanding_balance_usd", "customer_exposure"),
        F.count("loan_id").alias("loan_count"),
    )


def top_k(df: DataFrame, by: str | Column, key: str, k: int = 20) -> DataFrame:
    """The ``k`` largest rows by ``by``; equal values are ordered by ``key``."""
    order = F.col(by) if isinstance(by, str) else by
    return df.orderBy(order.desc(), F.col(key)).limit(k)


def top_customers(fact: DataFrame, k: int = 20) -> DataFrame:
    """Largest customers of one calculation date."""
    return top_k(customer_totals(fact), "customer_rwa", "customer_id", k)


def kpi_summary(fact: DataFrame) -> DataFrame:
    """All dashboard numbers of every date in the frame, in one aggregation."""
    return fact.groupBy("calculation_date").agg(
        _total("risk_weighted_assets", "total_rwa"),
        _total("regulatory_capital", "total_capital"),
        _total("outstanding_balance_usd", "total_exposure"),
        F.count("loan_id").alias("total_loans"),
        F.countDistinct("customer_id").alias("total_customers"),
        _high_risk("high_risk_loans"),
        _mean("risk_weight", "avg_risk_weight"),
    )


def daily_kpis(fact: DataFrame, distinct: str = "exact") -> DataFrame:
    """Dashboard measures per date.

    distinct: "exact" counts loans and customers exactly, "approx" by sketch,
    "keyed" trusts (date, loan) to be the key of the fact and only counts
    customers distinctly, which saves shuffling every loan id.
    """
    loans, customers = {
        "exact": (F.countDistinct("loan_id"), F.countDistinct("customer_id")),
        "approx": (F.approx_count_distinct("loan_id"), F.approx_count_distinct("customer_id")),
        "keyed": (F.count("loan_id"), F.countDistinct("customer_id")),
    }[distinct]
    measures = fact.groupBy("calculation_date").agg(
        loans.alias("total_loans"),
        customers.alias("unique_customers"),
        _total("outstanding_balance_usd", "total_exposure"),
        _total("risk_weighted_assets", "total_rwa"),
        _total("regulatory_capital", "total_capital"),
        _mean("risk_weight", "avg_risk_weight"),
        _high_risk("high_risk_loans"),
        _mean("data_quality_score", "avg_data_quality"),
    )
    return with_ratios(measures, "total_capital")


def recon_totals(fact: DataFrame, distinct: str = "keyed") -> DataFrame:
    """Control totals of the calculated side per date; NULL sums count as 0.

    distinct: "keyed" trusts (date, loan) to be the key of the fact, reduces it to one
    row per customer and class, and counts customers there; "exact" counts loans
    distinctly too, which shuffles every loan id; "approx" counts both by sketch.
    """
    if distinct == "keyed":
        return recon_totals_of(customer_day_totals(fact))
    count = {"exact": F.countDistinct, "approx": F.approx_count_distinct}[distinct]
    zero = F.lit(0.0)
    return fact.groupBy("calculation_date").agg(
        F.coalesce(F.sum("outstanding_balance_usd").cast("double"), zero).alias("total_exposure"),
        F.coalesce(F.sum("risk_weighted_assets").cast("double"), zero).alias("total_rwa"),
        F.coalesce(F.sum("regulatory_capital").cast("double"), zero).alias("total_capital"),
        count("loan_id").alias("loan_count"),
        count("customer_id").alias("customer_count"),
    )


def customer_day_totals(fact: DataFrame) -> DataFrame:
    """What reconciliation needs of each date and customer."""
    return fact.groupBy("calculation_date", "customer_id").agg(
        _total("outstanding_balance_usd", "exposure"),
        _total("risk_weighted_assets", "rwa"),
        _total("regulatory_capital", "capital"),
        F.count("loan_id").alias("loans"),
    )


def recon_totals_of(totals: DataFrame) -> DataFrame:
    """The control totals from customer totals, by class or not."""
    zero = F.lit(0.0)

    def total(column):
        return F.coalesce(F.sum(column).cast("double"), zero)

    customers = totals.groupBy("calculation_date", "customer_id").agg(
        *(F.sum(c).alias(c) for c in ("exposure", "rwa", "capital", "loans"))
    )
    return customers.groupBy("calculation_date").agg(
        total("exposure").alias("total_exposure"),
        total("rwa").alias("total_rwa"),
        total("capital").alias("total_capital"),
        _total("loans", "loan_count"),
        F.count("customer_id").alias("customer_count"),
    )


def by_asset_class_of(totals: DataFrame, keys: Sequence[str] = ("asset_class",)) -> DataFrame:
    """Totals by class from customer-class totals."""
    return totals.groupBy(*keys).agg(
        _total("exposure", "calculated_exposure"),
        _total("rwa", "calculated_rwa"),
        _total("loans", "loan_count"),
    )


def by_asset_class(fact: DataFrame, keys: Sequence[str] = ("asset_class",)) -> DataFrame:
    return fact.groupBy(*keys).agg(
        _total("outstanding_balance_usd", "calculated_exposure"),
        _total("risk_weighted_assets", "calculated_rwa"),
        F.count(F.lit(1)).alias("loan_count"),
    )


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


REPORT_LEVELS = {
    "total": [],
    "asset_class": ["asset_class"],
    "geography": ["geography"],
    "detail": ["asset_class", "geography", "rating_bucket"],
}


def multi_level(fact: DataFrame) -> DataFrame:
    """All report levels from one scan of the fact.

    The fact is first reduced to its finest level; only that small result is
    expanded by the grouping sets. Averages travel as sum and count.
    """
    dims = REPORT_LEVELS["detail"]
    finest = fact.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("loans"),
        _total("outstanding_balance_usd", "exposure"),
        _total("risk_weighted_assets", "rwa"),
        _total("regulatory_capital", "capital"),
        _total("risk_weight", "weights"),
        _high_risk("high"),
    )
    level = F.grouping_id()
    # bit 2: asset class rolled up, bit 1: geography, bit 0: bucket
    name = (
        F.when(level == 7, "total")
        .when(level == 3, "asset_class")
        .when(level == 5, "geography")
        .otherwise("detail")
    )
    return finest.groupingSets([[F.col(c) for c in s] for s in REPORT_LEVELS.values()], *dims).agg(
        name.alias("level"),
        _total("loans", "loan_count"),
        _total("exposure", "total_exposure"),
        _total("rwa", "total_rwa"),
        _total("capital", "total_capital"),
        F.try_divide(F.sum("weights").cast("double"), F.sum("loans")).alias("avg_risk_weight"),
        _total("high", "high_risk_count"),
    )


def portfolio_profile(loans: DataFrame) -> DataFrame:
    """Size, balance and collateral share of a portfolio."""
    balance = F.col("outstanding_balance").cast("double")
    return loans.agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum(balance).alias("total_balance"),
        F.avg(balance).alias("avg_balance"),
        F.count("collateral_id").alias("with_collateral"),
        F.try_divide(F.count("collateral_id") * F.lit(100.0), F.count(F.lit(1))).alias(
            "with_collateral_pct"
        ),
    )


def mix(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column`` and their share in percent.

    The values are counted first; the total is the sum of those counts.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.select(
        F.lit(column).alias("attribute"),
        "value",
        "row_count",
        F.try_divide(F.col("row_count") * F.lit(100.0), total).alias("pct"),
    )


def skew_profile(loans: DataFrame, key: str = "customer_id", threshold: int = 100) -> DataFrame:
    """Loans per customer: largest, mean, and how many customers exceed the threshold."""
    counts = loans.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.max("n").alias("max_loans"),
        F.avg("n").alias("avg_loans"),
        F.count_if(F.col("n") > threshold).alias("hot_customers"),
    )
