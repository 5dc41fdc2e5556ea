"""Quality and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.catalog.book import Book, rounded
from keelstone.catalog.joins import MOVES_SQL, scaled_source
from keelstone.catalog.sqlparts import sql
from keelstone.operators import aggregates as agg, quality as q, reconcile as rc
from keelstone.operators import standardise as std, suites, trend
from keelstone.sinks import writers
from keelstone.sinks.scratch import new_path
from keelstone.sources import testviews as tv

book = Book()

RESULT = ["check_type", "table_name", "item", "is_valid", "metric"]


def shown(results, digits: int = 6):
    return rounded(results.select(*RESULT), {"metric": digits})


def raw_loans(spark, d):
    return tv.loans(spark, d, raw=True, with_customer=False)


def classified(spark, d):
    """Raw loans with their asset class, nothing filtered."""
    loans = std.normalise_codes(raw_loans(spark, d), upper=["product_type"])
    return std.with_asset_class(loans)


ROWS_SQL = "SELECT 'row_count_check' AS check_type, '{t}' AS table_name, 'rows' AS item, " \
    "count(*) BETWEEN {low} AND {high} AS is_valid, CAST(count(*) AS DOUBLE) AS metric FROM {src}"


def null_sql(table: str, source: str, column: str, limit: float) -> str:
    pct = f"100e0 * count(*) FILTER (WHERE {column} IS NULL) / count(*)"
    return (
        f"SELECT 'null_check' AS check_type, '{table}' AS table_name, '{column}' AS item, "
        f"{pct} <= {limit} AS is_valid, round({pct}, 6) AS metric FROM {source}"
    )


def rule_sql(table: str, source: str, name: str, condition: str) -> str:
    return (
        f"SELECT 'business_rules' AS check_type, '{table}' AS table_name, '{name}' AS item, "
        f"count(*) FILTER (WHERE NOT ({condition})) = 0 AS is_valid, "
        f"CAST(count(*) FILTER (WHERE NOT ({condition})) AS DOUBLE) AS metric FROM {source}"
    )


@book.query(
    "dq_schema",
    """WITH given AS (
        SELECT typeof(o_orderkey) AS k, typeof(o_custkey) AS c, typeof(o_orderdate) AS t,
          typeof(o_orderpriority) AS s FROM orders LIMIT 1),
      loans(item, kind, wanted) AS (
        SELECT unnest(['loan_id', 'customer_id', 'product_type', 'origination_date', 'maturity_date',
            'outstanding_balance', 'currency', 'internal_rating', 'country_code', 'collateral_id',
            'exposure_at_default']),
          unnest([s, c, s, CASE WHEN t LIKE 'TIMESTAMP%' THEN 'DATE' END, 'DATE', 'DECIMAL', s, s, s, k, NULL]),
          unnest(['VARCHAR', 'VARCHAR', 'VARCHAR', 'DATE', 'DATE', 'DOUBLE', 'VARCHAR', 'VARCHAR',
            'VARCHAR', 'VARCHAR', 'DOUBLE']) FROM given)
    SELECT 'schema_validation' AS check_type, 'loans' AS table_name, item,
      coalesce(kind = wanted, FALSE) AS is_valid,
      CASE WHEN kind = wanted THEN 0e0 ELSE 1e0 END AS metric FROM loans
    UNION ALL SELECT 'row_count_check', 'loans', 'rows', count(*) >= 1, CAST(count(*) AS DOUBLE)
      FROM orders""",
)
def schema(spark, d):
    """The loan view, with the types of the given orders, against the bronze schema, and its rows."""
    loans = tv.loans(spark, d)
    found = q.validate_schema(loans, schemas.LOANS, "loans")
    return shown(q.log_results(found, q.run_checks(raw_loans(spark, d), "loans", [q.RowCount(1, 2**62)])))


NULL_COLUMNS = ["loan_id", "internal_rating", "collateral_id"]


@book.query(
    "dq_nulls",
    sql(
        " UNION ALL ".join(null_sql("loans", "loans_raw", c, 20.0) for c in NULL_COLUMNS), "loans_raw"
    ),
)
def nulls(spark, d):
    check = q.Nulls([*NULL_COLUMNS, "no_such_column"], 20.0)
    return shown(q.run_checks(raw_loans(spark, d), "loans", [check]))


@book.query(
    "dq_duplicates",
    """SELECT 'duplicate_check' AS check_type, 'lineitem' AS table_name,
      'l_orderkey,l_linenumber' AS item, count(*) = 0 AS is_valid, CAST(count(*) AS DOUBLE) AS metric
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def duplicates(spark, d):
    check = q.Unique(["l_orderkey", "l_linenumber"])
    return shown(q.run_checks(tv.table(spark, d, "lineitem"), "lineitem", [check]))


RULES = [
    suites.POSITIVE_BALANCE,
    q.Rule("matures_later", "maturity_date > origination_date"),
    q.Rule("rated_well", "internal_rating IN ('AAA', 'AA-', 'A+')"),
]


@book.query(
    "dq_rules",
    sql(
        " UNION ALL ".join(rule_sql("loans", "loans_raw", r.name, r.condition) for r in RULES),
        "loans_raw",
    ),
)
def rules(spark, d):
    return shown(q.run_checks(raw_loans(spark, d), "loans", [q.Rules(RULES)]))


@book.query(
    "dq_rules_unknown",
    sql(
        """SELECT 'rated_well' AS item, CAST(count(*) FILTER (WHERE internal_rating IS NULL)
          AS BIGINT) AS unknown FROM loans_raw""",
        "loans_raw",
    ),
)
def rules_unknown(spark, d):
    """Rows a rule could not decide, which count neither way."""
    found = q.run_checks(raw_loans(spark, d), "loans", [q.Rules(RULES)])
    return found.where(F.col("item") == "rated_well").select(
        "item", F.col("detail")["unknown"].cast("long").alias("unknown")
    )


@book.query(
    "dq_row_count",
    sql(
        ROWS_SQL.format(t="loans", low=100, high=10_000_000, src="loans_raw") + " UNION ALL "
        + ROWS_SQL.format(t="collateral", low=40_000_000, high=50_000_000, src="collateral"),
        "loans_raw", "collateral",
    ),
)
def row_count(spark, d):
    return shown(
        q.log_results(
            q.run_checks(raw_loans(spark, d), "loans", [q.RowCount(100, 10_000_000)]),
            q.run_checks(tv.collateral(spark, d), "collateral", [q.RowCount(40_000_000, 50_000_000)]),
        )
    )


def anomaly_sql(column: str, k: float) -> str:
    return f"""SELECT 'anomaly_detection' AS check_type, 'collateral' AS table_name,
      '{column}' AS item, count(*) FILTER (WHERE x < lo OR x > hi) = 0 AS is_valid,
      CAST(count(*) FILTER (WHERE x < lo OR x > hi) AS DOUBLE) AS metric,
      round(min(m), 4) AS mean, round(min(s), 4) AS std
    FROM (SELECT {column} AS x FROM clean_collateral),
      (SELECT avg({column}) AS m, stddev_samp({column}) AS s, avg({column}) - {k} * stddev_samp({column})
        AS lo, avg({column}) + {k} * stddev_samp({column}) AS hi FROM clean_collateral)"""


@book.query(
    "dq_anomalies",
    sql(
        anomaly_sql("market_value", 1.6) + " UNION ALL " + anomaly_sql("haircut_percentage", 3.0)
        .replace("3.0 *", "1.6 *"),
        "clean_collateral",
    ),
)
def anomalies(spark, d):
    check = q.Anomalies(["market_value", "haircut_percentage"], 1.6)
    found = q.run_checks(tv.clean_collateral(spark, d), "collateral", [check])
    out = found.select(
        *RESULT,
        F.col("detail")["mean"].cast("double").alias("mean"),
        F.col("detail")["std"].cast("double").alias("std"),
    )
    return rounded(out, {"metric": 6, "mean": 4, "std": 4})


@book.query(
    "dq_reconcile_sum",
    sql(
        """SELECT 'reconciliation' AS check_type, 'loans' AS table_name,
          'outstanding_balance' AS item, pct <= 0.01e0 AS is_valid, round(pct, 6) AS metric
        FROM (SELECT abs(sum(CAST(outstanding_balance AS DOUBLE)) - 2.5e9) / 2.5e9 * 100 AS pct
          FROM loans_plain)""",
        "loans_plain",
    ),
)
def reconcile_sum(spark, d):
    loans = tv.loans(spark, d, with_customer=False)
    check = q.SumMatches("outstanding_balance", 2_500_000_000.0, 0.01)
    return shown(q.run_checks(loans, "loans", [check]))


SUITE_RANGES = {
    "loan_rows": (100, 10_000_000), "collateral_rows": (100, 10_000_000),
    "rating_rows": (400_000, 600_000),
}
VALID_CLASS_SQL = "asset_class IN ('CORPORATE_LARGE','CORPORATE_SME','RETAIL_MORTGAGE','RETAIL_OTHER')"
CLASSIFIED = """SELECT *, CASE WHEN upper(trim(product_type)) IN ('MORTGAGE','HOME_LOAN')
    THEN 'RETAIL_MORTGAGE' WHEN upper(trim(product_type)) IN ('PERSONAL_LOAN','CREDIT_CARD')
    THEN 'RETAIL_OTHER' WHEN upper(trim(product_type)) = 'SME_LOAN' THEN 'CORPORATE_SME'
    WHEN upper(trim(product_type)) = 'CORPORATE_LOAN' THEN 'CORPORATE_LARGE' ELSE 'OTHER' END
    AS asset_class FROM loans_raw"""
SUITE_SQL = " UNION ALL ".join(
    [
        ROWS_SQL.format(t="loans", low=100, high=10_000_000, src="loans_raw"),
        *[
            null_sql("loans", f"({CLASSIFIED})", c, 0.1)
            for c in ("loan_id", "customer_id", "outstanding_balance", "asset_class")
        ],
        """SELECT 'duplicate_check', 'loans', 'loan_id', count(*) = 0, CAST(count(*) AS DOUBLE)
        FROM (SELECT loan_id FROM loans_raw GROUP BY 1 HAVING count(*) > 1)""",
        rule_sql("loans", f"({CLASSIFIED})", "positive_balance", "outstanding_balance > 0"),
        rule_sql("loans", f"({CLASSIFIED})", "valid_asset_class", VALID_CLASS_SQL),
        ROWS_SQL.format(t="collateral", low=100, high=10_000_000, src="collateral"),
        *[null_sql("collateral", "collateral", c, 0.1) for c in ("collateral_id", "market_value")],
        ROWS_SQL.format(t="ratings", low=400_000, high=600_000, src="ratings"),
        *[null_sql("ratings", "ratings", c, 0.0) for c in ("customer_id", "rating")],
    ]
)
SUITE_PARTS = ("loans_raw", "collateral", "ratings")


def suite_results(spark, d):
    tables = {
        "loans": classified(spark, d), "collateral": tv.collateral(spark, d),
        "ratings": tv.ratings(spark, d),
    }
    return suites.run_source_suite(tables, **SUITE_RANGES)


@book.query("dq_source_suite", sql(SUITE_SQL, *SUITE_PARTS))
def source_suite(spark, d):
    return shown(suite_results(spark, d))


@book.query(
    "dq_result_log",
    sql(
        f"""SELECT check_type, table_name, count(*) AS results, bool_and(is_valid) AS all_valid
        FROM ({SUITE_SQL}) GROUP BY 1, 2""",
        *SUITE_PARTS,
    ),
)
def result_log(spark, d):
    return suite_results(spark, d).groupBy("check_type", "table_name").agg(
        F.count(F.lit(1)).alias("results"), F.bool_and("is_valid").alias("all_valid")
    )


SUMMARY_SQL = f"""SELECT count(*) AS total_checks, count(*) FILTER (WHERE ok) AS passed,
    count(*) FILTER (WHERE NOT ok) AS failed,
    round(100e0 * count(*) FILTER (WHERE ok) / count(*), 4) AS pass_rate
  FROM (SELECT check_type, table_name, bool_and(is_valid) AS ok FROM ({SUITE_SQL}) GROUP BY 1, 2)"""


@book.query("dq_summary", sql(SUMMARY_SQL, *SUITE_PARTS))
def summary(spark, d):
    return rounded(q.summary(suite_results(spark, d)), {"pass_rate": 4})


@book.query(
    "dq_gate",
    sql(
        f"SELECT *, CASE WHEN failed = 0 THEN 'OPEN' ELSE 'CLOSED' END AS gate FROM ({SUMMARY_SQL})",
        *SUITE_PARTS,
    ),
)
def gate(spark, d):
    return rounded(q.gate_status(suite_results(spark, d)), {"pass_rate": 4})


@book.query(
    "dq_calc_invariants",
    sql(
        """SELECT 'calculation_invariants' AS check_type, 'rwa_detail' AS table_name, v.* FROM
        (SELECT sum(risk_weighted_assets) AS rwa, sum(outstanding_balance_usd) AS ex,
          avg(risk_weight) AS w FROM fact) t,
        LATERAL (VALUES ('positive_rwa', t.rwa > 0, round(t.rwa, 2)),
          ('positive_weight', t.w > 0, round(t.w, 2)),
          ('plausible_rwa', t.rwa <= t.ex * 1.5, round(t.rwa / t.ex, 2))) v(item, is_valid, metric)""",
        "fact",
    ),
)
def calc_invariants(spark, d):
    return shown(q.calc_invariants(tv.fact(spark, d)), 2)


QUARANTINE_RULES = [
    suites.POSITIVE_BALANCE, q.Rule("unmatured", "maturity_date > DATE'2001-08-01'"),
]


@book.query(
    "dq_quarantine",
    sql(
        """SELECT loan_id, reasons FROM (SELECT loan_id, concat_ws(',',
            CASE WHEN NOT (outstanding_balance > 0) THEN 'positive_balance' END,
            CASE WHEN NOT (maturity_date > DATE '2001-08-01') THEN 'unmatured' END,
            CASE WHEN regexp_extract(loan_id, '[0-9]+')::BIGINT % 101 = 0 THEN 'cast_amount_text' END)
          AS reasons FROM loans_raw) WHERE reasons <> ''""",
        "loans_raw",
    ),
)
def quarantine(spark, d):
    """Loans that break a rule or whose amount, received as text, is not a number."""
    number = F.substring("loan_id", 2, 20).cast("long")
    text = F.when(number % 101 == 0, F.lit("n/a")).otherwise(
        F.col("outstanding_balance").cast("string")
    )
    received = raw_loans(spark, d).withColumn("amount_text", text)
    kept = q.quarantine(received, QUARANTINE_RULES, {"amount_text": "decimal(18,2)"})
    return kept.select("loan_id", F.array_join("reject_reasons", ",").alias("reasons"))


# Reconciliation ---------------------------------------------------------------------

TOTALS_SQL = """
  SELECT calculation_date, calculated_exposure, source_exposure, calculated_loan_count,
    source_loan_count, exposure_variance_pct,
    CASE WHEN exposure_variance_pct > 0.01e0 OR calculated_loan_count <> source_loan_count
      THEN 'FAILED' ELSE 'PASSED' END AS status
  FROM (SELECT *, CASE WHEN source_exposure > 0 THEN
      abs(calculated_exposure - source_exposure) / source_exposure * 100 END AS exposure_variance_pct
    FROM (SELECT calculation_date, sum(outstanding_balance_usd) AS calculated_exposure,
        count(DISTINCT loan_id) AS calculated_loan_count FROM fact_month GROUP BY 1)
    JOIN (SELECT run_date AS calculation_date, sum(outstanding_balance_usd) * {factor} AS source_exposure,
        count(*) AS source_loan_count FROM loans_usd_month GROUP BY 1) USING (calculation_date))"""
TOTALS_DIGITS = {"calculated_exposure": 2, "source_exposure": 2, "exposure_variance_pct": 4}
TOTALS_SELECT = """SELECT calculation_date, round(calculated_exposure, 2) AS calculated_exposure,
    round(source_exposure, 2) AS source_exposure, calculated_loan_count, source_loan_count,
    round(exposure_variance_pct, 4) AS exposure_variance_pct, status FROM"""


@book.query(
    "rc_totals",
    sql(f"{TOTALS_SELECT} ({TOTALS_SQL.format(factor='1.00005e0')})", "fact_month", "loans_usd_month"),
)
def totals(spark, d):
    out = rc.reconcile_totals(tv.fact(spark, d, "month"), scaled_source(spark, d, 1.00005))
    return rounded(out, TOTALS_DIGITS)


@book.query(
    "rc_totals_failing",
    sql(f"{TOTALS_SELECT} ({TOTALS_SQL.format(factor='1.01e0')})", "fact_month", "loans_usd_month"),
)
def totals_failing(spark, d):
    out = rc.reconcile_totals(tv.fact(spark, d, "month"), scaled_source(spark, d, 1.01))
    return rounded(out, TOTALS_DIGITS)


DAYS_SQL = """
  SELECT calculation_date, calculation_date - 1 AS previous_date, current_rwa, previous_rwa,
    rwa_change_pct, exposure_change_pct,
    CASE WHEN rwa_change_pct IS NULL THEN 'SKIPPED' WHEN abs(rwa_change_pct) > 10 THEN 'WARNING'
      ELSE 'PASSED' END AS status
  FROM (SELECT a.calculation_date, a.rwa AS current_rwa, b.rwa AS previous_rwa,
      (a.rwa - b.rwa) / nullif(b.rwa, 0) * 100 AS rwa_change_pct,
      (a.ex - b.ex) / nullif(b.ex, 0) * 100 AS exposure_change_pct
    FROM (SELECT calculation_date, sum(risk_weighted_assets) AS rwa,
        sum(outstanding_balance_usd) AS ex FROM fact_day GROUP BY 1) a
    LEFT JOIN (SELECT calculation_date, sum(risk_weighted_assets) AS rwa,
        sum(outstanding_balance_usd) AS ex FROM fact_day GROUP BY 1) b
      ON b.calculation_date = a.calculation_date - 1)"""


@book.query(
    "rc_day_over_day",
    sql(
        f"""SELECT calculation_date, previous_date, round(current_rwa, 2) AS current_rwa,
          round(previous_rwa, 2) AS previous_rwa, round(rwa_change_pct, 4) AS rwa_change_pct,
          round(exposure_change_pct, 4) AS exposure_change_pct, status FROM ({DAYS_SQL})""",
        "fact_day",
    ),
)
def day_over_day(spark, d):
    out = rc.day_over_day(tv.fact(spark, d, "day"))
    digits = {"current_rwa": 2, "previous_rwa": 2, "rwa_change_pct": 4, "exposure_change_pct": 4}
    return rounded(out, digits)


CLASS_SQL = """
  SELECT calculation_date, asset_class, calculated_exposure, calculated_rwa, loan_count,
    source_exposure, variance_pct,
    CASE WHEN variance_pct > 0.1e0 THEN 'FAILED' ELSE 'PASSED' END AS status
  FROM (SELECT c.*, s.source_exposure,
      abs(c.calculated_exposure - s.source_exposure) / s.source_exposure * 100 AS variance_pct
    FROM (SELECT calculation_date, asset_class, sum(outstanding_balance_usd) AS calculated_exposure,
        sum(risk_weighted_assets) AS calculated_rwa, count(*) AS loan_count
      FROM fact_month GROUP BY 1, 2) c
    JOIN (SELECT run_date AS calculation_date, asset_class,
        sum(outstanding_balance_usd) * 1.0005e0 AS source_exposure
      FROM loans_usd_month GROUP BY 1, 2) s
    ON s.calculation_date = c.calculation_date AND s.asset_class = c.asset_class)"""


@book.query(
    "rc_asset_class",
    sql(
        f"""SELECT calculation_date, asset_class, round(calculated_exposure, 2) AS calculated_exposure,
          round(calculated_rwa, 2) AS calculated_rwa, loan_count,
          round(source_exposure, 2) AS source_exposure, round(variance_pct, 4) AS variance_pct, status
        FROM ({CLASS_SQL})""",
        "fact_month", "loans_usd_month",
    ),
)
def asset_class(spark, d):
    out = rc.reconcile_asset_class(
        tv.fact(spark, d, "month"), scaled_source(spark, d, 1.0005, by_class=True)
    )
    digits = {"calculated_exposure": 2, "calculated_rwa": 2, "source_exposure": 2, "variance_pct": 4}
    return rounded(out, digits)


@book.query(
    "rc_top_movers",
    sql(
        f"""SELECT customer_id, round(current_rwa, 2) AS current_rwa,
          round(previous_rwa, 2) AS previous_rwa, round(rwa_change, 2) AS rwa_change,
          round(change_pct, 4) AS change_pct
        FROM ({MOVES_SQL.format(grain='day', now='2001-07-31', before='2001-07-30')})
        ORDER BY abs(rwa_change) DESC, customer_id LIMIT 20""",
        "fact_day",
    ),
)
def top_movers(spark, d):
    """Largest moves between the last day but one and the calendar day before it."""
    out = trend.top_movers(tv.fact(spark, d, "day"), tv.AS_OF.replace(month=7, day=31))
    return rounded(out, {"current_rwa": 2, "previous_rwa": 2, "rwa_change": 2, "change_pct": 4})


def outcomes(spark, d):
    """All checks of a month and of its days, each grain's totals computed once and stored."""
    month, day = (stored_totals(spark, d, grain) for grain in ("month", "day"))
    source = stored_source(spark, d)
    total = source.groupBy("calculation_date").agg(
        (F.sum("source_exposure") * 1.00005).alias("source_exposure"),
        F.sum("source_loan_count").alias("source_loan_count"),
    )
    by_class = source.withColumn("source_exposure", F.col("source_exposure") * 1.0005)
    return rc.report(
        totals=rc.reconcile_totals_of(month, total),
        asset_class=rc.reconcile_asset_class_of(month, by_class),
        day_over_day=rc.day_over_day_of(day),
    )


def stored_totals(spark, d, grain):
    path = new_path(spark, f"totals_{grain}")
    writers.write_table(agg.customer_class_totals(tv.fact(spark, d, grain)), path)
    return spark.read.parquet(path)


def stored_source(spark, d):
    path = new_path(spark, "source_totals")
    writers.write_table(scaled_source(spark, d, by_class=True), path)
    return spark.read.parquet(path)


OUTCOMES_SQL = f"""
  SELECT 'totals' AS check_name, calculation_date, 'total' AS item, status
    FROM ({TOTALS_SQL.format(factor='1.00005e0')})
  UNION ALL SELECT 'asset_class', calculation_date, asset_class, status FROM ({CLASS_SQL})
  UNION ALL SELECT 'day_over_day', calculation_date, 'total', status FROM ({DAYS_SQL})"""
OUTCOME_PARTS = ("fact_month", "loans_usd_month", "fact_day")


@book.query("rc_report", sql(OUTCOMES_SQL, *OUTCOME_PARTS))
def report(spark, d):
    return outcomes(spark, d)


@book.query(
    "rc_summary",
    sql(
        f"""SELECT calculation_date, count(*) AS total_checks,
          count(*) FILTER (WHERE status = 'PASSED') AS passed,
          count(*) FILTER (WHERE status = 'FAILED') AS failed,
          count(*) FILTER (WHERE status = 'WARNING') AS warnings,
          count(*) FILTER (WHERE status = 'SKIPPED') AS skipped,
          CASE WHEN bool_and(status <> 'FAILED') THEN 'PASSED' ELSE 'FAILED' END AS overall_status
        FROM ({OUTCOMES_SQL}) GROUP BY 1""",
        *OUTCOME_PARTS,
    ),
)
def recon_summary(spark, d):
    return rc.summary(outcomes(spark, d))
