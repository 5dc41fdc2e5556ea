"""Standardisation and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.catalog.book import Book, plain
from keelstone.catalog.sqlparts import RUN, sql
from keelstone.functions.codes import recode
from keelstone.operators import filters, standardise as std
from keelstone.sources import testviews as tv

book = Book()

RATING_COLUMNS = "customer_id, rating_agency, rating, rating_date, rating_numeric"


@book.query(
    "std_cast_decimal",
    sql(
        """SELECT collateral_id, CAST(CAST(market_value AS DECIMAL(18,2)) AS DOUBLE) AS market_value,
        CAST(CAST(haircut_percentage AS DECIMAL(5,4)) AS DOUBLE) AS haircut_percentage
        FROM collateral""",
        "collateral",
    ),
)
def cast_decimal(spark, d):
    raw = tv.collateral(spark, d).select("collateral_id", "market_value", "haircut_percentage")
    types = {"market_value": schemas.MONEY, "haircut_percentage": schemas.RATIO}
    return plain(std.cast_cols(raw, types))


@book.query(
    "std_trim_upper",
    sql(
        "SELECT upper(trim(product_type)) AS product_type, currency, country_code, "
        "count(*) AS row_count FROM loans_raw GROUP BY ALL",
        "loans_raw",
    ),
)
def trim_upper(spark, d):
    codes = ["product_type", "currency", "country_code"]
    clean = std.normalise_codes(tv.loans(spark, d, raw=True), upper=codes)
    return clean.groupBy(*codes).agg(F.count(F.lit(1)).alias("row_count"))


@book.query(
    "std_trim",
    sql(
        "SELECT trim(product_type) AS product_type, trim(internal_rating) AS internal_rating, "
        "count(*) AS row_count FROM loans_raw GROUP BY ALL",
        "loans_raw",
    ),
)
def trim(spark, d):
    raw = tv.loans(spark, d, raw=True, with_customer=False)
    clean = std.normalise_codes(raw, trim_only=["product_type", "internal_rating"])
    return clean.groupBy("product_type", "internal_rating").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@book.query(
    "std_days_between",
    sql(
        f"""SELECT 'loan' AS kind, loan_id AS id, maturity_date - {RUN} AS days_left,
          {RUN} - origination_date AS age_days FROM loans_raw
        UNION ALL SELECT 'collateral', CAST(collateral_id AS VARCHAR), NULL, {RUN} - valuation_date
        FROM collateral""",
        "loans_raw", "collateral",
    ),
)
def days_between(spark, d):
    loans = std.with_tenor(tv.loans(spark, d, with_customer=False), tv.AS_OF).select(
        F.lit("loan").alias("kind"),
        F.col("loan_id").alias("id"),
        F.col("days_to_maturity").cast("long").alias("days_left"),
        F.col("loan_age_days").cast("long").alias("age_days"),
    )
    collateral = std.with_valuation_age(tv.collateral(spark, d), tv.AS_OF).select(
        F.lit("collateral").alias("kind"),
        F.col("collateral_id").cast("string").alias("id"),
        F.lit(None).cast("long").alias("days_left"),
        F.col("days_since_valuation").cast("long").alias("age_days"),
    )
    return loans.unionByName(collateral)


@book.query(
    "std_asset_class",
    sql(
        "SELECT product_type, asset_class, count(*) AS row_count FROM clean_loans GROUP BY ALL",
        "clean_loans",
    ),
)
def asset_class(spark, d):
    return tv.clean_loans(spark, d).groupBy("product_type", "asset_class").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@book.query(
    "std_haircut",
    sql(
        "SELECT collateral_id, haircut_percentage, adjusted_collateral_value FROM clean_collateral",
        "clean_collateral",
    ),
)
def haircut(spark, d):
    types = {"market_value": schemas.MONEY, "haircut_percentage": schemas.RATIO}
    typed = std.cast_cols(tv.collateral(spark, d), types)
    return plain(
        std.apply_haircut(typed).select(
            "collateral_id", "haircut_percentage", "adjusted_collateral_value"
        )
    )


@book.query(
    "std_stale_flag",
    sql(
        "SELECT collateral_id, valuation_date, valuation_stale_flag FROM clean_collateral",
        "clean_collateral",
    ),
)
def stale_flag(spark, d):
    aged = std.with_valuation_age(tv.collateral(spark, d), tv.AS_OF)
    return std.flag_stale(aged).select("collateral_id", "valuation_date", "valuation_stale_flag")


@book.query(
    "std_rating_scale",
    sql(
        "SELECT rating, rating_numeric, count(*) AS row_count FROM ratings GROUP BY ALL", "ratings"
    ),
)
def rating_scale(spark, d):
    rated = std.with_rating_numeric(tv.ratings(spark, d))
    return rated.groupBy("rating", "rating_numeric").agg(F.count(F.lit(1)).alias("row_count"))


LOAN_COLUMNS = [
    "loan_id", "customer_id", "product_type", "origination_date", "maturity_date",
    "outstanding_balance", "internal_rating", "collateral_id", "currency", "country_code",
    "days_to_maturity", "loan_age_days", "asset_class",
]


def _days_as_long(df, *columns):
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


@book.query(
    "std_loans",
    sql(
        f"SELECT {', '.join(LOAN_COLUMNS)} FROM clean_loans".replace(
            "outstanding_balance", "CAST(outstanding_balance AS DOUBLE) AS outstanding_balance"
        ),
        "clean_loans",
    ),
)
def loans(spark, d):
    clean = plain(tv.clean_loans(spark, d).select(*LOAN_COLUMNS))
    return _days_as_long(clean, "days_to_maturity", "loan_age_days")


@book.query(
    "std_collateral", sql("SELECT * FROM clean_collateral", "clean_collateral")
)
def collateral(spark, d):
    return _days_as_long(plain(tv.clean_collateral(spark, d)), "days_since_valuation")


@book.query(
    "std_counterparty",
    sql(
        """SELECT customer_id, upper(trim(customer_type)) AS customer_type,
        CAST(CAST(total_assets AS DECIMAL(18,2)) AS DOUBLE) AS total_assets, country_code
        FROM counterparty""",
        "counterparty",
    ),
)
def counterparty(spark, d):
    return plain(std.standardise_counterparty(tv.counterparty(spark, d)))


@book.query("std_ratings", sql(f"SELECT {RATING_COLUMNS} FROM clean_ratings", "clean_ratings"))
def ratings(spark, d):
    return tv.clean_ratings(spark, d).select(*RATING_COLUMNS.split(", "))


# One rate per currency and month, made from the number of loans of that month.
FX_HISTORY_SQL = """
  SELECT CASE currency WHEN 'EUR' THEN 'EURUSD' WHEN 'GBP' THEN 'GBPUSD' WHEN 'JPY' THEN 'JPYUSD'
      ELSE 'CNYUSD' END AS currency_pair,
    CASE currency WHEN 'EUR' THEN 1.1e0 WHEN 'GBP' THEN 1.27e0 WHEN 'JPY' THEN 0.0067e0
      ELSE 0.14e0 END * (980 + count(*) % 41) / 1000e0 AS rate,
    CAST(date_trunc('month', origination_date) AS DATE) AS date
  FROM loans_plain WHERE currency <> 'USD' GROUP BY currency, date_trunc('month', origination_date)"""


def fx_history(spark, d):
    """FX rates that move with the given tables."""
    month = F.trunc("origination_date", "month")
    counted = (
        tv.loans(spark, d)
        .where(F.col("currency") != "USD")
        .groupBy("currency", month.alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rate = recode(F.col("currency"), {p[:3]: r for p, r in tv.FX_RATES}) * (980 + F.col("n") % 41) / F.lit(1000.0)
    return counted.select(
        F.concat(F.col("currency"), F.lit("USD")).alias("currency_pair"),
        rate.alias("rate"),
        "date",
        F.lit("DERIVED").alias("source"),
    )


@book.query(
    "std_fx",
    f"SELECT currency_pair, CAST(CAST(rate AS DECIMAL(18,8)) AS DOUBLE) AS rate, date FROM "
    f"({sql(FX_HISTORY_SQL, 'loans_plain')})",
)
def fx(spark, d):
    dirty = fx_history(spark, d).withColumn(
        "currency_pair", F.concat(F.lit(" "), F.lower("currency_pair"), F.lit(" "))
    )
    return plain(std.standardise_fx(dirty).select("currency_pair", "rate", "date"))


@book.query(
    "std_summary",
    sql(
        """SELECT 'loans' AS table_name, count(*) AS row_count FROM clean_loans
        UNION ALL SELECT 'collateral', count(*) FROM clean_collateral
        UNION ALL SELECT 'counterparty', count(*) FROM counterparty
        UNION ALL SELECT 'ratings', count(*) FROM clean_ratings""",
        "clean_loans", "clean_collateral", "counterparty", "clean_ratings",
    ),
)
def stage_summary(spark, d):
    return std.stage_counts(
        {
            "loans": tv.clean_loans(spark, d),
            "collateral": tv.clean_collateral(spark, d),
            "counterparty": std.standardise_counterparty(tv.counterparty(spark, d)),
            "ratings": tv.clean_ratings(spark, d),
        }
    )


# Filters ---------------------------------------------------------------------


@book.query(
    "flt_positive_balance",
    sql(
        """SELECT loan_id, CAST(outstanding_balance AS DOUBLE) AS outstanding_balance
        FROM loans_raw WHERE outstanding_balance > 0""",
        "loans_raw",
    ),
)
def positive_balance(spark, d):
    raw = tv.loans(spark, d, raw=True, with_customer=False)
    return plain(filters.positive_balance(raw).select("loan_id", "outstanding_balance"))


@book.query(
    "flt_unmatured",
    sql(f"SELECT loan_id, maturity_date FROM loans_raw WHERE maturity_date > {RUN}", "loans_raw"),
)
def unmatured(spark, d):
    raw = tv.loans(spark, d, with_customer=False)
    return filters.unmatured(raw, tv.AS_OF).select("loan_id", "maturity_date")


@book.query(
    "flt_date_slice",
    sql(
        """SELECT loan_id, customer_id, calculation_date FROM fact_month
        WHERE calculation_date = DATE '2001-07-01'""",
        "fact_month",
    ),
)
def date_slice(spark, d):
    day = tv.AS_OF.replace(month=7)
    month = tv.as_of_for("month")
    dated = tv.clean_loans(spark, d, month).withColumn("calculation_date", month)
    return filters.date_slice(dated, day).select("loan_id", "customer_id", "calculation_date")


@book.query(
    "flt_high_risk",
    sql("SELECT loan_id, risk_weight, probability_of_default FROM fact WHERE high_risk_flag", "fact"),
)
def high_risk(spark, d):
    return filters.high_risk_only(tv.fact(spark, d)).select(
        "loan_id", "risk_weight", "probability_of_default"
    )


@book.query(
    "flt_rule_violations",
    sql(
        """SELECT loan_id, collateral_id, internal_rating FROM loans_raw
        WHERE NOT (outstanding_balance > 0 AND collateral_id <> 100)""",
        "loans_raw",
    ),
)
def rule_violations(spark, d):
    raw = tv.loans(spark, d, raw=True, with_customer=False)
    broken = filters.rule_violations(raw, "outstanding_balance > 0 AND collateral_id <> 100")
    return broken.select("loan_id", "collateral_id", "internal_rating")


@book.query(
    "flt_outliers",
    sql(
        """SELECT collateral_id, market_value FROM clean_collateral,
          (SELECT avg(market_value) AS m, stddev_samp(market_value) AS s FROM clean_collateral)
        WHERE s > 0 AND abs(market_value - m) > s * 1.5e0""",
        "clean_collateral",
    ),
)
def outliers(spark, d):
    clean = tv.clean_collateral(spark, d).select("collateral_id", "market_value")
    return plain(filters.outliers(clean, "market_value", 1.5))


