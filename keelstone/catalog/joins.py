"""Join and per-loan calculation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from keelstone import schemas
from keelstone.catalog.book import Book, plain, rounded
from keelstone.catalog.sqlparts import bucket, sql
from keelstone.functions import codes, risk
from keelstone.operators import aggregates, detail as det, effective, fx as fx_ops, joins, ratings
from keelstone.operators import reconcile
from keelstone.operators import standardise as std, trend
from keelstone.params import Settings
from keelstone.sinks.bucketed import CoLocated
from keelstone.sources import reference, testviews as tv

book = Book()

def loans_usd(spark, d):
    return fx_ops.to_reporting_ccy(
        tv.clean_loans(spark, d), tv.clean_fx(spark), "outstanding_balance", "outstanding_balance_usd"
    )


def collateral_usd(spark, d):
    return det.converted_collateral(tv.clean_collateral(spark, d), tv.clean_fx(spark))


def hot(spark, d, key="customer_id"):
    """Hot keys of the raw loans, counted on the one column they need."""
    return joins.keys_above(tv.loan_keys(spark, d), key, tv.HOT_THRESHOLD)


def spread(spark, d, key="customer_id"):
    """How the joins spread the keys of the raw loans."""
    return joins.spread_keys(tv.loan_keys(spark, d), key, least=tv.HOT_THRESHOLD)


def rated(spark, d):
    """Loans with their ratings and bucket: no collateral, no rates."""
    loans = joins.attach_rating(
        tv.clean_loans(spark, d), tv.clean_ratings(spark, d), hot=spread(spark, d)
    )
    return det.with_rating(loans)


def exposed(spark, d):
    """Loans through rating, exposure and mitigation."""
    enriched = joins.enrich(
        loans_usd(spark, d), tv.clean_ratings(spark, d), collateral_usd(spark, d),
        profile=tv.loan_keys(spark, d),
    )
    return det.with_mitigation(det.with_exposure(det.with_rating(enriched)))


def mitigated(spark, d):
    """Loans through exposure and mitigation."""
    pledged = joins.attach_collateral(
        loans_usd(spark, d), collateral_usd(spark, d), "spread",
        hot=spread(spark, d, "collateral_id"),
    )
    return det.with_mitigation(det.with_exposure(pledged))


@book.query(
    "jn_fx_loans",
    sql("SELECT loan_id, currency, outstanding_balance_usd FROM loans_usd", "loans_usd"),
)
def fx_loans(spark, d):
    return loans_usd(spark, d).select("loan_id", "currency", "outstanding_balance_usd")


@book.query(
    "jn_fx_collateral",
    sql(
        "SELECT collateral_id, collateral_currency AS currency, adjusted_collateral_value_usd "
        "FROM collateral_usd",
        "collateral_usd",
    ),
)
def fx_collateral(spark, d):
    return collateral_usd(spark, d).select(
        "collateral_id", "currency", "adjusted_collateral_value_usd"
    )


CPTY_SQL = """SELECT l.loan_id, l.customer_id, c.customer_type AS cpty_customer_type,
    CAST(CAST(c.total_assets AS DECIMAL(18,2)) AS DOUBLE) AS cpty_total_assets,
    c.country_code AS cpty_country_code
  FROM loans_plain l LEFT JOIN counterparty c ON c.customer_id = l.customer_id"""


@book.query("jn_salted_counterparty", sql(CPTY_SQL, "loans_plain", "counterparty"))
def salted_counterparty(spark, d):
    loans = tv.loans(spark, d, with_customer=False)
    side = std.standardise_counterparty(tv.counterparty(spark, d))
    joined = joins.attach_counterparty(loans, side, hot=spread(spark, d))
    return plain(
        joined.select(
            "loan_id", "customer_id", "cpty_customer_type", "cpty_total_assets", "cpty_country_code"
        )
    )


@book.query(
    "jn_skew_keys",
    """SELECT 'L' || o.o_orderkey AS loan_id, o.o_custkey AS customer_id,
      h.n IS NOT NULL AS is_hot, coalesce(h.n, 0) AS key_rows
    FROM orders o LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1
      HAVING count(*) > 15) h ON h.o_custkey = o.o_custkey""",
)
def skew_keys(spark, d):
    loans = tv.loans(spark, d, with_customer=False).select("loan_id", "customer_id")
    marked = loans.join(hot(spark, d), "customer_id", "left")
    return marked.select(
        "loan_id",
        "customer_id",
        F.col("key_rows").isNotNull().alias("is_hot"),
        F.coalesce("key_rows", F.lit(0)).alias("key_rows"),
    )


@book.query(
    "jn_semi_hot",
    sql(
        """SELECT customer_id, customer_type FROM counterparty WHERE customer_id IN
        (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 15)""",
        "counterparty",
    ),
)
def semi_hot(spark, d):
    side = tv.counterparty(spark, d).select("customer_id", "customer_type")
    return joins.split_by_hot(side, hot(spark, d), "customer_id")[0]


@book.query(
    "jn_anti_hot",
    sql(
        """SELECT customer_id, customer_type FROM counterparty WHERE customer_id NOT IN
        (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 15)""",
        "counterparty",
    ),
)
def anti_hot(spark, d):
    side = tv.counterparty(spark, d).select("customer_id", "customer_type")
    return joins.split_by_hot(side, hot(spark, d), "customer_id")[1]


@book.query(
    "jn_collateral",
    sql(
        """SELECT l.loan_id, l.collateral_id, c.collateral_type, c.adjusted_collateral_value,
          c.currency AS collateral_currency
        FROM loans_plain l LEFT JOIN clean_collateral c ON c.collateral_id = l.collateral_id""",
        "loans_plain", "clean_collateral",
    ),
)
def collateral(spark, d):
    loans = tv.loans(spark, d, with_customer=False).select("loan_id", "collateral_id")
    joined = joins.attach_collateral(
        loans, tv.clean_collateral(spark, d), hot=spread(spark, d, "collateral_id")
    )
    return plain(
        joined.select(
            "loan_id", "collateral_id", "collateral_type", "adjusted_collateral_value",
            "collateral_currency",
        )
    )


@book.query(
    "jn_collateral_bucketed",
    sql(
        """SELECT l.loan_id, l.collateral_id, c.collateral_type, c.adjusted_collateral_value,
          c.currency AS collateral_currency
        FROM loans_plain l LEFT JOIN clean_collateral c ON c.collateral_id = l.collateral_id""",
        "loans_plain", "clean_collateral",
    ),
)
def collateral_bucketed(spark, d):
    """The same join over tables stored by its key: shuffled when stored, not when joined."""
    loans = tv.loans(spark, d, with_customer=False).select("loan_id", "collateral_id")
    side = tv.clean_collateral(spark, d).select(
        "collateral_id", "collateral_type", "adjusted_collateral_value",
        F.col("currency").alias("collateral_currency"),
    )
    stored = CoLocated(spark, "collateral_id", buckets=8)
    stored.store_rows(loans, hot=spread(spark, d, "collateral_id"))
    stored.store_side(side)
    return plain(
        stored.joined().select(
            "loan_id", "collateral_id", "collateral_type", "adjusted_collateral_value",
            "collateral_currency",
        )
    )


@book.query(
    "jn_ratings",
    sql(
        """SELECT l.loan_id, l.customer_id, r.rating, r.rating_numeric
        FROM loans_plain l LEFT JOIN customer_rating r ON r.customer_id = l.customer_id""",
        "loans_plain", "customer_rating",
    ),
)
def attach_ratings(spark, d):
    loans = tv.loans(spark, d, with_customer=False).select("loan_id", "customer_id")
    return joins.attach_rating(loans, tv.clean_ratings(spark, d), hot=spread(spark, d)).select(
        "loan_id", "customer_id", "rating", "rating_numeric"
    )


POLICY_SQL = """
SELECT 'best' AS policy, customer_id, rating, rating_numeric FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY rating_numeric ASC NULLS LAST,
    rating_date DESC, rating_agency DESC) AS place FROM clean_ratings) WHERE place = 1
UNION ALL
SELECT 'latest', customer_id, rating, rating_numeric FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY rating_date DESC,
    rating_numeric DESC NULLS LAST, rating_agency DESC) AS place FROM clean_ratings) WHERE place = 1
UNION ALL
SELECT 'second_best', customer_id, rating, rating_numeric FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY rating_numeric ASC NULLS LAST,
    rating_date DESC, rating_agency ASC) AS place,
    count(*) OVER (PARTITION BY customer_id) AS n FROM clean_ratings) WHERE place = least(2, n)
UNION ALL
SELECT 'worst', customer_id, rating, rating_numeric FROM customer_rating"""


@book.query("jn_ratings_policies", sql(POLICY_SQL, "clean_ratings", "customer_rating"))
def rating_policies(spark, d):
    clean = tv.clean_ratings(spark, d)
    parts = [
        ratings.rating_per_customer(clean, policy).select(
            F.lit(policy).alias("policy"), "customer_id", "rating", "rating_numeric"
        )
        for policy in ("best", "latest", "second_best", "worst")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@book.query(
    "jn_ccf",
    sql(
        """SELECT l.loan_id, CASE WHEN product_type = 'COMMITTED_LINE' THEN 'COMMITTED_LINE'
          ELSE 'ON_BALANCE' END AS exposure_type,
          CASE WHEN product_type = 'COMMITTED_LINE' THEN 0.5e0 ELSE 1e0 END
            AS credit_conversion_factor FROM clean_loans l""",
        "clean_loans",
    ),
)
def ccf(spark, d):
    typed = tv.clean_loans(spark, d).withColumn(
        "exposure_type", codes.exposure_type(F.col("product_type"))
    )
    return joins.attach_ccf(typed, reference.ccf_table(spark)).select(
        "loan_id", "exposure_type", "credit_conversion_factor"
    )


def internal_bucket(spark, d):
    """Loans bucketed by their internal rating only."""
    loans = tv.clean_loans(spark, d)
    rating = F.coalesce("internal_rating", F.lit("BBB"))
    return loans.withColumn("rating_bucket", codes.rating_bucket(rating))


@book.query(
    "jn_risk_weight",
    sql(
        f"""SELECT b.loan_id, b.asset_class, b.rating_bucket, coalesce(w.risk_weight, 1e0) AS risk_weight
        FROM (SELECT *, {bucket("coalesce(internal_rating, 'BBB')")} AS rating_bucket
              FROM clean_loans) b
        LEFT JOIN weights w ON w.asset_class = b.asset_class AND w.rating_bucket = b.rating_bucket""",
        "clean_loans", "weights",
    ),
)
def risk_weight(spark, d):
    weighted = joins.attach_risk_weight(internal_bucket(spark, d), reference.risk_weights(spark))
    return weighted.select("loan_id", "asset_class", "rating_bucket", "risk_weight")


@book.query(
    "jn_lgd",
    sql(
        """SELECT collateral_id, c.collateral_type, coalesce(l.lgd, 0.45e0) AS loss_given_default
        FROM clean_collateral c LEFT JOIN lgd l ON l.collateral_type = c.collateral_type""",
        "clean_collateral", "lgd",
    ),
)
def lgd(spark, d):
    side = tv.clean_collateral(spark, d).select("collateral_id", "collateral_type")
    return joins.attach_lgd(side, reference.lgd_table(spark)).select(
        "collateral_id", "collateral_type", "loss_given_default"
    )


@book.query(
    "jn_enrich",
    sql(
        """SELECT l.loan_id, l.customer_id, l.collateral_id, l.country_code, l.currency,
          l.outstanding_balance_usd, p.customer_type AS cpty_customer_type,
          p.country_code AS cpty_country_code, l.rating, c.rating_numeric, l.collateral_type,
          l.adjusted_collateral_value_usd
        FROM enriched l LEFT JOIN counterparty p ON p.customer_id = l.customer_id
          LEFT JOIN customer_rating c ON c.customer_id = l.customer_id""",
        "enriched", "counterparty",
    ),
)
def enrich(spark, d):
    out = joins.enrich(
        loans_usd(spark, d), tv.clean_ratings(spark, d), collateral_usd(spark, d),
        counterparty=tv.counterparty(spark, d), profile=tv.loan_keys(spark, d),
    )
    return out.select(
        "loan_id", "customer_id", "collateral_id", "country_code", "currency",
        "outstanding_balance_usd", "cpty_customer_type", "cpty_country_code", "rating",
        "rating_numeric", "collateral_type", "adjusted_collateral_value_usd",
    )


MOVES_SQL = """
  SELECT coalesce(c.customer_id, p.customer_id) AS customer_id,
    coalesce(c.rwa, 0) AS current_rwa, coalesce(p.rwa, 0) AS previous_rwa,
    coalesce(c.rwa, 0) - coalesce(p.rwa, 0) AS rwa_change,
    CASE WHEN p.rwa > 0 THEN (c.rwa - p.rwa) / p.rwa * 100 END AS change_pct
  FROM (SELECT customer_id, sum(risk_weighted_assets) AS rwa FROM fact_{grain}
        WHERE calculation_date = DATE '{now}' GROUP BY 1) c
  FULL OUTER JOIN (SELECT customer_id, sum(risk_weighted_assets) AS rwa FROM fact_{grain}
        WHERE calculation_date = DATE '{before}' GROUP BY 1) p ON p.customer_id = c.customer_id"""

ROUND_MOVES = """SELECT customer_id, round(current_rwa, 3) AS current_rwa,
  round(previous_rwa, 3) AS previous_rwa, round(rwa_change, 3) AS rwa_change,
  round(change_pct, 4) AS change_pct FROM"""
MOVE_DIGITS = {"current_rwa": 3, "previous_rwa": 3, "rwa_change": 3, "change_pct": 4}


@book.query(
    "jn_full_outer_days",
    sql(
        f"{ROUND_MOVES} ({MOVES_SQL.format(grain='month', now='2001-07-01', before='2001-06-01')})",
        "fact_month",
    ),
)
def full_outer_days(spark, d):
    moves = trend.customer_moves(
        tv.fact(spark, d, "month"), dt.date(2001, 7, 1), dt.date(2001, 6, 1)
    )
    return rounded(moves, MOVE_DIGITS)


@book.query(
    "jn_prev_day",
    sql(
        """SELECT a.calculation_date, a.calculation_date - 1 AS previous_date,
          round(a.rwa, 2) AS current_rwa, round(b.rwa, 2) AS previous_rwa
        FROM (SELECT calculation_date, sum(risk_weighted_assets) AS rwa FROM fact_day GROUP BY 1) a
        LEFT JOIN (SELECT calculation_date, sum(risk_weighted_assets) AS rwa FROM fact_day GROUP BY 1) b
          ON b.calculation_date = a.calculation_date - 1""",
        "fact_day",
    ),
)
def prev_day(spark, d):
    totals = tv.fact(spark, d, "day").groupBy("calculation_date").agg(
        F.sum("risk_weighted_assets").alias("total_rwa")
    )
    pairs = trend.day_pairs(totals, {"total_rwa": "rwa"})
    return rounded(pairs, {"current_rwa": 2, "previous_rwa": 2})


@book.query(
    "jn_source_vs_calc",
    sql(
        """SELECT calculation_date, round(calc, 2) AS calculated_exposure,
          round(src, 2) AS source_exposure, calc_n AS calculated_loan_count,
          src_n AS source_loan_count
        FROM (SELECT calculation_date, sum(outstanding_balance_usd) AS calc, count(*) AS calc_n
              FROM fact_month GROUP BY 1)
        JOIN (SELECT run_date AS calculation_date, sum(outstanding_balance_usd) * 1.01e0 AS src,
              count(*) AS src_n FROM loans_usd_month GROUP BY 1) USING (calculation_date)""",
        "fact_month", "loans_usd_month",
    ),
)
def source_vs_calc(spark, d):
    both = reconcile.reconcile_totals(tv.fact(spark, d, "month"), scaled_source(spark, d, 1.01))
    return rounded(
        both.select(
            "calculation_date", "calculated_exposure", "source_exposure",
            "calculated_loan_count", "source_loan_count",
        ),
        {"calculated_exposure": 2, "source_exposure": 2},
    )


def scaled_source(spark, d, factor: float = 1.0, by_class: bool = False):
    """Source control totals per month, optionally off by a factor."""
    month = tv.as_of_for("month")
    loans = fx_ops.to_reporting_ccy(
        tv.clean_loans(spark, d, month), tv.clean_fx(spark), "outstanding_balance",
        "outstanding_balance_usd",
    )
    keys = [month.alias("calculation_date")] + (["asset_class"] if by_class else [])
    return loans.groupBy(*keys).agg(
        (F.sum("outstanding_balance_usd") * F.lit(factor)).alias("source_exposure"),
        F.count(F.lit(1)).alias("source_loan_count"),
    )


@book.query(
    "jn_star",
    sql(
        """SELECT a.asset_category, a.basel_exposure_class, g.region, g.is_developed_market,
          count(*) AS loan_count, round(sum(f.risk_weighted_assets), 2) AS total_rwa
        FROM fact f LEFT JOIN (VALUES
          ('RETAIL_MORTGAGE','Retail','Retail Exposures - Residential Mortgages'),
          ('RETAIL_OTHER','Retail','Retail Exposures - Other'),
          ('CORPORATE_SME','Corporate','Corporate Exposures - SME'),
          ('CORPORATE_LARGE','Corporate','Corporate Exposures - Large Corporate'),
          ('SOVEREIGN','Sovereign','Sovereign Exposures'))
          a(asset_class, asset_category, basel_exposure_class) ON a.asset_class = f.asset_class
        LEFT JOIN (VALUES ('US','North America',TRUE),('GB','Western Europe',TRUE),
          ('DE','Western Europe',TRUE),('JP','East Asia',TRUE),('CN','East Asia',FALSE))
          g(geography_code, region, is_developed_market) ON g.geography_code = f.geography
        GROUP BY ALL""",
        "fact",
    ),
)
def star(spark, d):
    wide = joins.with_dims(
        tv.fact(spark, d), reference.dim_asset_class(spark), reference.dim_geography(spark)
    )
    totals = wide.groupBy(
        "asset_category", "basel_exposure_class", "region", "is_developed_market"
    ).agg(
        F.count(F.lit(1)).alias("loan_count"), F.sum("risk_weighted_assets").alias("total_rwa")
    )
    return rounded(totals, {"total_rwa": 2})


SPLIT = dt.date(1998, 1, 1)


EFFECTIVE_SQL = sql(
    f"""SELECT l.loan_id, l.run_date AS calculation_date, l.asset_class, l.rating_bucket,
      round(w.risk_weight * CASE WHEN l.run_date < DATE '1998-01-01' THEN 0.5e0 ELSE 1e0 END, 4)
        AS effective_risk_weight
    FROM (SELECT *, {bucket("coalesce(internal_rating, 'BBB')")} AS rating_bucket
          FROM clean_loans_month) l
    LEFT JOIN weights w ON w.asset_class = l.asset_class AND w.rating_bucket = l.rating_bucket
      AND w.rating_bucket IN ('AAA','AA','A','BBB','BB','B')
      AND l.run_date >= DATE '1990-01-01'""",
    "clean_loans_month", "weights",
)


def _loans_and_versions(spark, d):
    """Rated loans by month, and the weights before and since a date."""
    ref = reference.effective_risk_weights(
        spark,
        [("earlier", dt.date(1990, 1, 1), SPLIT, 0.5), ("current", SPLIT, None, 1.0)],
    )
    month = tv.as_of_for("month")
    rating = F.coalesce("internal_rating", F.lit("BBB"))
    loans = tv.clean_loans(spark, d, month).select(
        "loan_id", month.alias("calculation_date"), "asset_class",
        codes.rating_bucket(rating).alias("rating_bucket"),
    )
    return loans, ref, ["asset_class", "rating_bucket"]


@book.query("jn_effective_dated", EFFECTIVE_SQL)
def effective_dated(spark, d):
    return plain(joins.as_of_lookup(*_loans_and_versions(spark, d)))


@book.query("jn_effective_dated_union", EFFECTIVE_SQL)
def effective_dated_union(spark, d):
    """The same by sorting versions and dates together once per key."""
    return plain(effective.as_of_union(*_loans_and_versions(spark, d)))


# Per-loan calculations ---------------------------------------------------------


def _register(name, columns, sql_columns, part, build):
    """A query showing the given columns of one calculation step, one row per loan."""
    text = sql(f"SELECT {', '.join(sql_columns)} FROM {part}", part)
    book.query(name, text)(lambda spark, d: build(spark, d).select(*columns))


def _exposed(spark, d):
    return det.with_exposure(loans_usd(spark, d))


def _typed(spark, d):
    return tv.clean_loans(spark, d).withColumn(
        "exposure_type", codes.exposure_type(F.col("product_type"))
    )


def _weighted(spark, d):
    return joins.attach_risk_weight(rated(spark, d), reference.risk_weights(spark))


def _defaulting(spark, d):
    chance = risk.probability_of_default(F.col("rating_bucket"))
    return rated(spark, d).withColumn("probability_of_default", chance)


def _scored(spark, d):
    score = risk.quality_score(F.col("rating"), F.col("internal_rating"))
    return rated(spark, d).withColumn("data_quality_score", score)


def _located(spark, d):
    return tv.clean_loans(spark, d).withColumn("geography", codes.geography(F.col("country_code")))


def _dated(spark, d):
    return det.with_metadata(tv.clean_loans(spark, d), tv.AS_OF)


# each query is built from the step that makes its columns
for _name, _columns, _part, _build in [
    ("rk_final_rating", ["loan_id", "rating", "internal_rating", "final_rating"], "rated", rated),
    ("rk_rating_bucket", ["loan_id", "final_rating", "rating_bucket"], "rated", rated),
    ("rk_exposure_type", ["loan_id", "product_type", "exposure_type"], "rated", _typed),
    ("rk_ead", ["loan_id", "credit_conversion_factor", "exposure_at_default"], "exposed", _exposed),
    (
        "rk_collateral_coverage",
        ["loan_id", "exposure_at_default", "adjusted_collateral_value_usd", "collateral_coverage_ratio"],
        "mitigated",
        mitigated,
    ),
    (
        "rk_ead_after_crm",
        ["loan_id", "collateral_coverage_ratio", "ead_after_crm"],
        "mitigated",
        mitigated,
    ),
    (
        "rk_risk_weight",
        ["loan_id", "asset_class", "rating_bucket", "risk_weight"],
        "fact",
        _weighted,
    ),
    ("rk_weight_floor", ["loan_id", "asset_class", "risk_weight", "risk_weight_floored"], "fact", tv.fact),
    ("rk_rwa", ["loan_id", "ead_after_crm", "risk_weight_floored", "risk_weighted_assets"], "fact", tv.fact),
    ("rk_regulatory_capital", ["loan_id", "risk_weighted_assets", "regulatory_capital"], "fact", tv.fact),
    ("rk_pd", ["loan_id", "rating_bucket", "probability_of_default"], "fact", _defaulting),
    (
        "rk_expected_loss",
        ["loan_id", "ead_after_crm", "probability_of_default", "loss_given_default", "expected_loss"],
        "fact",
        tv.fact,
    ),
    (
        "rk_high_risk_flag",
        ["loan_id", "risk_weight", "probability_of_default", "high_risk_flag"],
        "fact",
        tv.fact,
    ),
    ("rk_quality_score", ["loan_id", "data_quality_score"], "fact", _scored),
    ("rk_geography", ["loan_id", "country_code", "geography"], "fact", _located),
    (
        "rk_metadata",
        ["loan_id", "calculation_date", "calculation_method", "created_timestamp"],
        "fact",
        _dated,
    ),
    ("rk_detail", schemas.DETAIL_COLUMNS, "fact", tv.fact),
]:
    _register(_name, _columns, _columns, _part, _build)


@book.query(
    "rk_weight_floor_binding",
    sql(
        """SELECT loan_id, risk_weight, CASE WHEN asset_class = 'RETAIL_MORTGAGE'
          THEN greatest(risk_weight, 0.6e0) ELSE risk_weight END AS floored FROM fact""",
        "fact",
    ),
)
def binding_floor(spark, d):
    """A floor high enough to bind, which the standard one never does."""
    strict = Settings(weight_floors={"RETAIL_MORTGAGE": 0.60})
    floored = risk.floored_weight(F.col("asset_class"), F.col("risk_weight"), strict)
    return tv.fact(spark, d).select("loan_id", "risk_weight", floored.alias("floored"))


@book.query(
    "rk_capital_ratio",
    sql(
        """SELECT asset_class, round(sum(regulatory_capital) /
          nullif(sum(outstanding_balance_usd), 0), 6) AS capital_ratio FROM fact GROUP BY 1""",
        "fact",
    ),
)
def capital_ratio(spark, d):
    out = aggregates.summary(tv.fact(spark, d), ["asset_class"]).select("asset_class", "capital_ratio")
    return rounded(out, {"capital_ratio": 6})


@book.query(
    "rk_rwa_density",
    sql(
        """SELECT asset_class, round(sum(risk_weighted_assets) /
          nullif(sum(outstanding_balance_usd), 0), 6) AS rwa_density FROM fact GROUP BY 1""",
        "fact",
    ),
)
def rwa_density(spark, d):
    out = aggregates.summary(tv.fact(spark, d), ["asset_class"]).select("asset_class", "rwa_density")
    return rounded(out, {"rwa_density": 6})
