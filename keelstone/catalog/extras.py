"""Synthetic portfolios and the documented rules beyond the daily calculation."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelstone import params
from keelstone.catalog.book import Book, plain, rounded
from keelstone.catalog.joins import collateral_usd, exposed, loans_usd, mitigated
from keelstone.catalog.sqlparts import sql
from keelstone.operators import aggregates as agg, capital, detail as det
from keelstone.sources import generator as gen, reference, testviews as tv

book = Book()

SEED = 42


def u(number: str, field: str) -> str:
    """The generator's draw in SQL."""
    return (
        f"(CAST('0x' || substr(md5('{SEED}:{field}:' || {number}), 1, 8) AS BIGINT) / 4294967296e0)"
    )


def pick_sql(number: str, field: str, values: list[str]) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[CAST(floor({u(number, field)} * {len(values)}) AS INTEGER) + 1]"


def weighted_sql(number: str, field: str, weights: dict[str, int]) -> str:
    arms, reached = [], 0
    for value, weight in weights.items():
        reached += weight
        arms.append(f"WHEN {u(number, field)} * 100e0 < {reached} THEN '{value}'")
    return f"CASE {' '.join(arms)} ELSE '{list(weights)[-1]}' END"


def case_sql(column: str, table: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items())
    return f"CASE {column} {arms} END"


def between_sql(number: str, field: str, low: str, high: str) -> str:
    return f"({low} + {u(number, field)} * ({high} - {low}))"


def range_sql(number: str, field: str, column: str, table: dict) -> str:
    low = case_sql(column, {k: f"{v[0]}e0" for k, v in table.items()})
    high = case_sql(column, {k: f"{v[1]}e0" for k, v in table.items()})
    return between_sql(number, field, low, high)


def days_sql(number: str, field: str, low: int, high: int) -> str:
    return f"CAST(floor({u(number, field)} * {high - low + 1}) + {low} AS INTEGER)"


BASE = f"DATE '{gen.BASE_DATE.isoformat()}'"

CUSTOMERS_SQL = f"""SELECT printf('C%06d', id) AS customer_id, customer_type, industry_code,
    country_code, {range_sql('id', 'total_assets', 'customer_type', gen.TOTAL_ASSETS)} AS total_assets,
    {range_sql('id', 'annual_revenue', 'customer_type', gen.ANNUAL_REVENUE)} AS annual_revenue,
    internal_rating, internal_rating AS credit_rating,
    {case_sql('internal_rating', {k: f'{v}::DOUBLE' for k, v in gen.CUSTOMER_PD.items()})}
      AS default_probability
  FROM (SELECT id, {pick_sql('id', 'customer_type', gen.CUSTOMER_TYPES)} AS customer_type,
      {pick_sql('id', 'industry', gen.INDUSTRIES)} AS industry_code,
      {pick_sql('id', 'country', gen.COUNTRIES)} AS country_code,
      {weighted_sql('id', 'internal_rating', gen.RATING_WEIGHTS)} AS internal_rating
    FROM (SELECT c_custkey + 1 AS id FROM customer))"""

COLLATERAL_SQL = f"""SELECT printf('COL%07d', id) AS collateral_id, collateral_type,
    {between_sql('id', 'market_value', '50000e0', '5000000e0')} AS market_value,
    {weighted_sql('id', 'currency', gen.COLLATERAL_CURRENCIES)} AS currency,
    {BASE} - {days_sql('id', 'valuation', 1, 365)} AS valuation_date,
    least(1e0, greatest(0e0, {case_sql('collateral_type', {k: f'{v}::DOUBLE' for k, v in gen.BASE_HAIRCUTS.items()})}
      + {between_sql('id', 'haircut', '-0.05e0', '0.05e0')})) AS haircut_percentage,
    {u('id', 'enforceable')} < 0.75e0 AS legal_enforceability_flag
  FROM (SELECT id, {pick_sql('id', 'collateral_type', list(gen.BASE_HAIRCUTS))} AS collateral_type
    FROM (SELECT p_partkey + 1 AS id FROM part))"""

PRODUCT_SQL = "CASE owner_type " + " ".join(
    f"WHEN '{k}' THEN {pick_sql('id', 'product', v)}" for k, v in gen.PRODUCTS.items()
) + " END"

LOANS_SQL = f"""SELECT printf('L%07d', id) AS loan_id, printf('C%06d', owner) AS customer_id,
    product_type, {BASE} - {days_sql('id', 'origination', 365, 1825)} AS origination_date,
    {BASE} + {days_sql('id', 'maturity', 365, 3650)} AS maturity_date,
    balance AS outstanding_balance,
    {weighted_sql('id', 'loan_currency', gen.LOAN_CURRENCIES)} AS currency,
    {weighted_sql('owner', 'internal_rating', gen.RATING_WEIGHTS)} AS internal_rating,
    {pick_sql('owner', 'country', gen.COUNTRIES)} AS country_code,
    CASE WHEN {u('id', 'has_collateral')} < 0.5e0 THEN printf('COL%07d',
      CAST(floor({u('id', 'collateral')} * n_collateral) AS BIGINT) + 1) END AS collateral_id,
    CASE WHEN product_type IN ('REVOLVING_CREDIT','CREDIT_CARD')
      THEN balance * {between_sql('id', 'undrawn', '1.2e0', '1.5e0')} ELSE balance END
      AS exposure_at_default
  FROM (SELECT *, {PRODUCT_SQL} AS product_type,
      {range_sql('id', 'balance', 'owner_type', gen.LOAN_BALANCE)} AS balance
    FROM (SELECT *, {pick_sql('owner', 'customer_type', gen.CUSTOMER_TYPES)} AS owner_type
      FROM (SELECT id, n_collateral, CASE WHEN {u('id', 'skew')} < 0.2e0
          THEN CAST(floor({u('id', 'heavy')} * least(20, n_customers)) AS BIGINT)
          ELSE CAST(floor({u('id', 'customer')} * n_customers) AS BIGINT) END + 1 AS owner
        FROM (SELECT o_orderkey + 1 AS id, (SELECT count(*) FROM customer) AS n_customers,
            (SELECT count(*) FROM part) AS n_collateral FROM orders))))"""

NOTCH_KEY = "(id || '/' || agency)"
RATINGS_SQL = f"""SELECT printf('C%06d', id) AS customer_id, agency AS rating_agency,
    CASE WHEN agency = 'MOODY' THEN {pick_sql(NOTCH_KEY, 'notch', gen.MOODY_NOTCHES)}
      ELSE {pick_sql(NOTCH_KEY, 'notch', gen.COMMON_NOTCHES)} END AS rating,
    {BASE} - {days_sql(NOTCH_KEY, 'rating_date', 1, 180)} AS rating_date,
    {pick_sql(NOTCH_KEY, 'outlook', gen.OUTLOOKS)} AS outlook
  FROM (SELECT id, (['S&P','MOODY','FITCH'])[CAST((step + floor({u('id', 'first_agency')} * 3)) % 3
        AS INTEGER) + 1] AS agency
    FROM (SELECT c_custkey + 1 AS id FROM customer), (SELECT unnest(range(3)) AS step)
    WHERE {pick_sql('id', 'customer_type', gen.CUSTOMER_TYPES)} IN ('CORPORATE','FINANCIAL_INSTITUTION')
      AND {u('id', 'rated')} < 0.7e0 AND step <= floor({u('id', 'agencies')} * 3))"""


def numbers(spark, d, table, key):
    """Row numbers from 1, one per row of a given table."""
    return tv.table(spark, d, table).select((F.col(key) + 1).alias("id"))


def row_count(spark, d, table):
    return tv.table(spark, d, table).agg(F.count(F.lit(1))).scalar()


def generated_loans(spark, d):
    return gen.loans(
        numbers(spark, d, "orders", "o_orderkey"), row_count(spark, d, "customer"),
        row_count(spark, d, "part"), SEED,
    )


def generated_customers(spark, d):
    return gen.customers(numbers(spark, d, "customer", "c_custkey"), SEED)


@book.query("gen_portfolio", LOANS_SQL)
def portfolio(spark, d):
    """As many synthetic loans as there are orders."""
    return generated_loans(spark, d)


@book.query("gen_portfolio_customers", CUSTOMERS_SQL)
def portfolio_customers(spark, d):
    return generated_customers(spark, d)


@book.query("gen_portfolio_collateral", COLLATERAL_SQL)
def portfolio_collateral(spark, d):
    return gen.collateral(numbers(spark, d, "part", "p_partkey"), SEED)


@book.query("gen_portfolio_ratings", RATINGS_SQL)
def portfolio_ratings(spark, d):
    return gen.ratings(numbers(spark, d, "customer", "c_custkey"), SEED)


@book.query(
    "gen_profile",
    f"""WITH loans AS ({LOANS_SQL}), customers AS ({CUSTOMERS_SQL}),
      per_customer AS (SELECT customer_id, count(*) AS n FROM loans GROUP BY 1)
    SELECT 'loans' AS attribute, v.value, round(v.number, 0) AS number FROM
      (SELECT count(*) AS n, sum(outstanding_balance) AS b, count(collateral_id) AS c FROM loans) t,
      LATERAL (VALUES ('loan_count', t.n::DOUBLE), ('total_balance', t.b), ('avg_balance', t.b / t.n),
        ('with_collateral', t.c::DOUBLE), ('with_collateral_pct', t.c * 100e0 / t.n)) v(value, number)
    UNION ALL SELECT 'skew', v.value, round(v.number, 0) FROM
      (SELECT max(n) AS m, avg(n) AS a, count(*) FILTER (WHERE n > 100) AS h FROM per_customer) t,
      LATERAL (VALUES ('max_loans', t.m::DOUBLE), ('avg_loans', t.a), ('hot_customers', t.h::DOUBLE))
        v(value, number)
    UNION ALL SELECT 'customer_type', customer_type, count(*)::DOUBLE FROM customers GROUP BY 2
    UNION ALL SELECT 'internal_rating', internal_rating, count(*)::DOUBLE FROM customers GROUP BY 2""",
)
def profile(spark, d):
    return rounded(gen.profile(generated_loans(spark, d), generated_customers(spark, d)), {"number": 0})


# Documented rules ------------------------------------------------------------------


@book.query(
    "ext_ead_drawn_undrawn",
    sql(
        """SELECT loan_id, CASE WHEN product_type = 'COMMITTED_LINE' THEN 'COMMITTED'
            WHEN product_type = 'CREDIT_CARD' THEN 'UNCOMMITTED' ELSE 'DRAWN' END AS commitment,
          outstanding_balance_usd * 0.3e0
            + greatest(outstanding_balance_usd - outstanding_balance_usd * 0.3e0, 0e0)
            * CASE WHEN product_type = 'COMMITTED_LINE' THEN 0.5e0 WHEN product_type = 'CREDIT_CARD'
              THEN 0e0 ELSE 1e0 END AS ead FROM loans_usd""",
        "loans_usd",
    ),
)
def ead_drawn_undrawn(spark, d):
    """The balance as limit, of which 30 % are drawn."""
    product = F.col("product_type")
    commitment = (
        F.when(product == "COMMITTED_LINE", "COMMITTED")
        .when(product == "CREDIT_CARD", "UNCOMMITTED")
        .otherwise("DRAWN")
    )
    limit = F.col("outstanding_balance_usd")
    ead = capital.drawn_undrawn_ead(limit * F.lit(0.3), limit, F.col("commitment"))
    loans = loans_usd(spark, d).withColumn("commitment", commitment)
    return loans.select("loan_id", "commitment", ead.alias("ead"))


@book.query(
    "ext_capital_stack",
    sql(
        """SELECT asset_class, layer, layer_rate, is_buffer, round(total_rwa, 2) AS total_rwa,
          round(total_rwa * layer_rate, 2) AS capital_amount
        FROM (SELECT asset_class, sum(risk_weighted_assets) AS total_rwa FROM fact GROUP BY 1),
          (VALUES ('CET1', 0.045e0, FALSE), ('TIER1', 0.06e0, FALSE), ('TOTAL', 0.08e0, FALSE),
            ('CONSERVATION_BUFFER', 0.025e0, TRUE), ('COUNTERCYCLICAL_BUFFER', 0.01e0, TRUE),
            ('SYSTEMIC_BUFFER', 0.02e0, TRUE)) v(layer, layer_rate, is_buffer)""",
        "fact",
    ),
)
def capital_stack(spark, d):
    totals = tv.fact(spark, d).groupBy("asset_class").agg(
        F.sum("risk_weighted_assets").alias("total_rwa")
    )
    layers = capital.capital_layers(countercyclical=0.01, systemic=0.02)
    return rounded(capital.capital_stack(totals, layers), {"total_rwa": 2, "capital_amount": 2})


@book.query(
    "ext_output_floor",
    sql(
        """SELECT asset_class, round(standard, 2) AS standard_rwa, round(model, 2) AS model_rwa,
          round(greatest(model, standard * 0.725e0), 2) AS floored_rwa
        FROM (SELECT asset_class, sum(risk_weighted_assets) AS standard,
          sum(ead_after_crm * least(1e0, probability_of_default * 60)) AS model
          FROM fact GROUP BY 1)""",
        "fact",
    ),
)
def output_floor(spark, d):
    """A model total (here a multiple of expected default) against the standardised one."""
    model = F.col("ead_after_crm") * F.least(F.lit(1.0), F.col("probability_of_default") * 60)
    totals = tv.fact(spark, d).groupBy("asset_class").agg(
        F.sum("risk_weighted_assets").alias("standard_rwa"), F.sum(model).alias("model_rwa")
    )
    floored = capital.output_floor(F.col("model_rwa"), F.col("standard_rwa"))
    out = totals.withColumn("floored_rwa", floored)
    return rounded(out, {"standard_rwa": 2, "model_rwa": 2, "floored_rwa": 2})


@book.query(
    "ext_sme_discount",
    sql(
        """SELECT loan_id, risk_weight, CASE WHEN asset_class = 'CORPORATE_SME'
          AND outstanding_balance_usd < 200000 THEN risk_weight * 0.75e0 ELSE risk_weight END
          AS sme_weight FROM fact""",
        "fact",
    ),
)
def sme_discount(spark, d):
    """Small exposures to small businesses qualify."""
    weight = capital.sme_weight(
        F.col("asset_class"), F.col("risk_weight"), F.col("outstanding_balance_usd") < 200_000
    )
    return tv.fact(spark, d).select("loan_id", "risk_weight", weight.alias("sme_weight"))


@book.query(
    "ext_standard_haircuts",
    sql(
        """SELECT c.collateral_id, c.collateral_type, coalesce(h.haircut, 1e0) AS standard_haircut,
          c.market_value * (1e0 - coalesce(h.haircut, 1e0)) AS standard_value
        FROM clean_collateral c LEFT JOIN (VALUES ('CASH_DEPOSIT', 0e0), ('SECURITIES_LISTED', 0.2e0),
          ('GOLD', 0.15e0), ('REAL_ESTATE_RESIDENTIAL', 0.35e0), ('REAL_ESTATE_COMMERCIAL', 0.4e0),
          ('RECEIVABLES', 0.45e0), ('EQUIPMENT', 0.55e0)) h(collateral_type, haircut)
          ON h.collateral_type = c.collateral_type""",
        "clean_collateral",
    ),
)
def standard_haircuts(spark, d):
    out = capital.with_standard_haircut(
        tv.clean_collateral(spark, d), reference.standard_haircuts(spark)
    )
    return out.select("collateral_id", "collateral_type", "standard_haircut", "standard_value")


LTV_BANDS = [(params.LTV_THRESHOLD, 0.75), (1.0, 1.0)]


@book.query(
    "ext_ltv_mortgage",
    sql(
        """SELECT loan_id, asset_class, CASE WHEN asset_class = 'RETAIL_MORTGAGE' THEN
            greatest(risk_weight, CASE WHEN ltv > 1 THEN 1e0 WHEN ltv > 0.8e0 THEN 0.75e0 END)
            ELSE risk_weight END AS ltv_weight
        FROM (SELECT *, outstanding_balance_usd / nullif(adjusted_collateral_value_usd, 0) AS ltv
          FROM weighted)""",
        "weighted",
    ),
)
def ltv_mortgage(spark, d):
    loans = det.with_capital(exposed(spark, d))
    ltv = F.try_divide(F.col("outstanding_balance_usd"), F.col("adjusted_collateral_value_usd"))
    weight = capital.ltv_weight(F.col("asset_class"), F.col("risk_weight"), ltv, LTV_BANDS)
    return loans.select("loan_id", "asset_class", weight.alias("ltv_weight"))


@book.query(
    "ext_eligible_collateral",
    sql(
        """SELECT collateral_id, legal_enforceability_flag, CASE WHEN legal_enforceability_flag
          THEN adjusted_collateral_value_usd ELSE 0e0 END AS adjusted_collateral_value_usd
        FROM collateral_usd""",
        "collateral_usd",
    ),
)
def eligible_collateral(spark, d):
    out = capital.eligible_only(collateral_usd(spark, d), "adjusted_collateral_value_usd")
    return plain(
        out.select("collateral_id", "legal_enforceability_flag", "adjusted_collateral_value_usd")
    )


@book.query(
    "ext_collateral_allocation",
    sql(
        """SELECT loan_id, collateral_id, round(adjusted_collateral_value_usd * (exposure_at_default
          / sum(exposure_at_default) OVER (PARTITION BY collateral_id)), 3)
          AS allocated_collateral_usd FROM exposed""",
        "exposed",
    ),
)
def collateral_allocation(spark, d):
    # exposures do not depend on collateral, so their totals need no join
    exposures = det.with_exposure(loans_usd(spark, d)).select("collateral_id", "exposure_at_default")
    out = capital.allocate_collateral(
        mitigated(spark, d), exposures=exposures, profile=tv.loan_keys(spark, d)
    ).select("loan_id", "collateral_id", "allocated_collateral_usd")
    return rounded(out, {"allocated_collateral_usd": 3})


# The flagship report ----------------------------------------------------------------


@book.query(
    "rwa_by_class_and_bucket",
    sql(
        """SELECT asset_class, rating_bucket, count(*) AS loan_count,
          round(sum(exposure_at_default), 2) AS total_ead,
          round(sum(risk_weighted_assets), 2) AS total_rwa,
          round(sum(regulatory_capital), 2) AS total_capital FROM fact GROUP BY 1, 2""",
        "fact",
    ),
)
def flagship(spark, d):
    report = agg.summary(tv.fact(spark, d), ["asset_class", "rating_bucket"]).select(
        "asset_class", "rating_bucket", "loan_count", "total_ead", "total_rwa",
        F.col("total_regulatory_capital").alias("total_capital"),
    )
    return rounded(report, {"total_ead": 2, "total_rwa": 2, "total_capital": 2})
