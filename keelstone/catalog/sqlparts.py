"""Common table expressions of the comparison SQL.

Written by hand for DuckDB over the given tables, independently of the operators:
this is the second opinion the operators are compared with.
"""

from __future__ import annotations

RUN = "DATE '2001-08-01'"
MONTH = "CAST(date_trunc('month', origination_date) AS DATE)"
DAY = "origination_date"

NOTCHES = (
    "['AAA','AA+','AA','AA-','A+','A','A-','BBB+','BBB','BBB-','BB+','BB','BB-',"
    "'B+','B','B-','CCC+','CCC','CCC-','CC','C','D']"
)
NOTCH_NUMBERS = "[1,2,2,3,4,4,5,6,6,7,8,8,9,10,10,11,12,12,12,13,13,14]"


def _loans(balance: str) -> str:
    return f"""
  SELECT 'L' || o_orderkey AS loan_id, o_custkey AS customer_id,
    ([' mortgage ','HOME_LOAN','personal_loan','CREDIT_CARD','SME_LOAN','CORPORATE_LOAN',
      'TERM_LOAN','REVOLVING_CREDIT','COMMITTED_LINE'])[CAST(o_orderkey % 9 AS INTEGER) + 1]
      AS product_type,
    CAST(o_orderdate AS DATE) AS origination_date,
    CAST(o_orderdate AS DATE) + CAST(365 * (1 + o_orderkey % 10) AS INTEGER) AS maturity_date,
    CAST({balance} AS DECIMAL(18,2)) AS outstanding_balance,
    (['AAA','AA-','A+','BBB','BB-','B','CCC',NULL])[CAST(o_custkey % 8 AS INTEGER) + 1]
      AS internal_rating,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 200 END AS collateral_id,
    (['USD','EUR','GBP','JPY','CNY'])[CAST(c_nationkey % 5 AS INTEGER) + 1] AS currency,
    (['US','GB','DE','FR','JP','CN','CA','AU'])[CAST(c_nationkey % 8 AS INTEGER) + 1]
      AS country_code
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def _clean_loans(as_of: str) -> str:
    return f"""
  SELECT loan_id, customer_id, upper(trim(product_type)) AS product_type, origination_date,
    maturity_date, outstanding_balance, internal_rating, collateral_id, currency, country_code,
    {as_of} AS run_date,
    maturity_date - {as_of} AS days_to_maturity, {as_of} - origination_date AS loan_age_days,
    CASE upper(trim(product_type))
      WHEN 'MORTGAGE' THEN 'RETAIL_MORTGAGE' WHEN 'HOME_LOAN' THEN 'RETAIL_MORTGAGE'
      WHEN 'PERSONAL_LOAN' THEN 'RETAIL_OTHER' WHEN 'CREDIT_CARD' THEN 'RETAIL_OTHER'
      WHEN 'SME_LOAN' THEN 'CORPORATE_SME' WHEN 'CORPORATE_LOAN' THEN 'CORPORATE_LARGE'
      ELSE 'OTHER' END AS asset_class
  FROM loans_raw WHERE outstanding_balance > 0 AND maturity_date > {as_of}"""


BUCKET = """CASE
      WHEN {r} IN ('AAA','AA+','AA','AA-') THEN 'AAA' WHEN {r} IN ('A+','A','A-') THEN 'A'
      WHEN {r} IN ('BB+','BB','BB-') THEN 'BB' WHEN {r} IN ('B+','B','B-') THEN 'B'
      WHEN {r} IN ('CCC+','CCC','CCC-','CC','C') THEN 'CCC' ELSE 'BBB' END"""


def bucket(rating: str) -> str:
    return BUCKET.replace("{r}", rating)


WEIGHT_ROWS = """
    ('RETAIL_MORTGAGE','AAA',0.35e0),('RETAIL_MORTGAGE','AA',0.35e0),('RETAIL_MORTGAGE','A',0.35e0),
    ('RETAIL_MORTGAGE','BBB',0.5e0),('RETAIL_MORTGAGE','BB',0.75e0),('RETAIL_MORTGAGE','B',1e0),
    ('RETAIL_MORTGAGE','CCC',1.5e0),('RETAIL_MORTGAGE','DEFAULT',0.35e0),
    ('RETAIL_OTHER','AAA',0.75e0),('RETAIL_OTHER','AA',0.75e0),('RETAIL_OTHER','A',0.75e0),
    ('RETAIL_OTHER','BBB',0.75e0),('RETAIL_OTHER','BB',0.75e0),('RETAIL_OTHER','B',0.75e0),
    ('RETAIL_OTHER','DEFAULT',0.75e0),
    ('CORPORATE_SME','AAA',0.2e0),('CORPORATE_SME','AA',0.3e0),('CORPORATE_SME','A',0.5e0),
    ('CORPORATE_SME','BBB',0.75e0),('CORPORATE_SME','BB',1e0),('CORPORATE_SME','B',1.5e0),
    ('CORPORATE_SME','CCC',1.5e0),('CORPORATE_SME','DEFAULT',1e0),
    ('CORPORATE_LARGE','AAA',0.2e0),('CORPORATE_LARGE','AA',0.3e0),('CORPORATE_LARGE','A',0.5e0),
    ('CORPORATE_LARGE','BBB',1e0),('CORPORATE_LARGE','BB',1e0),('CORPORATE_LARGE','B',1.5e0),
    ('CORPORATE_LARGE','CCC',1.5e0),('CORPORATE_LARGE','DEFAULT',1.5e0)"""

CCF_ROWS = """('COMMITTED_LINE',0.5e0),('LETTER_OF_CREDIT',0.2e0),('GUARANTEE',1e0),
    ('DERIVATIVE',1e0),('REPO',0e0),('ON_BALANCE',1e0)"""

LGD_ROWS = """('REAL_ESTATE_RESIDENTIAL',0.35e0),('REAL_ESTATE_COMMERCIAL',0.4e0),
    ('CASH_DEPOSIT',0e0),('SECURITIES_LISTED',0.25e0),('SECURITIES_UNLISTED',0.5e0),
    ('RECEIVABLES',0.45e0),('INVENTORY',0.6e0),('EQUIPMENT',0.55e0),('UNCOLLATERALIZED',0.45e0)"""

PARTS: dict[str, str] = {
    "loans_raw": _loans("CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice ELSE o_totalprice END"),
    "loans_plain": _loans("o_totalprice"),
    "counterparty": """
  SELECT c_custkey AS customer_id, c_mktsegment AS customer_type, c_acctbal AS total_assets,
    (['US','GB','DE','FR','JP','CN','CA','AU'])[CAST(c_nationkey % 8 AS INTEGER) + 1]
      AS country_code
  FROM customer""",
    "collateral": """
  SELECT p_partkey AS collateral_id,
    (['REAL_ESTATE_RESIDENTIAL','REAL_ESTATE_COMMERCIAL','CASH_DEPOSIT','SECURITIES_LISTED',
      'SECURITIES_UNLISTED','RECEIVABLES','INVENTORY','EQUIPMENT'])
      [CAST(p_partkey % 8 AS INTEGER) + 1] AS collateral_type,
    p_retailprice * (1 + p_size) * 10 AS market_value,
    (['USD','EUR','GBP'])[CAST(p_partkey % 3 AS INTEGER) + 1] AS currency,
    DATE '2000-01-01' + CAST((p_partkey * 7) % 577 AS INTEGER) AS valuation_date,
    (p_partkey % 5) * 0.1e0 AS haircut_percentage,
    p_partkey % 4 <> 0 AS legal_enforceability_flag
  FROM part""",
    "clean_collateral": f"""
  SELECT collateral_id, collateral_type, currency, valuation_date, legal_enforceability_flag,
    CAST(CAST(market_value AS DECIMAL(18,2)) AS DOUBLE) AS market_value,
    CAST(CAST(haircut_percentage AS DECIMAL(5,4)) AS DOUBLE) AS haircut_percentage,
    CAST(CAST(CAST(market_value AS DECIMAL(18,2)) AS DECIMAL(28,2))
      * CAST(1 - CAST(haircut_percentage AS DECIMAL(5,4)) AS DECIMAL(8,4)) AS DOUBLE)
      AS adjusted_collateral_value,
    {RUN} - valuation_date AS days_since_valuation,
    coalesce({RUN} - valuation_date > 365, FALSE) AS valuation_stale_flag
  FROM collateral""",
    "ratings": f"""
  SELECT user_id AS customer_id,
    CASE event_type WHEN 'click' THEN 'S&P' WHEN 'view' THEN 'MOODY' WHEN 'signup' THEN 'FITCH'
      WHEN 'purchase' THEN 'S&P' WHEN 'error' THEN 'FITCH' END AS rating_agency,
    ({NOTCHES})[CAST(event_id % 22 AS INTEGER) + 1] AS rating,
    CAST(ts AS DATE) AS rating_date, event_id,
    ({NOTCH_NUMBERS})[CAST(event_id % 22 AS INTEGER) + 1] AS rating_numeric
  FROM events""",
    "clean_ratings": """
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, rating_agency
      ORDER BY rating_date DESC, event_id DESC) AS place FROM ratings) WHERE place = 1""",
    "customer_rating": """
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
      ORDER BY rating_numeric DESC NULLS LAST, rating_date DESC, rating_agency DESC) AS place
    FROM clean_ratings) WHERE place = 1""",
    "fx": """
  SELECT * FROM (VALUES ('EUR', 1.1e0), ('GBP', 1.27e0), ('JPY', 0.0067e0), ('CNY', 0.14e0))
    AS f(fx_currency, fx_rate)""",
    "weights": f"SELECT * FROM (VALUES {WEIGHT_ROWS}) AS w(asset_class, rating_bucket, risk_weight)",
    "ccf": f"SELECT * FROM (VALUES {CCF_ROWS}) AS c(exposure_type, ccf)",
    "lgd": f"SELECT * FROM (VALUES {LGD_ROWS}) AS l(collateral_type, lgd)",
    "collateral_usd": """
  SELECT c.* EXCLUDE (currency), c.currency AS collateral_currency,
    c.adjusted_collateral_value * coalesce(f.fx_rate, 1e0) AS adjusted_collateral_value_usd
  FROM clean_collateral c LEFT JOIN fx f ON f.fx_currency = c.currency""",
    "clean_loans": _clean_loans(RUN),
    "clean_loans_month": _clean_loans(MONTH),
    "clean_loans_day": _clean_loans(DAY),
}

NEEDS: dict[str, list[str]] = {
    "clean_collateral": ["collateral"],
    "clean_ratings": ["ratings"],
    "customer_rating": ["clean_ratings"],
    "collateral_usd": ["clean_collateral", "fx"],
    "clean_loans": ["loans_raw"],
    "clean_loans_month": ["loans_raw"],
    "clean_loans_day": ["loans_raw"],
}


def _fact(suffix: str) -> None:
    """Parts enriched, exposed, mitigated, weighted and fact for one kind of date."""
    s = suffix
    PARTS[f"loans_usd{s}"] = f"""
  SELECT l.*, CAST(l.outstanding_balance AS DOUBLE) * coalesce(f.fx_rate, 1e0)
    AS outstanding_balance_usd
  FROM clean_loans{s} l LEFT JOIN fx f ON f.fx_currency = l.currency"""
    PARTS[f"enriched{s}"] = f"""
  SELECT l.*, r.rating, c.collateral_type, c.adjusted_collateral_value_usd
  FROM loans_usd{s} l LEFT JOIN customer_rating r ON r.customer_id = l.customer_id
    LEFT JOIN collateral_usd c ON c.collateral_id = l.collateral_id"""
    PARTS[f"rated{s}"] = f"""
  SELECT *, {bucket('final_rating')} AS rating_bucket,
    CASE WHEN product_type = 'COMMITTED_LINE' THEN 'COMMITTED_LINE' ELSE 'ON_BALANCE' END
      AS exposure_type
  FROM (SELECT *, coalesce(rating, internal_rating, 'BBB') AS final_rating FROM enriched{s})"""
    PARTS[f"exposed{s}"] = f"""
  SELECT r.*, coalesce(c.ccf, 1e0) AS credit_conversion_factor,
    r.outstanding_balance_usd * coalesce(c.ccf, 1e0) AS exposure_at_default
  FROM rated{s} r LEFT JOIN ccf c ON c.exposure_type = r.exposure_type"""
    PARTS[f"mitigated{s}"] = f"""
  SELECT *, exposure_at_default * (1 - collateral_coverage_ratio) AS ead_after_crm
  FROM (SELECT *, CASE WHEN adjusted_collateral_value_usd IS NULL THEN 0e0
      ELSE least(adjusted_collateral_value_usd / exposure_at_default, 1e0) END
      AS collateral_coverage_ratio FROM exposed{s})"""
    PARTS[f"weighted{s}"] = f"""
  SELECT m.*, coalesce(w.risk_weight, 1e0) AS risk_weight,
    CASE WHEN m.asset_class = 'RETAIL_MORTGAGE' THEN greatest(coalesce(w.risk_weight, 1e0), 0.1e0)
      ELSE coalesce(w.risk_weight, 1e0) END AS risk_weight_floored,
    coalesce(l.lgd, 0.45e0) AS loss_given_default,
    CASE m.rating_bucket WHEN 'AAA' THEN 0.0001e0 WHEN 'A' THEN 0.0005e0 WHEN 'BBB' THEN 0.001e0
      WHEN 'BB' THEN 0.005e0 WHEN 'B' THEN 0.02e0 WHEN 'CCC' THEN 0.1e0 END
      AS probability_of_default
  FROM mitigated{s} m
    LEFT JOIN weights w ON w.asset_class = m.asset_class AND w.rating_bucket = m.rating_bucket
    LEFT JOIN lgd l ON l.collateral_type = m.collateral_type"""
    PARTS[f"fact{s}"] = f"""
  SELECT run_date AS calculation_date, loan_id, customer_id, product_type, asset_class,
    country_code, substr(country_code, 1, 2) AS geography, outstanding_balance_usd,
    credit_conversion_factor, exposure_at_default, ead_after_crm, collateral_coverage_ratio,
    final_rating, rating_bucket, probability_of_default, loss_given_default,
    ead_after_crm * probability_of_default * loss_given_default AS expected_loss,
    risk_weight, risk_weight_floored,
    ead_after_crm * risk_weight_floored AS risk_weighted_assets,
    ead_after_crm * risk_weight_floored * 0.08e0 AS regulatory_capital,
    'BASEL_III_STANDARDIZED' AS calculation_method,
    risk_weight > 1 OR probability_of_default > 0.05e0 OR days_to_maturity < 30 AS high_risk_flag,
    CASE WHEN rating IS NOT NULL THEN 1e0 WHEN internal_rating IS NOT NULL THEN 0.8e0
      ELSE 0.5e0 END AS data_quality_score,
    CAST(run_date AS TIMESTAMP) AS created_timestamp
  FROM weighted{s}"""
    NEEDS[f"loans_usd{s}"] = [f"clean_loans{s}", "fx"]
    NEEDS[f"enriched{s}"] = [f"loans_usd{s}", "customer_rating", "collateral_usd"]
    NEEDS[f"rated{s}"] = [f"enriched{s}"]
    NEEDS[f"exposed{s}"] = [f"rated{s}", "ccf"]
    NEEDS[f"mitigated{s}"] = [f"exposed{s}"]
    NEEDS[f"weighted{s}"] = [f"mitigated{s}", "weights", "lgd"]
    NEEDS[f"fact{s}"] = [f"weighted{s}"]


for _suffix in ("", "_month", "_day"):
    _fact(_suffix)

_SUMMARY_MEASURES = """count(loan_id) AS loan_count,
    sum(outstanding_balance_usd) AS total_exposure, sum(exposure_at_default) AS total_ead,
    sum(risk_weighted_assets) AS total_rwa, sum(regulatory_capital) AS total_regulatory_capital,
    sum(expected_loss) AS total_expected_loss, avg(risk_weight) AS avg_risk_weight,
    avg(probability_of_default) AS avg_pd, avg(loss_given_default) AS avg_lgd,
    count(*) FILTER (WHERE high_risk_flag) AS high_risk_count,
    avg(data_quality_score) AS avg_data_quality,
    sum(regulatory_capital) / nullif(sum(outstanding_balance_usd), 0) AS capital_ratio,
    sum(risk_weighted_assets) / nullif(sum(outstanding_balance_usd), 0) AS rwa_density"""

for _suffix in ("", "_month", "_day"):
    PARTS[f"summary{_suffix}"] = f"""
  SELECT calculation_date, asset_class, geography, rating_bucket, {_SUMMARY_MEASURES}
  FROM fact{_suffix} GROUP BY ALL"""
    NEEDS[f"summary{_suffix}"] = [f"fact{_suffix}"]


def sql(body: str, *parts: str) -> str:
    """``body`` behind the named parts and everything they need, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, []):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for part in parts:
        visit(part)
    if not ordered:
        return body.strip()
    head = ",\n".join(f"{name} AS ({PARTS[name]})" for name in ordered)
    return f"WITH {head}\n{body.strip()}"
