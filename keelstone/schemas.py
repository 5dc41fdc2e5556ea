"""Explicit schemas of the stored tables (no inference at read time)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATIO = T.DecimalType(5, 4)
RATE = T.DecimalType(18, 8)
TOTAL = T.DecimalType(20, 2)


def _struct(spec: str) -> T.StructType:
    """``"name type, name type"`` to a schema, without needing a session."""
    schema = T.StructType()
    for item in spec.split(", "):
        name, kind = item.split(" ")
        schema = schema.add(name, kind)
    return schema


LOANS = _struct(
    "loan_id string, customer_id string, product_type string, origination_date date, "
    "maturity_date date, outstanding_balance double, currency string, internal_rating string, "
    "country_code string, collateral_id string, exposure_at_default double"
)

COUNTERPARTY = _struct(
    "customer_id string, customer_type string, industry_code string, country_code string, "
    "total_assets double, annual_revenue double, internal_rating string, credit_rating string, "
    "default_probability double"
)

COLLATERAL = _struct(
    "collateral_id string, collateral_type string, market_value double, currency string, "
    "valuation_date date, haircut_percentage double, legal_enforceability_flag boolean"
)

RATINGS = _struct(
    "customer_id string, rating_agency string, rating string, rating_date date, outlook string"
)

FX = _struct("currency_pair string, rate double, date date, source string")

# Column order of the per-loan result.
DETAIL_COLUMNS = [
    "calculation_date", "loan_id", "customer_id", "product_type", "asset_class",
    "country_code", "geography", "outstanding_balance_usd", "credit_conversion_factor",
    "exposure_at_default", "ead_after_crm", "collateral_coverage_ratio", "final_rating",
    "rating_bucket", "probability_of_default", "loss_given_default", "expected_loss",
    "risk_weight", "risk_weight_floored", "risk_weighted_assets", "regulatory_capital",
    "calculation_method", "high_risk_flag", "data_quality_score", "created_timestamp",
]

# Warehouse types: (column, type, string length). Strings longer than the
# length are cut when a table is handed to the warehouse.
WAREHOUSE_DETAIL: list[tuple[str, str, int | None]] = [
    ("calculation_date", "date", None),
    ("loan_id", "string", 50),
    ("customer_id", "string", 50),
    ("product_type", "string", 20),
    ("asset_class", "string", 50),
    ("geography", "string", 10),
    ("rating_bucket", "string", 20),
    ("outstanding_balance_usd", "decimal(18,2)", None),
    ("credit_conversion_factor", "decimal(5,4)", None),
    ("exposure_at_default", "decimal(18,2)", None),
    ("ead_after_crm", "decimal(18,2)", None),
    ("collateral_coverage_ratio", "decimal(5,4)", None),
    ("probability_of_default", "decimal(8,6)", None),
    ("loss_given_default", "decimal(5,4)", None),
    ("expected_loss", "decimal(18,2)", None),
    ("risk_weight", "decimal(5,4)", None),
    ("risk_weight_floored", "decimal(5,4)", None),
    ("risk_weighted_assets", "decimal(18,2)", None),
    ("regulatory_capital", "decimal(18,2)", None),
    ("calculation_method", "string", 50),
    ("basel_version", "string", 10),
    ("high_risk_flag", "boolean", None),
    ("data_quality_score", "decimal(3,2)", None),
    ("created_timestamp", "timestamp_ntz", None),
]

WAREHOUSE_SUMMARY: list[tuple[str, str, int | None]] = [
    ("calculation_date", "date", None),
    ("asset_class", "string", 50),
    ("geography", "string", 10),
    ("rating_bucket", "string", 20),
    ("loan_count", "int", None),
    ("total_exposure", "decimal(20,2)", None),
    ("total_ead", "decimal(20,2)", None),
    ("total_rwa", "decimal(20,2)", None),
    ("total_regulatory_capital", "decimal(20,2)", None),
    ("total_expected_loss", "decimal(20,2)", None),
    ("avg_risk_weight", "decimal(5,4)", None),
    ("avg_pd", "decimal(8,6)", None),
    ("avg_lgd", "decimal(5,4)", None),
    ("capital_ratio", "decimal(5,4)", None),
    ("rwa_density", "decimal(5,4)", None),
    ("high_risk_count", "int", None),
    ("avg_data_quality", "decimal(3,2)", None),
    ("rwa_change_pct", "decimal(6,2)", None),
]

# Columns the warehouse export of the fact carries.
EXPORT_COLUMNS = [
    "calculation_date", "loan_id", "customer_id", "asset_class", "geography",
    "outstanding_balance_usd", "risk_weighted_assets", "regulatory_capital",
    "risk_weight", "rating_bucket", "high_risk_flag",
]

CHECK_RESULT = _struct(
    "check_type string, table_name string, item string, is_valid boolean, "
    "metric double, threshold double"
).add("detail", T.MapType(T.StringType(), T.StringType()))
