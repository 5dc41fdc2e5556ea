"""The given tables seen as a loan portfolio.

orders become loans, customers counterparties, parts collateral and events agency
ratings, by fixed integer arithmetic, so that any engine can derive the same views.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone import params
from keelstone.functions.codes import recode
from keelstone.functions.literals import literal_array
from keelstone.operators import detail as detail_ops
from keelstone.operators import standardise
from keelstone.params import DEFAULTS, Settings
from keelstone.sources.reference import literal_table

AS_OF = dt.date(2001, 8, 1)

# Hot-customer threshold that fits the evenly spread orders of these tables.
HOT_THRESHOLD = 15

PRODUCTS = [
    " mortgage ", "HOME_LOAN", "personal_loan", "CREDIT_CARD", "SME_LOAN",
    "CORPORATE_LOAN", "TERM_LOAN", "REVOLVING_CREDIT", "COMMITTED_LINE",
]
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CNY"]
RATINGS = ["AAA", "AA-", "A+", "BBB", "BB-", "B", "CCC", None]
COUNTRIES = ["US", "GB", "DE", "FR", "JP", "CN", "CA", "AU"]
COLLATERAL_TYPES = [t for t in params.LOSS_GIVEN_DEFAULT if t != "UNCOLLATERALIZED"]
AGENCIES = {"click": "S&P", "view": "MOODY", "signup": "FITCH", "purchase": "S&P", "error": "FITCH"}
FX_RATES = [("EURUSD", 1.10), ("GBPUSD", 1.27), ("JPYUSD", 0.0067), ("CNYUSD", 0.14)]


# Schemas of the given tables, so that opening one reads no file footers.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, index: Column) -> Column:
    return F.element_at(literal_array(values), (index + 1).cast("int"))


def loans(
    spark: SparkSession, sf_dir: str, raw: bool = False, with_customer: bool = True
) -> DataFrame:
    """Orders as loans. ``raw`` has invalid balances; currency and country need the customer."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice")
    if raw:
        price = F.when(key % 97 == 0, -price).otherwise(price)
    opened = F.col("o_orderdate").cast("date")
    df = table(spark, sf_dir, "orders")
    if with_customer:
        nation = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        df = df.join(nation, F.col("o_custkey") == F.col("c_custkey"))
        located = [
            pick(CURRENCIES, F.col("c_nationkey") % 5).alias("currency"),
            pick(COUNTRIES, F.col("c_nationkey") % 8).alias("country_code"),
        ]
    else:
        located = [F.lit(None).cast("string").alias(c) for c in ("currency", "country_code")]
    return df.select(
        F.concat(F.lit("L"), key).alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        pick(PRODUCTS, key % 9).alias("product_type"),
        opened.alias("origination_date"),
        F.date_add(opened, (365 * (1 + key % 10)).cast("int")).alias("maturity_date"),
        price.cast("decimal(18,2)").alias("outstanding_balance"),
        pick(RATINGS, F.col("o_custkey") % 8).alias("internal_rating"),
        F.when(key % 2 == 0, key % 200).alias("collateral_id"),
        *located,
    )


def loan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two join keys of every loan: what it takes to find hot keys."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.when(key % 2 == 0, key % 200).alias("collateral_id"),
    )


def counterparty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("customer_type"),
        F.col("c_acctbal").alias("total_assets"),
        pick(COUNTRIES, F.col("c_nationkey") % 8).alias("country_code"),
    )


def collateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("collateral_id"),
        pick(COLLATERAL_TYPES, key % 8).alias("collateral_type"),
        (F.col("p_retailprice") * (1 + F.col("p_size")) * 10).alias("market_value"),
        pick(CURRENCIES[:3], key % 3).alias("currency"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), (key * 7 % 577).cast("int")).alias("valuation_date"),
        ((key % 5) * F.lit(0.1)).alias("haircut_percentage"),
        (key % 4 != 0).alias("legal_enforceability_flag"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"),
        recode(F.col("event_type"), AGENCIES).alias("rating_agency"),
        pick(list(params.RATING_SCALE), F.col("event_id") % 22).alias("rating"),
        F.col("ts").cast("date").alias("rating_date"),
        F.col("event_id"),
    )


def fx(spark: SparkSession) -> DataFrame:
    rows = [(pair, rate, AS_OF, "FIXED") for pair, rate in FX_RATES]
    return literal_table(
        spark,
        [("currency_pair", "string"), ("rate", "double"), ("date", "date"), ("source", "string")],
        rows,
    )


# Standardised ---------------------------------------------------------------


def clean_loans(spark: SparkSession, sf_dir: str, as_of=AS_OF, **options) -> DataFrame:
    return standardise.standardise_loans(loans(spark, sf_dir, raw=True), as_of, **options)


def clean_collateral(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> DataFrame:
    return standardise.standardise_collateral(collateral(spark, sf_dir), as_of)


def clean_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise.standardise_ratings(ratings(spark, sf_dir), tie_break=["event_id"])


def clean_fx(spark: SparkSession) -> DataFrame:
    return standardise.standardise_fx(fx(spark))


def as_of_for(grain: str):
    """Calculation date of a loan: the fixed run date, or its own month or day."""
    opened = F.col("origination_date")
    return {
        "run": AS_OF,
        "month": F.trunc(opened, "month"),
        "day": opened,
    }[grain]


def fact(spark: SparkSession, sf_dir: str, grain: str = "run", settings: Settings = DEFAULTS) -> DataFrame:
    """The per-loan result. Grains month and day give several calculation dates."""
    as_of = as_of_for(grain)
    return detail_ops.detail(
        clean_loans(spark, sf_dir, as_of),
        clean_ratings(spark, sf_dir),
        clean_collateral(spark, sf_dir),
        clean_fx(spark),
        as_of,
        settings,
        profile=loan_keys(spark, sf_dir),
    )
