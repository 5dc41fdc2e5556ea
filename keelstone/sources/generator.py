"""Synthetic portfolios of any size.

Every value is a function of the row's number, a field name and the seed, taken
from a digest that every engine computes alike. So the generator is one narrow
projection over row numbers: no state, no join, and any row can be recomputed
after a lost task with the same result. A loan derives its customer's attributes
from the customer's number instead of looking them up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone.functions.literals import literal_array
from keelstone.operators import aggregates
from keelstone.sources.reference import literal_table

# --------------------------------------------------------------------------
# Domains and ranges of the sample portfolio.
# --------------------------------------------------------------------------
BASE_DATE = dt.date(2025, 12, 1)

CUSTOMER_TYPES = ["RETAIL", "SME", "CORPORATE", "FINANCIAL_INSTITUTION"]
INDUSTRIES = ["MANUFACTURING", "RETAIL_TRADE", "REAL_ESTATE", "TECHNOLOGY",
              "HEALTHCARE", "FINANCIAL", "ENERGY", "CONSUMER_GOODS"]
COUNTRIES = ["US", "GB", "DE", "FR", "JP", "CN", "CA", "AU"]

# customer type -> (lowest, highest)
TOTAL_ASSETS = {
    "RETAIL": (10_000, 1_000_000),
    "SME": (500_000, 50_000_000),
    "CORPORATE": (50_000_000, 10_000_000_000),
    "FINANCIAL_INSTITUTION": (1_000_000_000, 100_000_000_000),
}
ANNUAL_REVENUE = {
    "RETAIL": (20_000, 200_000),
    "SME": (1_000_000, 100_000_000),
    "CORPORATE": (100_000_000, 50_000_000_000),
    "FINANCIAL_INSTITUTION": (500_000_000, 20_000_000_000),
}
LOAN_BALANCE = {
    "RETAIL": (5_000, 500_000),
    "SME": (100_000, 5_000_000),
    "CORPORATE": (1_000_000, 100_000_000),
    "FINANCIAL_INSTITUTION": (1_000_000, 100_000_000),
}
PRODUCTS = {
    "RETAIL": ["MORTGAGE", "HOME_LOAN", "PERSONAL_LOAN", "CREDIT_CARD"],
    "SME": ["SME_LOAN", "TERM_LOAN", "REVOLVING_CREDIT"],
    "CORPORATE": ["CORPORATE_LOAN", "TERM_LOAN", "REVOLVING_CREDIT"],
    "FINANCIAL_INSTITUTION": ["CORPORATE_LOAN", "TERM_LOAN", "REVOLVING_CREDIT"],
}
REVOLVING = ["REVOLVING_CREDIT", "CREDIT_CARD"]

# value -> weight in percent
RATING_WEIGHTS = {"AAA": 5, "AA": 10, "A": 20, "BBB": 35, "BB": 20, "B": 10}
CUSTOMER_PD = {"AAA": 0.0001, "AA": 0.0003, "A": 0.0008, "BBB": 0.002, "BB": 0.008, "B": 0.025}
LOAN_CURRENCIES = {"USD": 50, "EUR": 25, "GBP": 15, "JPY": 5, "CNY": 5}
COLLATERAL_CURRENCIES = {"USD": 60, "EUR": 25, "GBP": 15}

BASE_HAIRCUTS = {
    "REAL_ESTATE_RESIDENTIAL": 0.15,
    "REAL_ESTATE_COMMERCIAL": 0.25,
    "CASH_DEPOSIT": 0.00,
    "SECURITIES_LISTED": 0.20,
    "SECURITIES_UNLISTED": 0.40,
    "RECEIVABLES": 0.30,
    "INVENTORY": 0.50,
    "EQUIPMENT": 0.40,
}
HAIRCUT_NOISE = 0.05
COLLATERAL_VALUE = (50_000, 5_000_000)
ENFORCEABLE_SHARE = 0.75

AGENCIES = ["S&P", "MOODY", "FITCH"]
COMMON_NOTCHES = ["AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+",
                  "BBB", "BBB-", "BB+", "BB", "BB-", "B+", "B", "B-"]
MOODY_NOTCHES = ["Aaa", "Aa1", "Aa2", "Aa3", "A1", "A2", "A3", "Baa1",
                 "Baa2", "Baa3", "Ba1", "Ba2", "Ba3", "B1", "B2", "B3"]
OUTLOOKS = ["POSITIVE", "STABLE", "NEGATIVE"]
RATED_TYPES = ["CORPORATE", "FINANCIAL_INSTITUTION"]
RATED_SHARE = 0.70

FX_BASE = {"EURUSD": 1.10, "GBPUSD": 1.27, "JPYUSD": 0.0067, "CNYUSD": 0.14}
# --------------------------------------------------------------------------


def uniform(number: Column, field: str, seed: int) -> Column:
    """A number in [0, 1) that depends on row number, field and seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{field}:"), number.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


class Draw:
    """Draws for one row number."""

    def __init__(self, number: Column, seed: int):
        self.number, self.seed = number, seed

    def uniform(self, field: str) -> Column:
        return uniform(self.number, field, self.seed)

    def below(self, field: str, n: int | Column) -> Column:
        """An integer in [0, n)."""
        return F.floor(self.uniform(field) * (n if isinstance(n, Column) else F.lit(n)))

    def choice(self, field: str, values: Sequence[str]) -> Column:
        index = self.below(field, len(values)).cast("int") + 1
        return F.element_at(literal_array(values), index)

    def weighted(self, field: str, weights: dict[str, int]) -> Column:
        """A value chosen by weights that add up to 100."""
        point = self.uniform(field) * F.lit(100.0)
        out, reached = None, 0
        for value, weight in weights.items():
            reached += weight
            hit = point < reached
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out.otherwise(list(weights)[-1])

    def between(self, field: str, low: Column | float, high: Column | float) -> Column:
        low = low if isinstance(low, Column) else F.lit(float(low))
        high = high if isinstance(high, Column) else F.lit(float(high))
        return low + self.uniform(field) * (high - low)

    def days(self, field: str, low: int, high: int) -> Column:
        """A whole number of days in [low, high]."""
        return (self.below(field, high - low + 1) + low).cast("int")


def per_type(kind: Column, table: dict[str, object]) -> Column:
    """Value of the customer type."""
    out = None
    for name, value in table.items():
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return out


def _customer_type(draw: Draw) -> Column:
    return draw.choice("customer_type", CUSTOMER_TYPES)


def _customer_rating(draw: Draw) -> Column:
    return draw.weighted("internal_rating", RATING_WEIGHTS)


def _customer_country(draw: Draw) -> Column:
    return draw.choice("country", COUNTRIES)


def _range(draw: Draw, field: str, kind: Column, table: dict[str, tuple[int, int]]) -> Column:
    low = per_type(kind, {k: float(v[0]) for k, v in table.items()})
    high = per_type(kind, {k: float(v[1]) for k, v in table.items()})
    return draw.between(field, low, high)


def customers(numbers: DataFrame, seed: int = 42) -> DataFrame:
    """Counterparties for a frame with a column ``id`` of row numbers from 1."""
    draw = Draw(F.col("id"), seed)
    kind, rating = F.col("customer_type"), F.col("internal_rating")
    return numbers.select(
        "id",
        F.format_string("C%06d", "id").alias("customer_id"),
        _customer_type(draw).alias("customer_type"),
        draw.choice("industry", INDUSTRIES).alias("industry_code"),
        _customer_country(draw).alias("country_code"),
        _customer_rating(draw).alias("internal_rating"),
    ).select(
        "customer_id", "customer_type", "industry_code", "country_code",
        _range(draw, "total_assets", kind, TOTAL_ASSETS).alias("total_assets"),
        _range(draw, "annual_revenue", kind, ANNUAL_REVENUE).alias("annual_revenue"),
        "internal_rating",
        rating.alias("credit_rating"),
        per_type(rating, CUSTOMER_PD).alias("default_probability"),
    )


def collateral(numbers: DataFrame, seed: int = 42) -> DataFrame:
    draw = Draw(F.col("id"), seed)
    kind = F.col("collateral_type")
    noise = draw.between("haircut", -HAIRCUT_NOISE, HAIRCUT_NOISE)
    haircut = F.least(F.lit(1.0), F.greatest(F.lit(0.0), per_type(kind, BASE_HAIRCUTS) + noise))
    return numbers.select(
        "id",
        F.format_string("COL%07d", "id").alias("collateral_id"),
        draw.choice("collateral_type", list(BASE_HAIRCUTS)).alias("collateral_type"),
    ).select(
        "collateral_id",
        "collateral_type",
        draw.between("market_value", *COLLATERAL_VALUE).alias("market_value"),
        draw.weighted("currency", COLLATERAL_CURRENCIES).alias("currency"),
        F.date_sub(F.lit(BASE_DATE), draw.days("valuation", 1, 365)).alias("valuation_date"),
        haircut.alias("haircut_percentage"),
        (draw.uniform("enforceable") < ENFORCEABLE_SHARE).alias("legal_enforceability_flag"),
    )


def loans(
    numbers: DataFrame,
    n_customers: int | Column,
    n_collateral: int | Column,
    seed: int = 42,
    skew_share: float = 0.20,
    heavy: int = 20,
) -> DataFrame:
    """Loans, of which ``skew_share`` belong to the customers numbered 1 to ``heavy``."""
    draw = Draw(F.col("id"), seed)
    n_customers = n_customers if isinstance(n_customers, Column) else F.lit(n_customers)
    heavy_pick = draw.below("heavy", F.least(F.lit(heavy), n_customers))
    any_pick = draw.below("customer", n_customers)
    owner = F.when(draw.uniform("skew") < skew_share, heavy_pick).otherwise(any_pick) + 1
    of_owner = Draw(F.col("owner"), seed)
    kind, balance = F.col("owner_type"), F.col("balance")
    product = per_type(kind, {k: draw.choice("product", v) for k, v in PRODUCTS.items()})
    drawn_up = F.when(
        F.col("product_type").isin(REVOLVING), balance * draw.between("undrawn", 1.2, 1.5)
    ).otherwise(balance)
    pledged = F.when(
        draw.uniform("has_collateral") < 0.5,
        F.format_string("COL%07d", draw.below("collateral", n_collateral) + 1),
    )
    return (
        numbers.select("id", owner.alias("owner"))
        .withColumn("owner_type", _customer_type(of_owner))
        .withColumns({"product_type": product, "balance": _range(draw, "balance", kind, LOAN_BALANCE)})
        .select(
            F.format_string("L%07d", "id").alias("loan_id"),
            F.format_string("C%06d", "owner").alias("customer_id"),
            "product_type",
            F.date_sub(F.lit(BASE_DATE), draw.days("origination", 365, 1825)).alias("origination_date"),
            F.date_add(F.lit(BASE_DATE), draw.days("maturity", 365, 3650)).alias("maturity_date"),
            balance.alias("outstanding_balance"),
            draw.weighted("loan_currency", LOAN_CURRENCIES).alias("currency"),
            _customer_rating(of_owner).alias("internal_rating"),
            _customer_country(of_owner).alias("country_code"),
            pledged.alias("collateral_id"),
            drawn_up.alias("exposure_at_default"),
        )
    )


def ratings(numbers: DataFrame, seed: int = 42) -> DataFrame:
    """One to three agency ratings for 70 % of the corporate customers."""
    draw = Draw(F.col("id"), seed)
    rated = numbers.select("id", _customer_type(draw).alias("kind")).where(
        F.col("kind").isin(RATED_TYPES) & (draw.uniform("rated") < RATED_SHARE)
    )
    # a run of 1 to 3 agencies from a random first one, so none occurs twice
    count = draw.below("agencies", len(AGENCIES)) + 1
    first = draw.below("first_agency", len(AGENCIES))
    one = Draw(F.concat(F.col("id").cast("string"), F.lit("/"), F.col("agency")), seed)
    common, moody = one.choice("notch", COMMON_NOTCHES), one.choice("notch", MOODY_NOTCHES)
    index = ((F.col("step") + first) % len(AGENCIES)).cast("int") + 1
    return (
        rated.select("id", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("step"))
        .withColumn("agency", F.element_at(literal_array(AGENCIES), index))
        .select(
            F.format_string("C%06d", "id").alias("customer_id"),
            F.col("agency").alias("rating_agency"),
            F.when(F.col("agency") == "MOODY", moody).otherwise(common).alias("rating"),
            F.date_sub(F.lit(BASE_DATE), one.days("rating_date", 1, 180)).alias("rating_date"),
            one.choice("outlook", OUTLOOKS).alias("outlook"),
        )
    )


def fx_rates(spark: SparkSession, seed: int = 42) -> DataFrame:
    base = literal_table(
        spark, [("currency_pair", "string"), ("base", "double")], FX_BASE.items()
    )
    wobble = F.lit(0.98) + uniform(F.col("currency_pair"), "fx", seed) * F.lit(0.04)
    return base.select(
        "currency_pair",
        F.round(F.col("base") * wobble, 6).alias("rate"),
        F.lit(BASE_DATE).alias("date"),
        F.lit("SIMULATED").alias("source"),
    )


def rounded_money(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def generate_portfolio(
    spark: SparkSession,
    n_loans: int = 10_000,
    n_customers: int = 1_000,
    n_collateral: int = 5_000,
    seed: int = 42,
    skew_share: float = 0.20,
    heavy: int = 20,
) -> dict[str, DataFrame]:
    """All five tables. Amounts have cents, haircuts four digits."""

    def numbers(n: int) -> DataFrame:
        return spark.range(1, n + 1)

    return {
        "counterparty": rounded_money(
            customers(numbers(n_customers), seed), "total_assets", "annual_revenue"
        ),
        "collateral": rounded_money(
            rounded_money(collateral(numbers(n_collateral), seed), "market_value"),
            "haircut_percentage", digits=4,
        ),
        "loans": rounded_money(
            loans(numbers(n_loans), n_customers, n_collateral, seed, skew_share, heavy),
            "outstanding_balance", "exposure_at_default",
        ),
        "ratings": ratings(numbers(n_customers), seed),
        "fx": fx_rates(spark, seed),
    }


def profile(loans_df: DataFrame, customers_df: DataFrame, threshold: int = 100) -> DataFrame:
    """Totals, mixes and skew of a portfolio as rows of attribute, value and number."""
    totals = aggregates.portfolio_profile(loans_df)
    skew = aggregates.skew_profile(loans_df, threshold=threshold)

    def unpivot(one_row: DataFrame, attribute: str) -> DataFrame:
        pairs = [
            F.struct(F.lit(c).alias("value"), F.col(c).cast("double").alias("number"))
            for c in one_row.columns
        ]
        return one_row.select(F.lit(attribute).alias("attribute"), F.inline(F.array(*pairs)))

    def counted(df: DataFrame, column: str) -> DataFrame:
        return aggregates.mix(df, column).select(
            "attribute", "value", F.col("row_count").cast("double").alias("number")
        )

    out = unpivot(totals, "loans").unionByName(unpivot(skew, "skew"))
    return out.unionByName(counted(customers_df, "customer_type")).unionByName(
        counted(customers_df, "internal_rating")
    )
