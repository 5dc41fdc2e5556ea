"""Formula cases with known results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keelstone.functions import codes, risk
from keelstone.functions.numeric import Numeric
from keelstone.operators import aggregates, detail, filters
from keelstone.params import Settings

DAY = dt.date(2025, 12, 1)

ENRICHED = (
    "loan_id string, customer_id string, product_type string, asset_class string, "
    "country_code string, outstanding_balance_usd double, internal_rating string, rating string, "
    "collateral_type string, adjusted_collateral_value_usd double, days_to_maturity int"
)


def loan(**values):
    base = {
        "loan_id": "L1", "customer_id": "C1", "product_type": "CORPORATE_LOAN",
        "asset_class": "CORPORATE_LARGE", "country_code": "US",
        "outstanding_balance_usd": 1_000_000.0, "internal_rating": "BBB", "rating": None,
        "collateral_type": None, "adjusted_collateral_value_usd": None, "days_to_maturity": 900,
    }
    return tuple((base | values)[c.split(" ")[0]] for c in ENRICHED.split(", "))


def calculated(spark, *loans, settings=Settings(), **options):
    frame = spark.createDataFrame(list(loans), ENRICHED)
    return detail.calculate(frame, DAY, settings, **options).orderBy("loan_id").collect()


def test_aaa_corporate(spark):
    (r,) = calculated(spark, loan(outstanding_balance_usd=1e8, internal_rating="AAA"))
    assert r.exposure_at_default == r.ead_after_crm == 1e8
    assert r.risk_weight == 0.20
    assert r.risk_weighted_assets == 2e7
    assert r.regulatory_capital == pytest.approx(1.6e6)


def test_mortgage_with_collateral(spark):
    (r,) = calculated(
        spark,
        loan(
            asset_class="RETAIL_MORTGAGE", product_type="MORTGAGE", internal_rating="AAA",
            outstanding_balance_usd=200_000.0, adjusted_collateral_value_usd=160_000.0,
            collateral_type="REAL_ESTATE_RESIDENTIAL",
        ),
    )
    assert r.collateral_coverage_ratio == pytest.approx(0.8)
    assert r.ead_after_crm == pytest.approx(40_000)
    assert r.risk_weighted_assets == pytest.approx(14_000)


def test_unsecured_b_rated_corporate(spark):
    (r,) = calculated(spark, loan(outstanding_balance_usd=5e7, internal_rating="B"))
    assert r.risk_weighted_assets == 7.5e7 > r.exposure_at_default
    assert r.high_risk_flag


def test_committed_line_is_converted(spark):
    (r,) = calculated(
        spark, loan(product_type="COMMITTED_LINE", asset_class="CORPORATE_SME",
                    outstanding_balance_usd=1e7),
    )
    assert r.credit_conversion_factor == 0.5
    assert r.exposure_at_default == 5e6
    assert r.risk_weighted_assets == 3.75e6


def test_worked_example(spark):
    """1M to a BBB corporate, 300k collateral: 700k assets, 56k capital."""
    (r,) = calculated(
        spark, loan(adjusted_collateral_value_usd=300_000.0, collateral_type="CASH_DEPOSIT")
    )
    assert r.risk_weighted_assets == pytest.approx(700_000)
    assert r.regulatory_capital == pytest.approx(56_000)
    assert r.loss_given_default == 0.0


def test_expected_loss(spark):
    frame = spark.createDataFrame([(1e6, 0.05, 0.45)], "ead double, pd double, lgd double")
    loss = risk.expected_loss(F.col("ead"), F.col("pd"), F.col("lgd"))
    assert frame.select(loss).first()[0] == pytest.approx(22_500)


def test_totals_of_several_loans(spark):
    frame = spark.createDataFrame([(2e7,), (1.75e7,), (1.875e7,)], "rwa double")
    total = frame.agg(F.sum("rwa").alias("rwa"))
    capital = total.select("rwa", risk.regulatory_capital(F.col("rwa")).alias("c")).first()
    assert capital.rwa == 5.625e7
    assert capital.c == pytest.approx(4.5e6)


def test_only_positive_balances_stay(spark):
    frame = spark.createDataFrame(
        [("a", 0.0), ("b", -1000.0), ("c", None), ("d", 1.0)], "loan_id string, outstanding_balance double"
    )
    assert [r.loan_id for r in filters.positive_balance(frame).collect()] == ["d"]


@pytest.mark.parametrize(
    ("collateral", "ead", "coverage"),
    [(150_000.0, 100_000.0, 1.0), (None, 100_000.0, 0.0), (10.0, 0.0, 1.0), (0.0, 100.0, 0.0)],
)
def test_coverage_is_capped_and_never_null(spark, collateral, ead, coverage):
    frame = spark.createDataFrame([(collateral, ead)], "c double, e double")
    covered = risk.collateral_coverage(F.col("c"), F.col("e"))
    after = risk.ead_after_mitigation(F.col("e"), covered)
    got = frame.select(covered.alias("covered"), after.alias("after")).first()
    assert got.covered == coverage
    assert got.after == ead * (1 - coverage)


def test_floor_binds_only_for_its_class(spark):
    frame = spark.createDataFrame(
        [("RETAIL_MORTGAGE", 0.05), ("RETAIL_MORTGAGE", 0.35), ("OTHER", 0.05)],
        "asset_class string, w double",
    )
    floored = risk.floored_weight(F.col("asset_class"), F.col("w"))
    assert [r[0] for r in frame.select(floored).collect()] == [0.10, 0.35, 0.05]


def test_rating_order_bucket_and_score(spark):
    got = calculated(
        spark,
        loan(loan_id="1", rating="AA-", internal_rating="B"),
        loan(loan_id="2", rating=None, internal_rating="CC"),
        loan(loan_id="3", rating=None, internal_rating=None),
        loan(loan_id="4", rating="D"),
        loan(loan_id="5", rating="Baa1"),
    )
    assert [r.final_rating for r in got] == ["AA-", "CC", "BBB", "D", "Baa1"]
    assert [r.rating_bucket for r in got] == ["AAA", "CCC", "BBB", "BBB", "BBB"]
    assert [r.data_quality_score for r in got] == [1.0, 0.8, 0.5, 1.0, 1.0]


def test_unknown_pairs_use_default_weight(spark):
    got = calculated(
        spark,
        loan(loan_id="1", asset_class="RETAIL_OTHER", internal_rating="CCC"),
        loan(loan_id="2", asset_class="OTHER", internal_rating="AAA"),
    )
    assert [r.risk_weight for r in got] == [1.0, 1.0]


@pytest.mark.parametrize(
    ("days", "rating", "flag"),
    [(29, "AAA", True), (30, "AAA", False), (None, "AAA", False), (900, "CCC", True), (900, "BB", False)],
)
def test_high_risk_flag(spark, days, rating, flag):
    (r,) = calculated(spark, loan(days_to_maturity=days, internal_rating=rating))
    assert r.high_risk_flag is flag


def test_exact_mode_agrees_to_the_cent(spark):
    loans = [
        loan(loan_id=str(i), outstanding_balance_usd=1000.37 * (i + 1), internal_rating=rating,
             adjusted_collateral_value_usd=333.33 * i or None)
        for i, rating in enumerate(["AAA", "A", "BBB", "BB", "B", "CCC", None])
    ]
    plain = calculated(spark, *loans)
    exact = calculated(spark, *loans, settings=Settings(exact=True))
    for a, b in zip(plain, exact, strict=True):
        assert float(b.risk_weighted_assets) == pytest.approx(a.risk_weighted_assets, abs=0.02)
        assert float(b.regulatory_capital) == pytest.approx(a.regulatory_capital, abs=0.02)
        assert b.risk_weighted_assets.as_tuple().exponent == -2


def test_exact_sums_do_not_depend_on_order(spark, sf_dir):
    from keelstone.sources import testviews as tv

    fact = tv.fact(spark, sf_dir, settings=Settings(exact=True))
    whole = fact.agg(F.sum("risk_weighted_assets")).first()[0]
    parts = aggregates.summary(fact.repartition(7)).agg(F.sum("total_rwa")).first()[0]
    assert whole == parts


def test_created_time_is_given_not_taken(spark):
    when = dt.datetime(2025, 12, 1, 6, 30)
    (a,) = calculated(spark, loan(), created=when)
    (b,) = calculated(spark, loan(), created=when)
    assert a == b
    assert a.created_timestamp == when


def test_numeric_constants(spark):
    kinds = spark.range(1).select(
        Numeric(True).constant(0.08).alias("e"), Numeric().constant(0.08).alias("d")
    )
    assert [f.dataType.simpleString() for f in kinds.schema.fields] == ["decimal(6,6)", "double"]


def test_notch_translation(spark):
    frame = spark.createDataFrame([("BAA1",), ("AA+",), ("B2",), ("??",)], "r string")
    got = frame.select(codes.common_notch(F.col("r"))).collect()
    assert [r[0] for r in got] == ["BBB+", "AA+", "B", "??"]
