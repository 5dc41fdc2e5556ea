"""Skew, missing keys, duplicates: the joins keep one row per loan."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings as hyp
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelstone.operators import fx, joins, ratings
from keelstone.params import Settings
from keelstone.sources import reference, testviews as tv


@pytest.fixture(scope="module")
def skewed(spark):
    """1,500 loans: a third on one customer, a third without one, the rest spread."""
    n = F.col("id")
    return spark.range(1500).select(
        F.concat(F.lit("L"), n).alias("loan_id"),
        F.when(n % 3 == 0, F.lit("C0")).when(n % 3 == 1, F.concat(F.lit("C"), n % 70)).alias("customer_id"),
        (n * 10).cast("double").alias("balance"),
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.range(60).select(
        F.concat(F.lit("C"), "id").alias("customer_id"), (F.col("id") * 7).alias("size")
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows_per_salt", [1_000_000, 7])
def test_salted_join_equals_plain_join(skewed, customers, rows, how, rows_per_salt):
    salted = joins.skew_join(
        skewed, customers, "customer_id", "loan_id", salts=10, how=how, rows_per_salt=rows_per_salt,
    )
    plain = skewed.join(customers, "customer_id", how)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_hot_customer_is_found_and_spread(skewed):
    hot = joins.spread_keys(skewed, "customer_id", salts=10)
    assert [(r.customer_id, r.n_salts) for r in hot.collect()] == [("C0", 10)]
    salted = joins.salt_rows(skewed, hot, "customer_id", "loan_id")
    used = salted.where("customer_id = 'C0'").select("_salt").distinct().collect()
    assert sorted(r[0] for r in used) == list(range(10))
    cold = salted.where("customer_id <> 'C0'").select("_salt").distinct().collect()
    assert [r[0] for r in cold] == [0]


def test_big_keys_get_more_parts(skewed):
    hot = joins.spread_keys(skewed, "customer_id", salts=10, rows_per_salt=20)
    assert hot.first().n_salts > 20


def test_every_key_above_the_threshold_is_found(spark):
    """Far more rows than 100,000 times the threshold: the table's size changes no answer."""
    rows = spark.range(1_600_000).select((F.col("id") % 200_000).alias("k"))
    found = joins.keys_above(rows, "k", threshold=7)
    assert found.count() == 200_000
    assert found.where("key_rows <> 8").count() == 0
    assert joins.keys_above(rows, "k", threshold=8).count() == 0


def test_keys_to_spread_are_bounded_by_their_share(spark):
    even = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert joins.spread_keys(even, "k", share=1 / 100, least=5).count() == 0
    assert joins.spread_keys(even, "k", share=1 / 101, least=5).count() == 100
    assert joins.spread_keys(even, "k", share=1 / 101, least=10).count() == 0


def test_rows_without_key_are_spread(skewed):
    hot = joins.spread_keys(skewed, "customer_id")
    salted = joins.salt_rows(skewed, hot, "customer_id", "loan_id")
    nulls = salted.where("customer_id is null")
    assert nulls.select("_salt").distinct().count() == nulls.count() == 500


def test_salts_do_not_change_between_runs(skewed, rows):
    hot = joins.spread_keys(skewed, "customer_id")
    first = joins.salt_rows(skewed, hot, "customer_id", "loan_id")
    again = joins.salt_rows(skewed.repartition(5), hot, "customer_id", "loan_id")
    assert rows(first) == rows(again)


@given(
    keys=st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=40),
    least=st.integers(0, 10),
)
@hyp(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_salted_join_property(spark, rows, keys, least):
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "loan_id long, k long")
    right = spark.createDataFrame([(k, f"v{k}") for k in (0, 1, 2, 9)], "k long, v string")
    salted = joins.skew_join(left, right, "k", "loan_id", least=least, salts=3)
    assert rows(salted) == rows(left.join(right, "k", "left"))


@pytest.mark.parametrize("mode", ["spread", "split", "plain"])
def test_collateral_modes_agree(spark, sf_dir, rows, mode):
    loans = tv.loans(spark, sf_dir, with_customer=False).select("loan_id", "collateral_id")
    side = tv.clean_collateral(spark, sf_dir).select("collateral_id", "market_value", "currency")
    expected = loans.join(
        side.withColumnRenamed("currency", "collateral_currency"), "collateral_id", "left"
    )
    got = joins.attach_collateral(loans, side, mode, least=5) if mode != "plain" else (
        joins.attach_collateral(loans, side, mode)
    )
    assert rows(got.select(*expected.columns)) == rows(expected)


def test_enrichment_keeps_one_row_per_loan(spark, sf_dir):
    """Although customers have several ratings and sides are duplicated."""
    loans = tv.clean_loans(spark, sf_dir)
    twice = tv.clean_collateral(spark, sf_dir).withColumn(
        "adjusted_collateral_value_usd", F.col("adjusted_collateral_value")
    )
    cpty = tv.counterparty(spark, sf_dir)
    out = joins.enrich(
        loans, tv.clean_ratings(spark, sf_dir), twice.unionByName(twice),
        counterparty=cpty.unionByName(cpty),
    )
    n = loans.count()
    assert out.count() == n == out.select("loan_id").distinct().count()
    assert "cpty_country_code" in out.columns
    assert out.columns.count("country_code") == 1


RATINGS = [
    ("C1", "S&P", "A", dt.date(2025, 1, 1)),
    ("C1", "S&P", "BB", dt.date(2025, 3, 1)),
    ("C1", "FITCH", "AA", dt.date(2025, 2, 1)),
    ("C1", "MOODY", "B", dt.date(2024, 1, 1)),
    ("C2", "S&P", "XYZ", dt.date(2025, 1, 1)),
    ("C2", "FITCH", "A", dt.date(2024, 1, 1)),
    ("C3", "FITCH", "nope", dt.date(2024, 1, 1)),
]


@pytest.mark.parametrize(
    ("policy", "expected"),
    [
        ("worst", {"C1": "B", "C2": "A", "C3": "NOPE"}),
        ("best", {"C1": "AA", "C2": "A", "C3": "NOPE"}),
        ("second_best", {"C1": "BB", "C2": "A", "C3": "NOPE"}),
        ("latest", {"C1": "BB", "C2": "XYZ", "C3": "NOPE"}),
    ],
)
def test_rating_policies(spark, policy, expected):
    from keelstone.operators import standardise

    raw = spark.createDataFrame(
        RATINGS, "customer_id string, rating_agency string, rating string, rating_date date"
    )
    clean = standardise.standardise_ratings(raw)
    assert clean.where("customer_id = 'C1'").count() == 3
    one = ratings.rating_per_customer(clean, policy)
    assert {r.customer_id: r.rating for r in one.collect()} == expected


def test_unknown_rating_policy(spark):
    with pytest.raises(ValueError, match="policy"):
        ratings.rating_per_customer(spark.range(1), "median")


@pytest.fixture
def fx_table(spark):
    return spark.createDataFrame(
        [
            ("EURUSD", 1.1, dt.date(2025, 1, 1)), ("EURUSD", 1.2, dt.date(2025, 1, 2)),
            ("USDJPY", 150.0, dt.date(2025, 1, 2)), ("USDEUR", 0.5, dt.date(2025, 1, 3)),
            ("EURGBP", 0.9, dt.date(2025, 1, 2)),
        ],
        "currency_pair string, rate double, date date",
    )


def test_conversion(spark, fx_table):
    """Direct beats inverse, newer beats older, one row per currency."""
    rates = {r.fx_currency: r.fx_rate for r in fx.conversion_rates(fx_table).collect()}
    assert rates == {"EUR": 1.2, "JPY": pytest.approx(1 / 150)}
    money = spark.createDataFrame(
        [("a", "USD", 100.0), ("b", "EUR", 100.0), ("c", "JPY", 150.0), ("d", "XXX", 100.0)],
        "id string, currency string, amount double",
    )
    got = fx.to_reporting_ccy(money, fx_table, "amount", "usd").orderBy("id").collect()
    assert [r.usd for r in got] == [100.0, 120.0, pytest.approx(1.0), 100.0]
    strict = fx.to_reporting_ccy(
        money, fx_table, "amount", "usd", settings=Settings(missing_fx="null")
    ).orderBy("id").collect()
    assert [r.usd for r in strict] == [100.0, 120.0, pytest.approx(1.0), None]


def test_effective_dates_are_half_open(spark):
    split = dt.date(2020, 1, 1)
    ref = reference.effective_risk_weights(
        spark, [("a", dt.date(2013, 1, 1), split, 1.0), ("b", split, None, 2.0)]
    )
    facts = spark.createDataFrame(
        [
            ("before", dt.date(2012, 12, 31)), ("first", dt.date(2013, 1, 1)),
            ("last", dt.date(2019, 12, 31)), ("next", split), ("open", dt.date(2099, 1, 1)),
        ],
        "id string, calculation_date date",
    ).withColumns({"asset_class": F.lit("CORPORATE_LARGE"), "rating_bucket": F.lit("A")})
    got = joins.as_of_lookup(facts, ref, ["asset_class", "rating_bucket"]).collect()
    weights = {r.id: r.effective_risk_weight and float(r.effective_risk_weight) for r in got}
    assert weights == {"before": None, "first": 0.5, "last": 0.5, "next": 1.0, "open": 1.0}


def test_clashing_collateral_columns_are_prefixed(spark, rows):
    loans = spark.createDataFrame(
        [("L1", "K1", "USD", 1), ("L2", None, "EUR", 2)],
        "loan_id string, collateral_id string, currency string, batch int",
    )
    side = spark.createDataFrame(
        [("K1", "GBP", 9, 5.0)], "collateral_id string, currency string, batch int, value double"
    )
    for mode in ("spread", "split", "plain"):
        out = joins.attach_collateral(loans, side, mode)
        names = ["loan_id", "currency", "batch", "collateral_currency", "collateral_batch", "value"]
        assert sorted(out.columns) == sorted([*names, "collateral_id"])
        assert rows(out.select(*names)) == [
            ("L1", "USD", 1, "GBP", 9, 5.0), ("L2", "EUR", 2, None, None, None),
        ]
