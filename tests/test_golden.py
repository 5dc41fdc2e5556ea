"""Published totals of the smallest end-to-end slice.

All loans, unfiltered, rated internally only. The published totals add up group
values that were rounded to cents.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keelstone.operators import detail, fx, joins, standardise
from keelstone.sources import testviews as tv

SCALE = "/root/testdata/sf0.01"


def test_minimum_slice(spark):
    loans = standardise.standardise_loans(
        tv.loans(spark, SCALE), tv.AS_OF, drop_invalid=False, drop_matured=False
    )
    in_usd = fx.to_reporting_ccy(
        loans, tv.clean_fx(spark), "outstanding_balance", "outstanding_balance_usd"
    ).withColumn("rating", F.lit(None).cast("string"))
    pledged = joins.attach_collateral(
        in_usd, detail.converted_collateral(tv.clean_collateral(spark, SCALE), tv.clean_fx(spark))
    )
    groups = (
        detail.calculate(pledged, tv.AS_OF)
        .groupBy("asset_class", "rating_bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("exposure_at_default"), 2).alias("ead"),
            F.round(F.sum("risk_weighted_assets"), 2).alias("rwa"),
        )
        .collect()
    )
    assert len(groups) == 30
    assert sum(g.n for g in groups) == 15_000
    assert sum(g.ead for g in groups) == pytest.approx(2_491_458_567.56, abs=0.005)
    assert sum(g.rwa for g in groups) == pytest.approx(1_438_970_291.89, abs=0.005)
