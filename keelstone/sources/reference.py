"""Reference tables with a fixed number of rows.

Built from ``VALUES``, so they are local relations with exact statistics: no
job, no Python worker. They hold tens of rows by construction, which is the
bound that makes ``F.broadcast`` on them safe at any data size.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone import params
from keelstone.functions.literals import sql_literal


def literal_table(
    spark: SparkSession, columns: Sequence[tuple[str, str]], rows: Iterable[Sequence[object]]
) -> DataFrame:
    """A small literal table; ``columns`` are ``(name, type)`` pairs."""
    rows = list(rows)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in columns])
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{n}`" for n, _ in columns)
    typed = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in columns)
    return spark.sql(f"SELECT {typed} FROM VALUES {body} AS t({names})")


def risk_weights(spark: SparkSession, table=None) -> DataFrame:
    table = params.RISK_WEIGHTS if table is None else table
    return literal_table(
        spark,
        [("asset_class", "string"), ("rating_bucket", "string"), ("risk_weight", "double")],
        [(cls, bucket, w) for cls, row in table.items() for bucket, w in row.items()],
    )


def ccf_table(spark: SparkSession, table=None) -> DataFrame:
    table = params.CREDIT_CONVERSION if table is None else table
    return literal_table(spark, [("exposure_type", "string"), ("ccf", "double")], table.items())


def lgd_table(spark: SparkSession, table=None) -> DataFrame:
    table = params.LOSS_GIVEN_DEFAULT if table is None else table
    return literal_table(spark, [("collateral_type", "string"), ("lgd", "double")], table.items())


def standard_haircuts(spark: SparkSession, table=None) -> DataFrame:
    table = params.STANDARD_HAIRCUTS if table is None else table
    return literal_table(
        spark, [("collateral_type", "string"), ("standard_haircut", "double")], table.items()
    )


def effective_risk_weights(spark: SparkSession, versions=None) -> DataFrame:
    """Effective-dated weights.

    ``versions`` is a list of ``(edition, effective_date, end_date, factor)``;
    the default is the single edition in force, open ended.
    """
    if versions is None:
        versions = [(params.WEIGHTS_EDITION, params.WEIGHTS_EFFECTIVE_FROM, None, 1.0)]
    rows = [
        (cls, bucket, row[bucket] * factor, edition, start, end, end is None)
        for edition, start, end, factor in versions
        for cls, row in params.RISK_WEIGHTS.items()
        for bucket in params.EFFECTIVE_BUCKETS
    ]
    return literal_table(
        spark,
        [
            ("asset_class", "string"), ("rating_bucket", "string"),
            ("risk_weight", "decimal(5,4)"), ("basel_version", "string"),
            ("effective_date", "date"), ("end_date", "date"), ("is_current", "boolean"),
        ],
        rows,
    )


def dim_asset_class(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark,
        [
            ("asset_class", "string"), ("asset_category", "string"),
            ("basel_exposure_class", "string"), ("description", "string"),
            ("is_retail", "boolean"), ("default_risk_weight", "decimal(5,4)"),
        ],
        params.ASSET_CLASS_DIMENSION,
    )


def dim_geography(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark,
        [
            ("geography_code", "string"), ("country_name", "string"), ("region", "string"),
            ("continent", "string"), ("is_developed_market", "boolean"),
            ("basel_country_risk_weight", "decimal(5,4)"),
        ],
        params.GEOGRAPHY_DIMENSION,
    )


def dim_date(spark: SparkSession, start, end, fiscal_start_month: int = 1) -> DataFrame:
    """Calendar from ``start`` to ``end`` inclusive (dates or date columns)."""
    bounds = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_key")
    )
    return calendar_columns(bounds, fiscal_start_month)


def calendar_columns(days: DataFrame, fiscal_start_month: int = 1) -> DataFrame:
    """Calendar attributes of ``date_key``. Weekday 1 is Sunday; weeks are ISO."""
    d = F.col("date_key")
    month_end = F.last_day(d) == d
    # a fiscal year is named after the calendar year it ends in
    fiscal = F.add_months(d, (13 - fiscal_start_month) % 12)
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        month_end.alias("is_month_end"),
        (month_end & (F.month(d) % 3 == 0)).alias("is_quarter_end"),
        (month_end & (F.month(d) == 12)).alias("is_year_end"),
        F.year(fiscal).alias("fiscal_year"),
        F.quarter(fiscal).alias("fiscal_quarter"),
    )
