"""Aggregation, window, set and dimension queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from keelstone.catalog.book import Book, rounded
from keelstone.catalog.joins import MOVES_SQL, exposed, hot
from keelstone.catalog.sqlparts import sql
from keelstone.operators import aggregates as agg, cells, joins, ratings, states, trend
from keelstone.sinks import writers
from keelstone.sinks.scratch import new_path
from keelstone.sources import reference, testviews as tv

book = Book()

SUMMARY_DIGITS = {
    "total_exposure": 2, "total_ead": 2, "total_rwa": 2, "total_regulatory_capital": 2,
    "total_expected_loss": 2, "avg_risk_weight": 6, "avg_pd": 6, "avg_lgd": 6,
    "avg_data_quality": 6, "capital_ratio": 6, "rwa_density": 6,
}


def rounded_sql(columns: dict[str, int], *plain: str) -> str:
    return ", ".join([*plain, *[f"round({c}, {n}) AS {c}" for c, n in columns.items()]])


@book.query(
    "agg_validation_totals",
    sql(
        """SELECT count(*) AS total_loans, round(sum(outstanding_balance_usd), 2) AS total_exposure,
          round(sum(risk_weighted_assets), 2) AS total_rwa,
          round(sum(regulatory_capital), 2) AS total_capital,
          round(avg(risk_weight), 6) AS avg_risk_weight,
          count(DISTINCT customer_id) AS unique_customers,
          count(*) FILTER (WHERE high_risk_flag) AS high_risk_count FROM fact""",
        "fact",
    ),
)
def validation_totals(spark, d):
    digits = {"total_exposure": 2, "total_rwa": 2, "total_capital": 2, "avg_risk_weight": 6}
    return rounded(agg.validation_totals(tv.fact(spark, d)), digits)


@book.query(
    "agg_statistics",
    sql(
        """SELECT asset_class, geography, rating_bucket, count(*) AS loan_count,
          round(sum(outstanding_balance_usd), 2) AS total_exposure,
          round(sum(risk_weighted_assets), 2) AS total_rwa,
          round(avg(risk_weight), 6) AS avg_risk_weight,
          round(sum(regulatory_capital), 2) AS total_capital,
          round(avg(probability_of_default), 6) AS avg_pd,
          count(*) FILTER (WHERE high_risk_flag) AS high_risk_count
        FROM fact GROUP BY 1, 2, 3""",
        "fact",
    ),
)
def statistics(spark, d):
    digits = {"total_exposure": 2, "total_rwa": 2, "avg_risk_weight": 6, "total_capital": 2, "avg_pd": 6}
    return rounded(agg.statistics(tv.fact(spark, d)), digits)


SUMMARY_KEYS = ["calculation_date", "asset_class", "geography", "rating_bucket"]
SUMMARY_SELECT = rounded_sql(SUMMARY_DIGITS, *SUMMARY_KEYS, "loan_count", "high_risk_count")


@book.query("agg_summary", sql(f"SELECT {SUMMARY_SELECT} FROM summary", "summary"))
def summary(spark, d):
    return rounded(agg.summary(tv.fact(spark, d)), SUMMARY_DIGITS)


@book.query(
    "agg_pillar1",
    sql(
        """SELECT calculation_date, round(sum(risk_weighted_assets), 2) AS total_rwa,
          round(sum(regulatory_capital), 2) AS total_capital_req,
          'PILLAR1_TOTAL_CAPITAL' AS report_type FROM fact_month GROUP BY 1""",
        "fact_month",
    ),
)
def pillar1(spark, d):
    out = agg.pillar1(tv.fact(spark, d, "month"))
    return rounded(out, {"total_rwa": 2, "total_capital_req": 2})


@book.query(
    "agg_exposure_class",
    sql(
        """SELECT calculation_date, asset_class,
          round(sum(outstanding_balance_usd), 2) AS original_exposure,
          round(sum(ead_after_crm), 2) AS exposure_after_crm,
          round(sum(risk_weighted_assets), 2) AS rwa, round(avg(risk_weight), 6) AS average_risk_weight,
          count(*) AS loan_count, count(DISTINCT customer_id) AS obligors
        FROM fact GROUP BY 1, 2""",
        "fact",
    ),
)
def exposure_class(spark, d):
    digits = {"original_exposure": 2, "exposure_after_crm": 2, "rwa": 2, "average_risk_weight": 6}
    return rounded(agg.exposure_class(tv.fact(spark, d)), digits)


@book.query(
    "agg_geo_concentration",
    sql(
        """SELECT calculation_date, geography, round(sum(risk_weighted_assets), 2) AS geo_rwa,
          round(sum(outstanding_balance_usd), 2) AS geo_exposure FROM fact GROUP BY 1, 2""",
        "fact",
    ),
)
def geo_concentration(spark, d):
    return rounded(agg.geo_concentration(tv.fact(spark, d)), {"geo_rwa": 2, "geo_exposure": 2})


TOP_SQL = """SELECT customer_id, round(customer_rwa, 2) AS customer_rwa,
    round(customer_exposure, 2) AS customer_exposure, loan_count
  FROM (SELECT customer_id, sum(risk_weighted_assets) AS customer_rwa,
          sum(outstanding_balance_usd) AS customer_exposure, count(loan_id) AS loan_count
        FROM fact GROUP BY 1) ORDER BY customer_rwa DESC, customer_id LIMIT {k}"""


@book.query("agg_top_customers", sql(TOP_SQL.format(k=20), "fact"))
def top_customers(spark, d):
    out = agg.top_customers(tv.fact(spark, d), 20)
    return rounded(out, {"customer_rwa": 2, "customer_exposure": 2})


@book.query(
    "agg_kpi_summary",
    sql(
        """SELECT calculation_date, round(sum(risk_weighted_assets), 2) AS total_rwa,
          round(sum(regulatory_capital), 2) AS total_capital,
          round(sum(outstanding_balance_usd), 2) AS total_exposure, count(loan_id) AS total_loans,
          count(DISTINCT customer_id) AS total_customers,
          count(*) FILTER (WHERE high_risk_flag) AS high_risk_loans,
          round(avg(risk_weight), 6) AS avg_risk_weight FROM fact GROUP BY 1""",
        "fact",
    ),
)
def kpi_summary(spark, d):
    digits = {"total_rwa": 2, "total_capital": 2, "total_exposure": 2, "avg_risk_weight": 6}
    return rounded(agg.kpi_summary(tv.fact(spark, d)), digits)


KPI_DIGITS = {
    "total_exposure": 2, "total_rwa": 2, "total_capital": 2, "avg_risk_weight": 6,
    "avg_data_quality": 9, "capital_ratio": 6, "rwa_density": 6,
}
KPI_SQL = """SELECT calculation_date, count(DISTINCT loan_id) AS total_loans,
    count(DISTINCT customer_id) AS unique_customers,
    round(sum(outstanding_balance_usd), 2) AS total_exposure,
    round(sum(risk_weighted_assets), 2) AS total_rwa,
    round(sum(regulatory_capital), 2) AS total_capital,
    round(avg(risk_weight), 6) AS avg_risk_weight,
    sum(CAST(high_risk_flag AS BIGINT))::BIGINT AS high_risk_loans,
    round(avg(data_quality_score), 9) AS avg_data_quality,
    round(sum(regulatory_capital) / nullif(sum(outstanding_balance_usd), 0), 6) AS capital_ratio,
    round(sum(risk_weighted_assets) / nullif(sum(outstanding_balance_usd), 0), 6) AS rwa_density
  FROM {fact} GROUP BY 1"""


@book.query("agg_daily_kpis_bitmap", sql(KPI_SQL.format(fact="fact_month"), "fact_month"))
def daily_kpis_bitmap(spark, d):
    """Exact distinct counts by bitmaps over the stored fact, which is never expanded."""
    path = new_path(spark, "kpi_fact")
    writers.write_table(tv.fact(spark, d, "month").select(*states.COLUMNS), path)
    fact = spark.read.parquet(path)
    numbers = {}
    for key in states.KEYS:
        writers.write_table(states.number_keys(fact, key), f"{path}-{key}")
        numbers[key] = spark.read.parquet(f"{path}-{key}")
    return rounded(states.kpis_of_states(states.kpi_states(fact, numbers)), KPI_DIGITS)


@book.query("agg_daily_kpis", sql(KPI_SQL.format(fact="fact_month"), "fact_month"))
def daily_kpis(spark, d):
    """Plain distinct counts, which expand every row of the fact."""
    return rounded(agg.daily_kpis(tv.fact(spark, d, "month")), KPI_DIGITS)


@book.query(
    "agg_daily_kpis_keyed", sql(KPI_SQL.format(fact="fact_month"), "fact_month")
)
def daily_kpis_keyed(spark, d):
    """Same measures, trusting the fact's key instead of counting loans distinctly."""
    return rounded(agg.daily_kpis(tv.fact(spark, d, "month"), distinct="keyed"), KPI_DIGITS)


@book.query("agg_daily_kpis_by_customer", sql(KPI_SQL.format(fact="fact_month"), "fact_month"))
def daily_kpis_by_customer(spark, d):
    """Same measures by way of the totals per class and customer."""
    totals = agg.customer_class_totals(tv.fact(spark, d, "month"))
    return rounded(agg.daily_kpis_of(totals), KPI_DIGITS)


@book.query(
    "agg_recon_totals",
    sql(
        """SELECT calculation_date, round(sum(outstanding_balance_usd), 2) AS total_exposure,
          round(sum(risk_weighted_assets), 2) AS total_rwa,
          round(sum(regulatory_capital), 2) AS total_capital,
          count(DISTINCT loan_id) AS loan_count, count(DISTINCT customer_id) AS customer_count
        FROM fact_month GROUP BY 1""",
        "fact_month",
    ),
)
def recon_totals(spark, d):
    out = agg.recon_totals(tv.fact(spark, d, "month"))
    return rounded(out, {"total_exposure": 2, "total_rwa": 2, "total_capital": 2})


@book.query(
    "agg_recon_asset_class",
    sql(
        """SELECT asset_class, round(sum(outstanding_balance_usd), 2) AS calculated_exposure,
          round(sum(risk_weighted_assets), 2) AS calculated_rwa, count(*) AS loan_count
        FROM fact GROUP BY 1""",
        "fact",
    ),
)
def recon_asset_class(spark, d):
    out = agg.by_asset_class(tv.fact(spark, d))
    return rounded(out, {"calculated_exposure": 2, "calculated_rwa": 2})


@book.query(
    "agg_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicates(spark, d):
    return agg.duplicates(tv.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@book.query(
    "agg_duplicates_cells",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicates_cells(spark, d):
    """Same keys, counting only rows whose cell of a bounded array holds two."""
    return cells.duplicates(tv.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@book.query(
    "agg_repeated_parts",
    """SELECT l_partkey, l_suppkey, l_shipdate, count(*) AS row_count FROM lineitem
    GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def repeated_parts(spark, d):
    """Deliveries of one part by one supplier on one day: repeats there are."""
    lines = tv.table(spark, d, "lineitem")
    return cells.duplicates(lines, ["l_partkey", "l_suppkey", "l_shipdate"])


@book.query(
    "agg_hot_keys_sketch",
    """SELECT o_custkey AS customer_id, count(*) AS key_rows FROM orders
    GROUP BY 1 HAVING count(*) > 15""",
)
def hot_keys_sketch(spark, d):
    """Hot customers, counted among the candidates of a count-min sketch."""
    orders = tv.table(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"))
    return cells.keys_above(orders, "customer_id", 15)


@book.query(
    "agg_hot_keys",
    """SELECT o_custkey AS customer_id, count(*) AS key_rows FROM orders
    GROUP BY 1 HAVING count(*) > 15""",
)
def hot_keys(spark, d):
    return hot(spark, d)


@book.query(
    "agg_conditional_count",
    sql(
        """SELECT asset_class, sum(CASE WHEN high_risk_flag THEN 1 ELSE 0 END)::BIGINT AS high_risk,
          sum(CASE WHEN collateral_coverage_ratio > 0 THEN 1 ELSE 0 END)::BIGINT AS covered
        FROM fact GROUP BY 1""",
        "fact",
    ),
)
def conditional_count(spark, d):
    return tv.fact(spark, d).groupBy("asset_class").agg(
        agg.conditional_count("high_risk_flag", "high_risk"),
        agg.conditional_count(F.col("collateral_coverage_ratio") > 0, "covered"),
    )


LEVEL_DIGITS = {"total_exposure": 2, "total_rwa": 2, "total_capital": 2, "avg_risk_weight": 6}


@book.query(
    "agg_multi_level",
    sql(
        """SELECT CASE grouping_id(asset_class, geography, rating_bucket) WHEN 7 THEN 'total'
            WHEN 3 THEN 'asset_class' WHEN 5 THEN 'geography' ELSE 'detail' END AS level,
          asset_class, geography, rating_bucket, count(*) AS loan_count,
          round(sum(outstanding_balance_usd), 2) AS total_exposure,
          round(sum(risk_weighted_assets), 2) AS total_rwa,
          round(sum(regulatory_capital), 2) AS total_capital,
          round(avg(risk_weight), 6) AS avg_risk_weight,
          count(*) FILTER (WHERE high_risk_flag) AS high_risk_count
        FROM fact GROUP BY GROUPING SETS ((), (asset_class), (geography),
          (asset_class, geography, rating_bucket))""",
        "fact",
    ),
)
def multi_level(spark, d):
    return rounded(agg.multi_level(tv.fact(spark, d)), LEVEL_DIGITS)


# Windows, order and sets ---------------------------------------------------------


@book.query(
    "win_latest_rating",
    sql(
        "SELECT customer_id, rating_agency, rating, rating_date, event_id FROM clean_ratings",
        "clean_ratings",
    ),
)
def latest_rating(spark, d):
    return ratings.latest_rating(tv.ratings(spark, d), tie_break=["event_id"])


LAG_SQL = """SELECT calculation_date, asset_class, geography, rating_bucket,
    round(total_rwa, 2) AS total_rwa, round(prev, 2) AS prev_total_rwa,
    round((total_rwa - prev) / nullif(prev, 0) * 100, 3) AS rwa_change_pct
  FROM (SELECT *, lag(total_rwa) OVER (PARTITION BY asset_class, geography, rating_bucket
      ORDER BY calculation_date) AS prev FROM summary_month)"""


@book.query("win_lag_change", sql(LAG_SQL, "summary_month"))
def lag_change(spark, d):
    changed = trend.lag_change(agg.summary(tv.fact(spark, d, "month"))).select(
        *SUMMARY_KEYS, "total_rwa", "prev_total_rwa", "rwa_change_pct"
    )
    return rounded(changed, {"total_rwa": 2, "prev_total_rwa": 2, "rwa_change_pct": 3})


def stored_month(spark, frame):
    """A small result that is used twice, written once."""
    path = new_path(spark, "month")
    writers.write_table(frame, path)
    return spark.read.parquet(path)


@book.query(
    "win_daily_trend",
    sql(
        f"""SELECT calculation_date, asset_class, geography, rating_bucket, total_rwa,
          rwa_change_pct FROM ({LAG_SQL}) WHERE calculation_date = DATE '2001-07-01'""",
        "summary_month",
    ),
)
def daily_trend(spark, d):
    day = dt.date(2001, 7, 1)
    every = stored_month(spark, agg.summary(tv.fact(spark, d, "month")))
    today = every.where(F.col("calculation_date") == F.lit(day))
    history = every.where(F.col("calculation_date") < F.lit(day))
    out = trend.daily_trend(today, history, day).select(*SUMMARY_KEYS, "total_rwa", "rwa_change_pct")
    return rounded(out, {"total_rwa": 2, "rwa_change_pct": 3})


@book.query("srt_top_k", sql(TOP_SQL.format(k=50), "fact"))
def top_k(spark, d):
    out = agg.top_k(agg.customer_totals(tv.fact(spark, d)), "customer_rwa", "customer_id", 50)
    return rounded(out, {"customer_rwa": 2, "customer_exposure": 2})


@book.query(
    "srt_top_movers",
    sql(
        f"""SELECT customer_id, round(current_rwa, 2) AS current_rwa,
          round(previous_rwa, 2) AS previous_rwa, round(rwa_change, 2) AS rwa_change,
          round(change_pct, 4) AS change_pct
        FROM ({MOVES_SQL.format(grain='month', now='2001-07-01', before='2001-06-01')})
        ORDER BY abs(rwa_change) DESC, customer_id LIMIT 20""",
        "fact_month",
    ),
)
def top_movers(spark, d):
    out = trend.top_movers(
        tv.fact(spark, d, "month"), dt.date(2001, 7, 1), 20, dt.date(2001, 6, 1)
    )
    return rounded(
        out, {"current_rwa": 2, "previous_rwa": 2, "rwa_change": 2, "change_pct": 4}
    )


@book.query(
    "set_union_by_name_missing",
    sql(
        """SELECT calculation_date, asset_class, round(total_rwa, 2) AS total_rwa,
          CASE WHEN calculation_date = DATE '2001-07-01' THEN loan_count END AS loan_count
        FROM (SELECT calculation_date, asset_class, sum(risk_weighted_assets) AS total_rwa,
          count(*) AS loan_count FROM fact_month GROUP BY 1, 2)""",
        "fact_month",
    ),
)
def union_missing(spark, d):
    day = F.lit(dt.date(2001, 7, 1))
    totals = tv.fact(spark, d, "month").groupBy("calculation_date", "asset_class").agg(
        F.sum("risk_weighted_assets").alias("total_rwa"), F.count(F.lit(1)).alias("loan_count")
    )
    totals = stored_month(spark, totals)
    today = totals.where(F.col("calculation_date") == day)
    history = totals.where(F.col("calculation_date") != day).drop("loan_count")
    return rounded(trend.with_history(today, history), {"total_rwa": 2})


@book.query(
    "set_union_by_name",
    sql(
        """SELECT customer_id, customer_type, customer_id IN
          (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 15) AS is_hot
        FROM counterparty""",
        "counterparty",
    ),
)
def union_by_name(spark, d):
    side = tv.counterparty(spark, d).select("customer_id", "customer_type")
    warm, cold = joins.split_by_hot(side, hot(spark, d), "customer_id")
    return warm.withColumn("is_hot", F.lit(True)).unionByName(
        cold.select(F.lit(False).alias("is_hot"), "customer_type", "customer_id")
    )


@book.query(
    "set_explode_salts",
    sql(
        """SELECT c.customer_id, s.salt FROM counterparty c
        LEFT JOIN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 15) h
          ON h.o_custkey = c.customer_id
        JOIN (SELECT unnest(range(10)) AS salt) s ON s.salt = 0 OR h.o_custkey IS NOT NULL""",
        "counterparty",
    ),
)
def explode_salts(spark, d):
    side = tv.counterparty(spark, d).select("customer_id")
    parts = hot(spark, d).withColumn("n_salts", F.lit(10))
    return joins.replicate_rows(side, parts, "customer_id", "salt", bounded=False).drop("key_rows")


# Dimensions ------------------------------------------------------------------------

DIM_DATE_SQL = """SELECT date_key, year(date_key) AS year, quarter(date_key) AS quarter,
    month(date_key) AS month, monthname(date_key) AS month_name, day(date_key) AS day_of_month,
    dayofweek(date_key) + 1 AS day_of_week, dayname(date_key) AS day_name,
    weekofyear(date_key) AS week_of_year, dayofweek(date_key) IN (0, 6) AS is_weekend,
    date_key = last_day(date_key) AS is_month_end,
    date_key = last_day(date_key) AND month(date_key) % 3 = 0 AS is_quarter_end,
    date_key = last_day(date_key) AND month(date_key) = 12 AS is_year_end,
    year(date_key + INTERVAL 9 MONTH) AS fiscal_year,
    quarter(date_key + INTERVAL 9 MONTH) AS fiscal_quarter, loan_count
  FROM (SELECT CAST(g AS DATE) AS date_key FROM (
      SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
        INTERVAL 1 DAY)) AS g FROM orders))
  LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS date_key, count(*) AS loan_count FROM orders
    GROUP BY 1) USING (date_key)"""


@book.query("dim_date", DIM_DATE_SQL)
def dim_date(spark, d):
    """Calendar of the loans' origination dates, with the number of loans per day."""
    opened = tv.loans(spark, d, with_customer=False).select(
        F.col("origination_date").alias("date_key")
    )
    per_day = opened.groupBy("date_key").agg(F.count(F.lit(1)).alias("loan_count"))
    days = per_day.agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("date_key")
    )
    calendar = reference.calendar_columns(days, fiscal_start_month=4)
    return calendar.join(per_day, "date_key", "left")


@book.query(
    "dim_asset_class",
    sql(
        """SELECT a.asset_class, a.asset_category, a.is_retail, a.default_risk_weight,
          count(f.loan_id) AS loan_count
        FROM (VALUES ('RETAIL_MORTGAGE','Retail',TRUE,0.35e0),('RETAIL_OTHER','Retail',TRUE,0.75e0),
          ('CORPORATE_SME','Corporate',FALSE,0.75e0),('CORPORATE_LARGE','Corporate',FALSE,1e0),
          ('SOVEREIGN','Sovereign',FALSE,0e0)) a(asset_class, asset_category, is_retail,
          default_risk_weight)
        LEFT JOIN clean_loans f ON f.asset_class = a.asset_class GROUP BY ALL""",
        "clean_loans",
    ),
)
def dim_asset_class(spark, d):
    dim = reference.dim_asset_class(spark).select(
        "asset_class", "asset_category", "is_retail",
        F.col("default_risk_weight").cast("double").alias("default_risk_weight"),
    )
    return _with_uses(dim, tv.clean_loans(spark, d), ["asset_class"])


@book.query(
    "dim_geography",
    sql(
        """SELECT g.*, count(l.loan_id) AS loan_count
        FROM (VALUES ('US','United States','North America','Americas',TRUE,0e0),
          ('GB','United Kingdom','Western Europe','Europe',TRUE,0e0),
          ('DE','Germany','Western Europe','Europe',TRUE,0e0),
          ('JP','Japan','East Asia','Asia',TRUE,0e0),('CN','China','East Asia','Asia',FALSE,0.2e0))
          g(geography_code, country_name, region, continent, is_developed_market,
            basel_country_risk_weight)
        LEFT JOIN clean_loans l ON l.country_code = g.geography_code GROUP BY ALL""",
        "clean_loans",
    ),
)
def dim_geography(spark, d):
    dim = reference.dim_geography(spark)
    dim = dim.withColumn("basel_country_risk_weight", F.col("basel_country_risk_weight").cast("double"))
    loans = tv.clean_loans(spark, d).withColumnRenamed("country_code", "geography_code")
    return _with_uses(dim, loans, ["geography_code"])


def _with_uses(dim, facts, keys):
    """Each dimension row with the number of facts that refer to it.

    The facts are counted per key before the join, so only counts move.
    """
    uses = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("loan_count"))
    joined = dim.join(uses, keys, "left")
    return joined.withColumn("loan_count", F.coalesce("loan_count", F.lit(0)))


@book.query(
    "ref_risk_weights",
    sql(
        """SELECT w.asset_class, w.rating_bucket, w.risk_weight, 'Basel III' AS basel_version,
          DATE '2013-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current,
          count(f.loan_id) AS loan_count
        FROM weights w LEFT JOIN fact f ON f.asset_class = w.asset_class
          AND f.rating_bucket = w.rating_bucket
        WHERE w.rating_bucket IN ('AAA','AA','A','BBB','BB','B') GROUP BY ALL""",
        "weights", "fact",
    ),
)
def ref_risk_weights(spark, d):
    ref = reference.effective_risk_weights(spark)
    ref = ref.withColumn("risk_weight", F.col("risk_weight").cast("double"))
    return _with_uses(ref, tv.fact(spark, d), ["asset_class", "rating_bucket"])


@book.query(
    "src_inline_reference",
    sql(
        """SELECT 'risk_weight' AS kind, w.asset_class || '/' || w.rating_bucket AS entry,
          w.risk_weight AS number, count(f.loan_id) AS loan_count FROM weights w
          LEFT JOIN rated f ON f.asset_class = w.asset_class AND f.rating_bucket = w.rating_bucket
          GROUP BY ALL
        UNION ALL SELECT 'ccf', c.exposure_type, c.ccf, count(f.loan_id) FROM ccf c
          LEFT JOIN rated f ON f.exposure_type = c.exposure_type GROUP BY ALL
        UNION ALL SELECT 'lgd', l.collateral_type, l.lgd, count(f.loan_id) FROM lgd l
          LEFT JOIN rated f ON f.collateral_type = l.collateral_type GROUP BY ALL""",
        "weights", "ccf", "lgd", "rated",
    ),
)
def inline_reference(spark, d):
    """Every entry of the three reference tables and how many loans use it."""
    loans = exposed(spark, d)
    weights = reference.risk_weights(spark)
    parts = [
        _with_uses(weights, loans, ["asset_class", "rating_bucket"]).select(
            F.lit("risk_weight").alias("kind"),
            F.concat_ws("/", "asset_class", "rating_bucket").alias("entry"),
            F.col("risk_weight").alias("number"),
            "loan_count",
        ),
        _with_uses(reference.ccf_table(spark), loans, ["exposure_type"]).select(
            F.lit("ccf").alias("kind"), F.col("exposure_type").alias("entry"),
            F.col("ccf").alias("number"), "loan_count",
        ),
        _with_uses(reference.lgd_table(spark), loans, ["collateral_type"]).select(
            F.lit("lgd").alias("kind"), F.col("collateral_type").alias("entry"),
            F.col("lgd").alias("number"), "loan_count",
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@book.query(
    "cfg_repartition",
    sql(
        "SELECT asset_class, country_code, count(*) AS loan_count FROM clean_loans GROUP BY 1, 2",
        "clean_loans",
    ),
)
def repartition(spark, d):
    """Counting by the partitioning columns needs no second shuffle."""
    loans = tv.clean_loans(spark, d).select("asset_class", "country_code")
    laid_out = writers.optimise_partitions(loans, ["asset_class", "country_code"], 32)
    return laid_out.groupBy("asset_class", "country_code").agg(F.count(F.lit(1)).alias("loan_count"))
