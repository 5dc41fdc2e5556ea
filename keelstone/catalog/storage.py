"""Source, sink and table-maintenance queries.

Each writes what Spark derives from the given tables to a new folder below the
shared one, then returns a frame that reads it back.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelstone import schemas
from keelstone.catalog.book import Book, plain, rounded
from keelstone.catalog.reports import KPI_DIGITS, KPI_SQL, SUMMARY_DIGITS, SUMMARY_SELECT
from keelstone.catalog.checks import DAYS_SQL
from keelstone.catalog.sqlparts import sql
from keelstone.catalog.standardise import FX_HISTORY_SQL, fx_history
from keelstone.operators import aggregates as agg, reconcile as rc, states
from keelstone.sinks import compaction, layout, tables, writers, zones
from keelstone.sinks.scratch import new_path
from keelstone.sinks.states import KpiStates
from keelstone.sources import footers, readers, reference, testviews as tv
from keelstone.sources.reference import literal_table

book = Book()

MONTH = dt.date(1998, 10, 1)
LAST = dt.date(2001, 7, 1)
LOANS = ["loan_id", "customer_id", "product_type", "outstanding_balance", "origination_date"]


def monthly_loans(spark, d, name="date"):
    loans = tv.loans(spark, d, with_customer=False).select(*LOANS)
    return loans.withColumn(name, F.trunc("origination_date", "month"))


@book.query(
    "src_parquet_snapshot",
    sql(
        """SELECT loan_id, customer_id, CAST(outstanding_balance AS DOUBLE) AS outstanding_balance,
          CAST(date_trunc('month', origination_date) AS DATE) AS date FROM loans_plain
        WHERE date_trunc('month', origination_date) = DATE '1998-10-01'""",
        "loans_plain",
    ),
)
def parquet_snapshot(spark, d):
    path = new_path(spark, "loans")
    loans = monthly_loans(spark, d)
    writers.write_partitioned(loans, path, ["date"])
    schema = T.StructType([f for f in loans.schema.fields if f.name != "date"])
    one = readers.read_snapshot(spark, path, MONTH, schema)
    return plain(one.select("loan_id", "customer_id", "outstanding_balance", "date"))


@book.query(
    "src_csv_ratings",
    sql(
        "SELECT CAST(customer_id AS VARCHAR) AS customer_id, rating_agency, rating, rating_date, "
        "'STABLE' AS outlook FROM ratings",
        "ratings",
    ),
)
def csv_ratings(spark, d):
    path = new_path(spark, "ratings")
    columns = ["customer_id", "rating_agency", "rating", "rating_date"]
    rows = tv.ratings(spark, d).select(*columns, F.lit("STABLE").alias("outlook"))
    rows.write.option("header", True).csv(path)
    return readers.read_ratings_csv(spark, path)


@book.query("src_json_fx", sql(FX_HISTORY_SQL, "loans_plain"))
def json_fx(spark, d):
    """One file per month, each an array document of that month's few pairs."""
    path = new_path(spark, "fx")
    record = F.struct("currency_pair", "rate", F.col("date").cast("string").alias("date"), "source")
    documents = (
        fx_history(spark, d)
        .groupBy(F.col("date").alias("month"))
        .agg(F.to_json(F.collect_list(record)).alias("value"))
    )
    documents.write.partitionBy("month").text(path)
    return readers.read_fx_json(spark, path).select("currency_pair", "rate", "date")


def stored_summary(spark, d):
    path = new_path(spark, "summary")
    writers.write_partitioned(agg.summary(tv.fact(spark, d, "month")), path, ["calculation_date"])
    return path


@book.query(
    "src_table_by_date",
    sql(
        f"SELECT {SUMMARY_SELECT} FROM summary_month WHERE calculation_date = DATE '2001-07-01'",
        "summary_month",
    ),
)
def table_by_date(spark, d):
    return rounded(readers.read_fact(spark, stored_summary(spark, d), LAST), SUMMARY_DIGITS)


@book.query(
    "src_table_trailing_days",
    sql(
        f"""SELECT {SUMMARY_SELECT} FROM summary_month WHERE calculation_date
          BETWEEN DATE '2001-07-01' - 100 AND DATE '2001-07-01' - 1""",
        "summary_month",
    ),
)
def table_trailing_days(spark, d):
    stored = readers.read_fact(spark, stored_summary(spark, d))
    return rounded(readers.trailing_days(stored, LAST, 100), SUMMARY_DIGITS)


@book.query(
    "src_external_table",
    sql(
        """SELECT CAST(date_trunc('month', origination_date) AS DATE) AS snapshot_date,
          count(*) AS loan_count, round(sum(CAST(outstanding_balance AS DOUBLE)), 2) AS balance
        FROM loans_plain GROUP BY 1""",
        "loans_plain",
    ),
)
def external_table(spark, d):
    path = new_path(spark, "external")
    loans = monthly_loans(spark, d, "snapshot_date")
    writers.write_partitioned(loans, path, ["snapshot_date"])
    name = f"loans_raw_{uuid.uuid4().hex}"
    stored = readers.register_external(spark, name, path, loans.schema)
    out = stored.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum(F.col("outstanding_balance").cast("double")).alias("balance"),
    )
    report = new_path(spark, "external_report")
    writers.write_table(rounded(out, {"balance": 2}), report)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(report)


@book.query(
    "src_source_totals",
    sql(
        """SELECT CAST(date_trunc('month', origination_date) AS DATE) AS snapshot_date,
          round(sum(CAST(outstanding_balance AS DOUBLE)), 2) AS source_exposure,
          count(*) AS source_loan_count FROM loans_raw GROUP BY 1""",
        "loans_raw",
    ),
)
def source_totals(spark, d):
    raw = tv.loans(spark, d, raw=True, with_customer=False)
    dated = raw.withColumn("snapshot_date", F.trunc("origination_date", "month"))
    return rounded(readers.source_totals(dated, "snapshot_date"), {"source_exposure": 2})


# Sinks --------------------------------------------------------------------------


CLASS_TOTALS = """SELECT asset_class, count(*) AS loan_count,
    round(sum(CAST(outstanding_balance AS DOUBLE)), 2) AS balance FROM clean_loans GROUP BY 1"""


def class_totals(loans):
    out = loans.groupBy("asset_class").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum(F.col("outstanding_balance").cast("double")).alias("balance"),
    )
    return rounded(out, {"balance": 2})


@book.query("snk_partitioned_overwrite", sql(CLASS_TOTALS, "clean_loans"))
def partitioned_overwrite(spark, d):
    path = new_path(spark, "loans_clean")
    writers.write_partitioned(tv.clean_loans(spark, d), path, ["asset_class"], n=8)
    writers.write_partitioned(tv.clean_loans(spark, d), path, ["asset_class"])
    return class_totals(spark.read.parquet(path))


@book.query(
    "snk_overwrite",
    sql(
        "SELECT collateral_id, collateral_type, market_value, adjusted_collateral_value, "
        "valuation_stale_flag FROM clean_collateral",
        "clean_collateral",
    ),
)
def overwrite(spark, d):
    path = new_path(spark, "collateral_clean")
    clean = tv.clean_collateral(spark, d).select(
        "collateral_id", "collateral_type", "market_value", "adjusted_collateral_value",
        "valuation_stale_flag",
    )
    writers.write_table(clean, path)
    writers.write_table(clean, path, n=2)
    return plain(spark.read.parquet(path))


@book.query(
    "snk_replace_date",
    sql(
        """SELECT calculation_date, asset_class, round(sum(total_rwa) * CASE WHEN calculation_date =
          DATE '2001-07-01' THEN 2 ELSE 1 END, 2) AS total_rwa,
          sum(loan_count)::BIGINT AS loan_count
        FROM summary_month GROUP BY 1, 2""",
        "summary_month",
    ),
)
def replace_date(spark, d):
    """Store every date, then replace one date's slice twice by a corrected one."""
    path = stored_summary(spark, d)
    one = readers.read_fact(spark, path, LAST)
    other = new_path(spark, "corrected")
    writers.write_table(one.withColumn("total_rwa", F.col("total_rwa") * 2), other)
    for _ in range(2):
        writers.replace_slice(spark.read.parquet(other), path, "calculation_date", LAST)
    out = readers.read_fact(spark, path).groupBy("calculation_date", "asset_class").agg(
        F.sum("total_rwa").alias("total_rwa"), F.sum("loan_count").alias("loan_count")
    )
    return rounded(out, {"total_rwa": 2})


@book.query("snk_append", sql(KPI_SQL.format(fact="fact_month"), "fact_month"))
def append(spark, d):
    """Adding a date's row again leaves one row per date."""
    path = new_path(spark, "kpi_dashboard")
    kpis = agg.daily_kpis_of(agg.customer_class_totals(tv.fact(spark, d, "month")))
    writers.write_partitioned(kpis, path, ["calculation_date"])
    again = new_path(spark, "kpis_of_a_day")
    writers.write_table(readers.read_fact(spark, path, LAST), again, n=1)
    writers.replace_slice(spark.read.parquet(again), path, "calculation_date", LAST, n=1)
    return rounded(readers.read_fact(spark, path), KPI_DIGITS)


@book.query(
    "snk_parquet_export",
    sql(f"SELECT {', '.join(schemas.EXPORT_COLUMNS)} FROM fact", "fact"),
)
def parquet_export(spark, d):
    path = new_path(spark, "export")
    writers.export_parquet(
        tv.fact(spark, d), path, schemas.EXPORT_COLUMNS, files=4, max_records=2_000
    )
    return spark.read.parquet(path)


@book.query(
    "snk_warehouse_replace",
    sql(
        """SELECT calculation_date, asset_class, geography, rating_bucket,
          CAST(loan_count AS INTEGER) AS loan_count,
          CAST(CAST(total_exposure AS DECIMAL(20,2)) AS DOUBLE) AS total_exposure,
          CAST(CAST(total_rwa AS DECIMAL(20,2)) AS DOUBLE) AS total_rwa,
          CAST(CAST(avg_pd AS DECIMAL(8,6)) AS DOUBLE) AS avg_pd,
          CAST(CAST(capital_ratio AS DECIMAL(5,4)) AS DOUBLE) AS capital_ratio,
          CAST(high_risk_count AS INTEGER) AS high_risk_count,
          CAST(NULL AS DOUBLE) AS rwa_change_pct FROM summary""",
        "summary",
    ),
)
def warehouse_replace(spark, d):
    path = new_path(spark, "warehouse")
    typed = writers.to_warehouse_types(agg.summary(tv.fact(spark, d)), schemas.WAREHOUSE_SUMMARY)
    writers.replace_slice(typed, path, "calculation_date", tv.AS_OF)
    columns = [
        "calculation_date", "asset_class", "geography", "rating_bucket", "loan_count",
        "total_exposure", "total_rwa", "avg_pd", "capital_ratio", "high_risk_count",
        "rwa_change_pct",
    ]
    return plain(readers.read_fact(spark, path, tv.AS_OF).select(*columns))


@book.query(
    "snk_cluster_layout",
    sql(
        "SELECT geography, rating_bucket, count(*) AS loan_count, count(DISTINCT loan_id) AS loans "
        "FROM fact GROUP BY 1, 2",
        "fact",
    ),
)
def cluster_layout(spark, d):
    stored, path = new_path(spark, "rwa_detail"), new_path(spark, "clustered")
    columns = ["loan_id", "geography", "rating_bucket", "risk_weighted_assets"]
    writers.write_table(tv.fact(spark, d).select(*columns), stored)
    detail = spark.read.parquet(stored)
    layout.cluster(detail, ["geography", "rating_bucket"], files=8).write.parquet(path)
    return spark.read.parquet(path).groupBy("geography", "rating_bucket").agg(
        F.count(F.lit(1)).alias("loan_count"), F.countDistinct("loan_id").alias("loans")
    )


@book.query(
    "snk_cluster_skipping",
    sql(
        """SELECT loan_id, geography, round(risk_weighted_assets, 2) AS risk_weighted_assets FROM fact
        WHERE geography BETWEEN 'A' AND 'F' AND risk_weighted_assets >= 1e5""",
        "fact",
    ),
)
def cluster_skipping(spark, d):
    """Loans in a range of two columns, from the files of a clustered copy whose zones meet it."""
    stored, path, known = (new_path(spark, n) for n in ("rwa_detail", "clustered", "zones"))
    columns = ["geography", "risk_weighted_assets"]
    writers.write_table(tv.fact(spark, d).select("loan_id", *columns), stored)
    layout.cluster(spark.read.parquet(stored), columns, files=16).write.parquet(path)
    zones.write_zone_map(spark, path, columns, known)
    ranges = {"geography": ("A", "F"), "risk_weighted_assets": (1e5, None)}
    return rounded(zones.read_ranges(spark, path, known, ranges), {"risk_weighted_assets": 2})


@book.query(
    "snk_compact_small",
    sql(
        "SELECT calculation_date, asset_class, count(*) AS loan_count, count(DISTINCT loan_id) AS loans "
        "FROM fact_month GROUP BY 1, 2",
        "fact_month",
    ),
)
def compact_small(spark, d):
    """A date whose classes lie in many small files beside larger ones, after they were merged."""
    path, by = new_path(spark, "scattered"), ["calculation_date", "asset_class"]
    fact = tv.fact(spark, d, "month").select(*by, "loan_id")
    fact.repartition(8, "loan_id").write.partitionBy(*by).parquet(path)
    for _ in range(2):  # the second call has nothing left to merge
        compaction.compact_small(spark, path, LAST, by=by[1:])
    return readers.read_fact(spark, path).groupBy(*by).agg(
        F.count(F.lit(1)).alias("loan_count"), F.countDistinct("loan_id").alias("loans")
    )


@book.query(
    "dq_schema_drift",
    sql(
        """SELECT DISTINCT CAST(date_trunc('month', origination_date) AS DATE) AS date,
          CASE month(origination_date) WHEN 2 THEN 'product_type' ELSE 'outstanding_balance' END AS item,
          CASE month(origination_date) WHEN 2 THEN 'missing' ELSE 'type' END AS problem
        FROM loans_plain
        WHERE month(origination_date) = 2 OR date_trunc('month', origination_date) = DATE '1998-10-01'""",
        "loans_plain",
    ),
)
def schema_drift(spark, d):
    """Months of a loan table whose files lack a column or hold another type than most files do."""
    path = new_path(spark, "loans")
    loans = monthly_loans(spark, d)
    short, odd = F.month("date") == 2, F.col("date") == F.lit(MONTH)
    writers.write_partitioned(loans.where(~short & ~odd), path, ["date"])
    writers.write_partitioned(loans.where(short).drop("product_type"), path, ["date"], mode="append")
    text = F.col("outstanding_balance").cast("string")
    writers.write_partitioned(loans.where(odd).withColumn("outstanding_balance", text), path, ["date"], mode="append")
    found = footers.schema_drift(footers.file_schemas(spark, path))
    day = F.to_date(F.regexp_extract("file", "date=([0-9-]+)", 1))
    return found.select(day.alias("date"), "item", "problem").distinct()


@book.query("snk_compact", sql(f"SELECT {SUMMARY_SELECT} FROM summary_month", "summary_month"))
def compact(spark, d):
    path = new_path(spark, "scattered")
    summary = agg.summary(tv.fact(spark, d, "month"))
    summary.repartition(8).write.partitionBy("calculation_date").parquet(path)
    writers.compact(spark, path, LAST, files=1)
    return rounded(readers.read_fact(spark, path), SUMMARY_DIGITS)


@book.query("snk_materialized_kpis", sql(KPI_SQL.format(fact="fact_month"), "fact_month"))
def materialized_kpis(spark, d):
    """States and dashboard rows of all dates; then one date is stored again and refreshed."""
    path, detail = new_path(spark, "daily_kpis"), new_path(spark, "rwa_detail")
    fact = tv.fact(spark, d, "month").select(*states.COLUMNS)
    writers.write_partitioned(fact, detail, states.SLICE)
    kpis = KpiStates(spark, detail, path)
    kpis.build()
    again = new_path(spark, "rwa_detail_of_a_day")
    writers.write_table(readers.read_fact(spark, detail, LAST), again)
    writers.replace_slice(spark.read.parquet(again), detail, "calculation_date", LAST, ["asset_class"])
    kpis.refresh(LAST)
    return rounded(readers.read_fact(spark, f"{path}/kpis"), KPI_DIGITS)


@book.query(
    "snk_table_stats",
    sql(
        """SELECT 'customer_id' AS column_name, CAST(min(customer_id) AS VARCHAR) AS lowest,
          CAST(max(customer_id) AS VARCHAR) AS highest, CAST(count(*) - count(customer_id) AS VARCHAR)
          AS num_nulls FROM loans_plain
        UNION ALL SELECT 'origination_date', CAST(min(origination_date) AS VARCHAR),
          CAST(max(origination_date) AS VARCHAR), CAST(count(*) - count(origination_date) AS VARCHAR)
          FROM loans_plain
        UNION ALL SELECT 'collateral_id', CAST(min(collateral_id) AS VARCHAR),
          CAST(max(collateral_id) AS VARCHAR), CAST(count(*) - count(collateral_id) AS VARCHAR)
          FROM loans_plain""",
        "loans_plain",
    ),
)
def table_stats(spark, d):
    name, path = f"loans_{uuid.uuid4().hex}", new_path(spark, "stats")
    loans = tv.loans(spark, d, with_customer=False).select(*LOANS, "collateral_id")
    loans.write.option("path", path).saveAsTable(name)
    found = tables.analyze(spark, name, ["customer_id", "origination_date", "collateral_id"])
    measures = new_path(spark, "measures")
    writers.write_table(found, measures, n=1)
    spark.sql(f"DROP TABLE {name}")
    found = spark.read.parquet(measures)

    def value(info: str):
        return F.max(F.when(F.col("info_name") == info, F.col("info_value")))

    return found.groupBy("column_name").agg(
        value("min").alias("lowest"), value("max").alias("highest"),
        value("num_nulls").alias("num_nulls"),
    )


@book.query(
    "snk_star_ddl",
    sql(
        """SELECT coalesce(a.asset_category, 'none') AS asset_category,
          coalesce(g.region, 'none') AS region, year(f.calculation_date) AS year,
          count(*) AS loan_count, CAST(sum(CAST(CAST(f.risk_weighted_assets AS VARCHAR) AS DECIMAL(18,2))) AS DOUBLE) AS total_rwa
        FROM fact f LEFT JOIN (VALUES ('RETAIL_MORTGAGE','Retail'),('RETAIL_OTHER','Retail'),
          ('CORPORATE_SME','Corporate'),('CORPORATE_LARGE','Corporate'),('SOVEREIGN','Sovereign'))
          a(asset_class, asset_category) ON a.asset_class = f.asset_class
        LEFT JOIN (VALUES ('US','North America'),('GB','Western Europe'),('DE','Western Europe'),
          ('JP','East Asia'),('CN','East Asia')) g(geography, region) ON g.geography = f.geography
        GROUP BY ALL""",
        "fact",
    ),
)
def star_ddl(spark, d):
    """Create and load the star schema, then ask it a star query."""
    db = f"risk_{uuid.uuid4().hex}"
    tables.create_star(spark, db, new_path(spark, "star"))
    fact = tv.fact(spark, d).withColumn("basel_version", F.lit("3.0"))
    day = {"calculation_date": tv.AS_OF}
    tables.load(writers.to_warehouse_types(fact), f"{db}.{tables.FACT}", day)
    summary = writers.to_warehouse_types(
        agg.summary(spark.table(f"{db}.{tables.FACT}")), schemas.WAREHOUSE_SUMMARY
    )
    tables.load(summary, f"{db}.{tables.SUMMARY}", day)
    year = tv.AS_OF.year
    tables.load(
        reference.dim_date(spark, dt.date(year, 1, 1), dt.date(year, 12, 31)), f"{db}.dim_date"
    )
    out = spark.sql(
        f"""SELECT coalesce(a.asset_category, 'none') AS asset_category,
          coalesce(g.region, 'none') AS region, t.year, count(*) AS loan_count,
          CAST(sum(f.risk_weighted_assets) AS DOUBLE) AS total_rwa
        FROM {db}.{tables.FACT} f
          JOIN {db}.dim_date t ON t.date_key = f.calculation_date
          LEFT JOIN {db}.dim_asset_class a ON a.asset_class = f.asset_class
          LEFT JOIN {db}.dim_geography g ON g.geography_code = f.geography
        GROUP BY 1, 2, 3"""
    )
    path = new_path(spark, "star_report")
    writers.write_table(rounded(out.withColumn("year", F.col("year").cast("long")), {"total_rwa": 2}), path)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return spark.read.parquet(path)


@book.query(
    "snk_report",
    sql(
        f"""SELECT calculation_date AS date, status, round(rwa_change_pct, 3) AS rwa_change_pct,
          fmt FROM ({DAYS_SQL}), (VALUES ('csv'), ('json')) v(fmt)""",
        "fact_day",
    ),
)
def report(spark, d):
    results = rc.day_over_day(tv.fact(spark, d, "day")).select(
        F.col("calculation_date").alias("date"), "status", "rwa_change_pct"
    )
    parts = []
    for fmt in ("csv", "json"):
        path = new_path(spark, "report")
        # one folder per year keeps this example's many dates in few files
        writers.write_report(results.withColumn("year", F.year("date")), path, fmt, date="year")
        reader = spark.read.schema(
            "status string, rwa_change_pct double, date date"
            if fmt == "json" else "date date, status string, rwa_change_pct double"
        )
        stored = reader.json(path) if fmt == "json" else reader.option("header", True).csv(path)
        parts.append(
            stored.select("date", "status", "rwa_change_pct", F.lit(fmt).alias("fmt"))
        )
    return rounded(parts[0].unionByName(parts[1]), {"rwa_change_pct": 3})


@book.query(
    "snk_run_metrics",
    sql(
        """SELECT round(sum(risk_weighted_assets), 2) AS TotalRWA, count(*) AS ProcessedLoans,
          count(*) FILTER (WHERE high_risk_flag) AS HighRiskLoans FROM fact""",
        "fact",
    ),
)
def run_metrics(spark, d):
    seen = Observation(f"run-{uuid.uuid4().hex}")
    path = new_path(spark, "rwa_detail")
    writers.replace_slice(tv.fact(spark, d), path, "calculation_date", tv.AS_OF, ["asset_class"], seen=seen)
    got = seen.get
    names = ["TotalRWA", "ProcessedLoans", "HighRiskLoans"]
    row = literal_table(
        spark, [("TotalRWA", "double"), ("ProcessedLoans", "long"), ("HighRiskLoans", "long")],
        [[got[n] for n in names]],
    )
    return rounded(row, {"TotalRWA": 2})
