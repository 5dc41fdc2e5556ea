"""Data-quality checks whose results are a DataFrame.

All checks of a table that only need to see each row once (counts, nulls, rules,
sums) share a single aggregation; the reports of several tables are then united.
Nothing is collected until the gate, which reads one summary row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelstone.operators import aggregates
from keelstone.sources.reference import literal_table


class QualityError(ValueError):
    """Raised by the gate when a check has failed."""


@dataclass(frozen=True)
class RowCount:
    """Number of rows within ``[low, high]``."""

    low: int
    high: int


@dataclass(frozen=True)
class Nulls:
    """Share of NULLs per column, in percent, at most ``threshold_pct``."""

    columns: Sequence[str]
    threshold_pct: float = 1.0


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    message: str = ""


@dataclass(frozen=True)
class Rules:
    """No row may break a rule. A NULL outcome is unknown, not a violation."""

    rules: Sequence[Rule]


@dataclass(frozen=True)
class SumMatches:
    """Sum of a column within a percentage of a known source total."""

    column: str
    source_total: float
    tolerance_pct: float = 0.01


@dataclass(frozen=True)
class Unique:
    """No key may occur twice. Counts keys, not rows."""

    keys: Sequence[str]


@dataclass(frozen=True)
class Anomalies:
    """No value beyond ``k`` sample deviations of its column's mean."""

    columns: Sequence[str]
    k: float = 3.0


ROWS = "_rows"


def result_row(
    check_type: str,
    table: str,
    item: str,
    valid: Column,
    metric: Column,
    threshold: float | None,
    detail: Mapping[str, Column] | None = None,
) -> Column:
    pairs = [x for k, v in (detail or {}).items() for x in (F.lit(k), v.cast("string"))]
    empty = F.lit(None).cast("map<string,string>")
    return F.struct(
        F.lit(check_type).alias("check_type"),
        F.lit(table).alias("table_name"),
        F.lit(item).alias("item"),
        valid.alias("is_valid"),
        metric.cast("double").alias("metric"),
        F.lit(threshold).cast("double").alias("threshold"),
        (F.create_map(*pairs) if pairs else empty).alias("detail"),
    )


def _rows_of(measured: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return measured.select(F.inline(F.array(*rows)))


def _plan(check, n: int, df: DataFrame, table: str) -> tuple[list[Column], list[Column]]:
    """Aggregates a one-pass check needs, and the result rows made from them."""
    rows = F.col(ROWS)
    if isinstance(check, RowCount):
        detail = {"low": F.lit(check.low), "high": F.lit(check.high)}
        valid = rows.between(check.low, check.high)
        return [], [result_row("row_count_check", table, "rows", valid, rows, None, detail)]
    if isinstance(check, Nulls):
        aggs, out = [], []
        for c in check.columns:
            if c not in df.columns:
                continue
            name = f"n{n}_{c}"
            aggs.append(F.count_if(F.col(c).isNull()).alias(name))
            pct = F.coalesce(F.try_divide(F.col(name) * F.lit(100.0), rows), F.lit(0.0))
            out.append(
                result_row(
                    "null_check", table, c, pct <= check.threshold_pct, pct,
                    check.threshold_pct, {"nulls": F.col(name)},
                )
            )
        return aggs, out
    if isinstance(check, Rules):
        aggs, out = [], []
        for i, rule in enumerate(check.rules):
            broken, unknown = f"r{n}_{i}_broken", f"r{n}_{i}_unknown"
            holds = F.expr(rule.condition)
            aggs += [
                F.count_if(~holds).alias(broken),
                F.count_if(holds.isNull()).alias(unknown),
            ]
            out.append(
                result_row(
                    "business_rules", table, rule.name, F.col(broken) == 0, F.col(broken), 0.0,
                    {"unknown": F.col(unknown), "message": F.lit(rule.message)},
                )
            )
        return aggs, out
    if isinstance(check, SumMatches):
        name = f"s{n}"
        source = F.lit(float(check.source_total))
        total = F.col(name)
        off = F.coalesce(
            F.try_divide(F.abs(total - source), F.abs(source)) * F.lit(100.0),
            F.when(total == source, F.lit(0.0)).otherwise(F.lit(100.0)),
        )
        row = result_row(
            "reconciliation", table, check.column, off <= check.tolerance_pct, off,
            check.tolerance_pct, {"target": total, "source": source},
        )
        return [F.sum(F.col(check.column).cast("double")).alias(name)], [row]
    raise TypeError(f"not a one-pass check: {check!r}")


def one_pass(df: DataFrame, table: str, checks: Sequence) -> DataFrame | None:
    """Row-count, null, rule and sum checks of one table in one aggregation."""
    planned = [_plan(check, n, df, table) for n, check in enumerate(checks)]
    aggs = [a for wanted, _ in planned for a in wanted]
    rows = [r for _, made in planned for r in made]
    if not rows:
        return None
    return _rows_of(df.agg(F.count(F.lit(1)).alias(ROWS), *aggs), rows)


def check_unique(df: DataFrame, table: str, check: Unique) -> DataFrame:
    repeated = aggregates.duplicates(df, check.keys).agg(F.count(F.lit(1)).alias("n"))
    row = result_row(
        "duplicate_check", table, ",".join(check.keys), F.col("n") == 0, F.col("n"), 0.0
    )
    return _rows_of(repeated, [row])


def check_anomalies(df: DataFrame, table: str, check: Anomalies) -> DataFrame | None:
    """Values beyond the band, for all columns at once: one pass for the bands, one to count.

    Columns without spread are left out, as are columns the table does not have.
    """
    columns = [c for c in check.columns if c in df.columns]
    if not columns:
        return None
    values = {c: F.col(c).cast("double") for c in columns}
    bands = df.agg(
        F.struct(
            *[
                F.struct(F.avg(v).alias("mean"), F.stddev(v).alias("std")).alias(c)
                for c, v in values.items()
            ]
        )
    ).scalar()
    rows, counts = [], []
    for i, (c, v) in enumerate(values.items()):
        band = bands.getField(c)
        mean, std = band.getField("mean"), band.getField("std")
        lower, upper = mean - std * F.lit(check.k), mean + std * F.lit(check.k)
        counts.append(F.count_if((v < lower) | (v > upper)).alias(f"a{i}"))
        found = F.col(f"a{i}")
        detail = {"mean": mean, "std": std, "lower": lower, "upper": upper}
        row = result_row("anomaly_detection", table, c, found == 0, found, check.k, detail)
        rows.append(F.when(std > 0, row))
    measured = df.agg(*counts)
    return measured.select(F.inline(F.array_compact(F.array(*rows))))


def validate_schema(df: DataFrame, expected: T.StructType, table: str) -> DataFrame:
    """One result per expected column (missing and mistyped ones fail); extra columns pass.

    Looks at metadata only.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name, kind in wanted.items():
        found = actual.get(name)
        problem = "missing" if found is None else "" if found == kind else "type"
        rows.append((name, not problem, kind, found or "", problem))
    rows += [(n, True, "", kind, "extra") for n, kind in actual.items() if n not in wanted]
    checked = literal_table(
        df.sparkSession,
        [("item", "string"), ("ok", "boolean"), ("expected", "string"),
         ("actual", "string"), ("problem", "string")],
        rows,
    )
    return checked.select(
        F.lit("schema_validation").alias("check_type"),
        F.lit(table).alias("table_name"),
        "item",
        F.col("ok").alias("is_valid"),
        F.when(F.col("ok"), F.lit(0.0)).otherwise(F.lit(1.0)).alias("metric"),
        F.lit(0.0).alias("threshold"),
        F.create_map(
            F.lit("expected"), "expected", F.lit("actual"), "actual", F.lit("problem"), "problem"
        ).alias("detail"),
    )


def log_results(*results: DataFrame | None) -> DataFrame:
    """One result table from several."""
    return reduce(DataFrame.unionByName, [r for r in results if r is not None])


def run_checks(df: DataFrame, table: str, checks: Sequence) -> DataFrame:
    """All checks of one table."""
    scans = [c for c in checks if not isinstance(c, Unique | Anomalies)]
    results = [one_pass(df, table, scans)]
    results += [check_unique(df, table, c) for c in checks if isinstance(c, Unique)]
    results += [check_anomalies(df, table, c) for c in checks if isinstance(c, Anomalies)]
    return log_results(*results)


def run_suite(tables: Mapping[str, DataFrame], suite: Mapping[str, Sequence]) -> DataFrame:
    """A table-driven suite: ``{table: checks}`` over ``{table: frame}``."""
    return log_results(*[run_checks(tables[name], name, checks) for name, checks in suite.items()])


def summary(results: DataFrame) -> DataFrame:
    """Checks run, passed, failed and the pass rate.

    A check is one type on one table; it passes when all of its items do.
    """
    checks = results.groupBy("check_type", "table_name").agg(F.bool_and("is_valid").alias("ok"))
    counts = checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("ok").alias("passed"),
        F.count_if(~F.col("ok")).alias("failed"),
    )
    rate = F.try_divide(F.col("passed") * F.lit(100.0), F.col("total_checks"))
    return counts.withColumn("pass_rate", F.coalesce(rate, F.lit(0.0)))


def gate_status(results: DataFrame) -> DataFrame:
    """The summary with the gate's decision."""
    decision = F.when(F.col("failed") == 0, "OPEN").otherwise("CLOSED")
    return summary(results).withColumn("gate", decision)


def gate(results: DataFrame) -> None:
    """Stop when a check has failed. Call it on the stored report, after writing it."""
    row = summary(results).first()
    if row["failed"] > 0:
        raise QualityError(f"{row['failed']} of {row['total_checks']} data quality checks failed")


def calc_invariants(fact: DataFrame, max_density: float = 1.5) -> DataFrame:
    """Plausibility of a finished calculation, from one row of totals."""
    totals = aggregates.validation_totals(fact)
    rwa, exposure = F.col("total_rwa"), F.col("total_exposure")
    rows = [
        result_row(
            "calculation_invariants", "rwa_detail", "positive_rwa",
            F.coalesce(rwa > 0, F.lit(False)), rwa, 0.0,
        ),
        result_row(
            "calculation_invariants", "rwa_detail", "positive_weight",
            F.coalesce(F.col("avg_risk_weight") > 0, F.lit(False)), F.col("avg_risk_weight"), 0.0,
        ),
        result_row(
            "calculation_invariants", "rwa_detail", "plausible_rwa",
            F.coalesce(rwa <= exposure * F.lit(max_density), F.lit(False)),
            F.try_divide(rwa, exposure), max_density,
        ),
    ]
    return _rows_of(totals, rows)


def with_reasons(
    df: DataFrame, rules: Sequence[Rule] = (), casts: Mapping[str, object] | None = None
) -> DataFrame:
    """Add the reasons why a row would be rejected (an empty array when there are none).

    A rule that does not hold, or cannot be decided, is a reason: such rows would
    also be dropped by a filter. So is text that cannot be read as its type.
    """
    reasons = [
        F.when(~F.coalesce(F.expr(r.condition), F.lit(False)), F.lit(r.name)) for r in rules
    ]
    reasons += [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"cast_{c}"))
        for c, t in (casts or {}).items()
    ]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*reasons)))


def quarantine(df: DataFrame, rules: Sequence[Rule] = (), casts=None) -> DataFrame:
    """Only the rejected rows, with their reasons."""
    return with_reasons(df, rules, casts).where(F.size("reject_reasons") > 0)


def accepted(df: DataFrame, rules: Sequence[Rule] = (), casts=None) -> DataFrame:
    """Only the rows without a reason to reject them."""
    marked = with_reasons(df, rules, casts)
    return marked.where(F.size("reject_reasons") == 0).drop("reject_reasons")
