"""Stored dashboard states and their refresh from the classes that changed.

A table of states lies beside the fact, a folder for each date. The states of a class
keep a mark of the files they were made from. A refresh compares the marks with the files
there are now, without reading a column, and reads the classes that differ. Their states
take the place of the old ones, those of the other classes are carried over, and the
dashboard row of the date is merged from states alone.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone.operators import states
from keelstone.sinks import writers

DATE, CLASS = states.SLICE


def file_marks(fact: DataFrame) -> DataFrame:
    """A mark of the files behind each date and class of a stored fact (a row for each)."""
    files = fact.select(*states.SLICE, "_metadata.file_path", "_metadata.file_size").distinct()
    return files.groupBy(*states.SLICE).agg(
        F.bit_xor(F.xxhash64("file_path", "file_size")).alias("mark")
    )


class KpiStates:
    """States, key numbers and dashboard rows below one folder, made from a stored fact."""

    def __init__(self, spark: SparkSession, fact_path: str, path: str):
        self.spark, self.fact_path, self.path = spark, fact_path, path

    def _fact(self) -> DataFrame:
        return self.spark.read.parquet(self.fact_path)

    def states(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/states")

    def numbers(self, key: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/numbers/{key}")

    def _number(self, rows: DataFrame, first: bool) -> dict[str, DataFrame]:
        """Number the keys of ``rows`` that have none. Numbers once given never change."""
        for key in states.KEYS:
            known = None if first else self.numbers(key)
            new = states.number_keys(rows, key, known)
            new.write.mode("overwrite" if first else "append").parquet(f"{self.path}/numbers/{key}")
        return {key: self.numbers(key) for key in states.KEYS}

    def _made(self, rows: DataFrame, first: bool) -> DataFrame:
        """States of some rows of the fact, with the marks of their files."""
        made = states.kpi_states(rows, self._number(rows, first))
        marks = file_marks(rows).withColumnsRenamed({DATE: "_date", CLASS: "_class"})
        same = (F.col(DATE) == F.col("_date")) & F.col(CLASS).eqNullSafe(F.col("_class"))
        return made.join(F.broadcast(marks), same, "left").drop("_date", "_class")

    def build(self) -> None:
        """All states and dashboard rows anew. A refresh is enough after that."""
        made = self._made(self._fact(), first=True)
        writers.write_partitioned(made, f"{self.path}/states", [DATE])
        kpis = states.kpis_of_states(self.states())
        writers.write_partitioned(kpis, f"{self.path}/kpis", [DATE])

    def changed(self, day: dt.date) -> list:
        """Classes of a date whose files are not those their state was made from (tens at most)."""
        now = file_marks(self._fact().where(F.col(DATE) == F.lit(day)))
        then = self.states().where((F.col(DATE) == F.lit(day)) & (F.col("kind") == "sums"))
        then = then.select(F.col(CLASS).alias("_class"), F.col("mark").alias("_mark"))
        both = now.join(then, F.col(CLASS).eqNullSafe(F.col("_class")), "full_outer")
        differ = both.where(~F.col("mark").eqNullSafe(F.col("_mark")))
        rows = differ.select(
            F.when(F.col("mark").isNull(), F.col("_class")).otherwise(F.col(CLASS)).alias("c"),
            F.col("mark").isNull().alias("gone"),
        )
        return sorted(((r["c"], r["gone"]) for r in rows.collect()), key=repr)

    def rows_of(self, day: dt.date, classes: list) -> DataFrame:
        """The fact's rows of some classes of a date: only their folders are read."""
        wanted = reduce(lambda a, b: a | b, (F.col(CLASS).eqNullSafe(F.lit(c)) for c in classes))
        return self._fact().where((F.col(DATE) == F.lit(day)) & wanted)

    def refresh(self, day: dt.date) -> list:
        """Bring one date up to date; returns the classes whose files have changed or gone."""
        changed = self.changed(day)
        if not changed:
            return []
        stale = reduce(lambda a, b: a | b, (F.col(CLASS).eqNullSafe(F.lit(c)) for c, _ in changed))
        kept = self.states().where((F.col(DATE) == F.lit(day)) & ~stale)
        made = self._made(self.rows_of(day, [c for c, _ in changed]), first=False)
        columns = self.states().columns
        fresh = kept.select(*columns).unionByName(made.select(*columns))
        writers.replace_slice(fresh, f"{self.path}/states", DATE, day)
        of_day = states.kpis_of_states(self.states().where(F.col(DATE) == F.lit(day)))
        writers.replace_slice(of_day, f"{self.path}/kpis", DATE, day, n=1)
        return [c for c, _ in changed]
