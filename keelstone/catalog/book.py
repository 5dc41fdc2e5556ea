"""Registry of queries and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


class Book:
    """Named queries; each takes a session and the folder of the given tables."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def add(function: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} registered twice")
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return add


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round the named measures, so that sums in any order compare equal.

    Scaled first and rounded to a whole number, as most engines round a double;
    rounding at a decimal place would treat a printed ...5 as an exact half.
    """

    def places(column: str, d: int):
        scale = F.lit(10.0**d)
        return F.round(F.col(column).cast("double") * scale) / scale

    return df.withColumns({c: places(c, d) for c, d in digits.items()})


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which every engine writes alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
