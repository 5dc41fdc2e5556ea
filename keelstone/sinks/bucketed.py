"""Tables laid out by the key of a daily join, so that the join shuffles nothing.

Both sides are stored in as many buckets by the same key. Keys that a bucket could not
hold evenly are kept apart when the table is stored: rows of hot keys, and rows without
a key, lie in a table of their own that is spread evenly. The join reads the buckets
side by side, broadcasts the few rows that hot keys match, and leaves keyless rows alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone.operators import joins
from keelstone.sinks import writers
from keelstone.sinks.scratch import new_path


def _save(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    # one task and one file per bucket
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


class CoLocated:
    """Rows and the side they are joined with, bucketed by ``key`` (one side row per key).

    The tables are named in the catalog, as buckets are known only there; ``drop`` takes
    them out of it again and leaves the files.
    """

    def __init__(self, spark: SparkSession, key: str, buckets: int, path: str | None = None):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.path = path or new_path(spark, "bucketed")
        name = f"bucketed_{uuid.uuid4().hex}"
        self.rows, self.side = f"{name}_rows", f"{name}_side"

    def store_rows(self, rows: DataFrame, hot: DataFrame | None = None) -> None:
        """``hot`` has the keys to keep apart (default: those that a join should spread)."""
        hot = joins.spread_keys(rows, self.key) if hot is None else hot
        keys = F.broadcast(hot.select(self.key))
        _save(
            rows.where(F.col(self.key).isNotNull()).join(keys, self.key, "left_anti"),
            self.rows, f"{self.path}/rows", self.key, self.buckets,
        )
        writers.write_table(
            rows.join(keys.withColumn("_hot", F.lit(True)), self.key, "left")
            .where(F.col("_hot") | F.col(self.key).isNull())
            .drop("_hot"),
            f"{self.path}/apart",
        )

    def store_side(self, side: DataFrame) -> None:
        """The other side, reduced to one row per key."""
        _save(joins.one_per_key(side, self.key), self.side, f"{self.path}/side", self.key, self.buckets)

    def joined(self) -> DataFrame:
        """``rows.join(side, key, "left")``, without an exchange of rows or side."""
        side = self.spark.table(self.side)
        rows = self.spark.table(self.rows).join(side.hint("merge"), self.key, "left")
        apart = self.spark.read.parquet(f"{self.path}/apart")
        # hot keys are fewer than 1 / SPREAD_SHARE, and the side has one row for each
        hot = F.broadcast(apart.select(self.key).where(F.col(self.key).isNotNull()).distinct())
        few = F.broadcast(side.join(hot, self.key, "left_semi"))
        return rows.unionByName(apart.join(few, self.key, "left"))

    def drop(self) -> None:
        for table in (self.rows, self.side):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
