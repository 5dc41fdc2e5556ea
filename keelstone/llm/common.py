"""Helpers shared by the operators: stored tables, row keys, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelstone.sinks.scratch import new_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_column: str, text_column: str):
    """128 bits that name a row by its id and text; rows equal in both share them."""
    parts = [
        F.coalesce(F.col(id_column).cast("string"), F.lit("null")),
        F.when(F.col(text_column).isNull(), F.lit("n")).otherwise(F.lit("t")),
        F.coalesce(F.col(text_column), F.lit("")),
    ]
    return F.md5(F.concat_ws("\x1f", *parts))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable node of every node of an undirected graph.

    ``edges`` has two long columns ``a`` and ``b``. Alternating large and small
    stars: each round replaces the edges of a node by edges to the smallest node it
    sees, until nothing changes. A node with very many neighbours is one row after
    the map side of each ``min``. Returns ``node``, ``component`` for every node that
    is not the smallest of its component; no edges give no rows. Loops, nulls and
    repeated edges are ignored.
    """
    edges = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        name,
    )
    seen = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")
        ).first()
        if state == seen or state["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.where("b > a")
            .join(lowest, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = stored(large, name)
        lowest = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, F.col("a") == F.col("u"))
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, name)


def one_row(found: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """One of the rows of the same keys, as column ``__one``: the one whose columns have the
    smallest digest, so that a rerun takes the same."""
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    return found.groupBy(*keys).agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias("__one"))
