"""Session settings that suit the library."""

from __future__ import annotations

from pyspark.sql import SparkSession


def settings(cores: int, checkpoint_dir: str | None = None) -> dict[str, str]:
    """Settings for a cluster with so many cores.

    Adaptive execution with skew handling, two to three shuffle partitions a core (it merges
    what is too small), and broadcasts up to 64 MB, which the ratings of a day fit.
    ``checkpoint_dir`` is the folder all executors share.
    """
    out = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(8, 3 * cores)),
        "spark.sql.autoBroadcastJoinThreshold": "64MB",
        "spark.sql.session.timeZone": "UTC",
    }
    if checkpoint_dir:
        out["spark.checkpoint.dir"] = checkpoint_dir
    return out


def builder(app: str, cores: int, checkpoint_dir: str | None = None) -> SparkSession.Builder:
    """A session builder with these settings; the caller adds the master and its own."""
    return SparkSession.builder.appName(app).config(map=settings(cores, checkpoint_dir))
