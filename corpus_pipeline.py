"""A training corpus from raw documents: filter, deduplicate, mask, mix, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; all but the last return
the columns of ``documents``. Every stage is written below the shared folder and read
again, so a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelstone.llm import mixing, near_copies, packing, pii, quality
from keelstone.llm.common import read, stored
from keelstone.llm.queries import vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like the trusted ones of their language."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles pair by pair, found by SimHash."""
    return near_copies.keep_one(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without personal data."""
    return pii.mask(docs)


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of the documents lie in the training sequences."""
    return packing.pack(docs, *vocabulary())


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", distinct),
    ("PII", masked),
    ("mixing", weighted),
    ("packing", packed),
]

#: Language model, components, rounding and tokens are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
