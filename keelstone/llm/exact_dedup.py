"""Exact duplicates: group by a 128-bit content hash, keep the smallest id, compare bytes.

DataFrame functions only. Rows are grouped by (hash, normalised text), so the bytes of
texts with one hash are compared while they are combined: a group with a third of all
rows is one row of each task before anything is shuffled, and every distinct text is
sent once for each task that holds it. What follows is narrow: the groups of each hash are counted, a hash
with one text names its group, and rows find their group by hash. Groups with many
rows are found by a broadcast of at most 1 / ``HOT_SHARE`` of them, all others by a
join. A hash with several texts (a collision) takes its rows through a join on the
text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import stored

#: Groups above this share of all rows, and above this many rows, are joined by broadcast.
HOT_SHARE = 1e-5
HOT_LEAST = 100
#: Rows that repeat id and text are counted and dealt out again in steps of so many.
COPIES_PER_STEP = 4096


def normalised(text: str) -> Column:
    """Text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def _keyed(docs: DataFrame, id_column: str, text_column: str, digest) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), normalised(text_column).alias("__text")
    ).withColumn("__hash", digest(F.col("__text")))


def _grouped(keyed: DataFrame) -> DataFrame:
    """One row per distinct text: bytes decide, the hash comes first."""
    found = keyed.groupBy("__hash", "__text").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return found.withColumn("text_sha256", F.sha2(F.col("__text"), 256))


def _dealt(rows: DataFrame) -> DataFrame:
    """Each counted row as often as it comes, in two steps, so that no long list is built."""
    step = F.lit(COPIES_PER_STEP).cast("long")
    first = F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1, step)
    rows = rows.withColumn("__from", F.explode(first))
    last = F.least(F.col("__from") + step, F.col("__copies")) - 1
    rows = rows.withColumn("__copy", F.explode(F.sequence("__from", last)))
    kept = (F.col("__copy") == 0) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def classify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null texts count as empty; a text of white space only is one space and so differs
    from the empty one. ``keep_id`` is the smallest id of the group, null only where no
    row of the group has an id. ``group_size`` counts repeated rows too. Of rows that
    repeat that id and text one has ``kept``. Other columns are not read. An empty
    table gives an empty result. ``digest`` may be any deterministic hash: collisions
    cost time but change nothing.
    """
    keyed = _keyed(docs, id_column, text_column, digest)
    classes = _grouped(keyed).drop("__text")
    # one row per hash; the only one of its texts where variants is 1
    facts = ["keep_id", "group_size", "text_sha256"]
    hashes = stored(
        classes.groupBy("__hash").agg(
            F.count(F.lit(1)).alias("__variants"),
            F.sum("group_size").alias("__rows"),
            F.min("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.any_value("text_sha256").alias("text_sha256"),
        ),
        "hashes",
    )
    total, collided = hashes.agg(F.sum("__rows"), F.count_if(F.col("__variants") > 1)).first()
    rows = keyed.groupBy("__hash", "doc_id").agg(F.count(F.lit(1)).alias("__copies"))
    rows = stored(rows, "rows")

    single = hashes.where("__variants = 1").select("__hash", *facts)
    large = F.col("group_size") > max(HOT_LEAST, int((total or 0) * HOT_SHARE))
    hot = single.where(large).select("__hash", F.struct(*facts).alias("__hot"))
    found = rows.join(F.broadcast(hot), "__hash", "left")
    near = found.where("__hot IS NOT NULL").select("doc_id", "__copies", "__hot.*")
    rest = found.where("__hot IS NULL").select("__hash", "doc_id", "__copies")
    out = near.unionByName(rest.join(single.where(~large), "__hash").drop("__hash"))
    if collided:
        twins = keyed.join(hashes.where("__variants > 1").select("__hash"), "__hash", "left_semi")
        exact = twins.groupBy("__hash", "__text", "doc_id").agg(F.count(F.lit(1)).alias("__copies"))
        exact = exact.join(_grouped(twins), ["__hash", "__text"]).drop("__hash", "__text")
        out = out.unionByName(exact)
    return _dealt(out)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the one with the smallest id.

    Rows without id stay only where no equal text has one. Of rows that repeat the id,
    the one whose columns have the smallest digest stays; rows equal in every column
    are one.
    """
    rank = F.struct(
        F.col(id_column).isNull().alias("n"),
        F.col(id_column).cast("long").alias("i"),
        F.sha2(F.to_json(F.struct("*")), 256).alias("d"),
    )
    ranked = docs.withColumns({"__text": normalised(text_column), "__rank": rank})
    ranked = ranked.withColumn("__hash", content_hash(F.col("__text")))
    best = ranked.groupBy("__hash", "__text").agg(F.min("__rank").alias("__rank"))
    kept = stored(best.select("__hash", "__rank"), "kept")
    return (
        ranked.join(kept, ["__hash", "__rank"], "left_semi")
        .dropDuplicates(["__hash", "__rank"])
        .drop("__hash", "__text", "__rank")
    )
