"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken the same fractional number of times. The whole
part is certain; the fractions are rounded in pairs: mass, counted in words, moves at
random from one document to the other until one of them is taken fully or not at all,
which keeps both the words of the pair and every document's expected share. What is left
of a pair meets the next document. Each leaf of a reduction tree ends with one
unfinished document, these meet at the next level, until one is left for each source.
"""

from __future__ import annotations

import itertools
import math

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keelstone.llm.common import one_row, row_key, stored

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: Documents of a leaf of the tree, and unfinished documents that meet above it.
LEAF = 4096
FAN_IN = 64
SEED = 20


def sizes(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        row_key(id_column, text_column).alias("key"),
    )


def targets(rows: DataFrame) -> DataFrame:
    """``source``, ``docs``, ``source_size``, ``target`` of each source.

    Sources in order of code points, null last, weigh 1, 2, 3, repeating, and share all
    words. A target stops at three times its source's size; the excess goes to the other
    sources by weight. With sources ordered by that limit per weight, a source is at its
    limit where the share left for it and all later ones is at least as much.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy("ratio", "place")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    rest = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weights = F.array(*map(F.lit, WEIGHTS))
    return (
        rows.groupBy("source")
        .agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", F.get(weights, F.col("place") % len(WEIGHTS)).cast("double"))
        .withColumn("limit", F.col("source_size") * float(MOST_COPIES))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("full", F.col("left") >= F.col("ratio") * F.sum("weight").over(rest))
        .withColumn("spare", F.col("total") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(everything))
        .withColumn("open", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything))
        .select(
            "source",
            "docs",
            "source_size",
            F.when(F.col("full"), F.col("limit"))
            .otherwise(F.try_divide(F.col("spare") * F.col("weight"), F.col("open")))
            .alias("target"),
        )
    )


def draw(*keys: str) -> float:
    """A number from 0 to 1 that depends on the keys alone."""
    return xxhash.xxh64_intdigest("\x1f".join(keys), SEED) / 2.0**64


def pivot(p: float, w: int, q: float, v: int, u: float) -> tuple[float, float]:
    """Move mass between shares p of w words and q of v words until one is 0 or 1.

    ``u`` decides the direction, so that each share keeps its expectation.
    """
    up, down = min(w * (1 - p), v * q), min(w * p, v * (1 - q))
    if u * (up + down) < down:
        first = 1.0 if w * (1 - p) <= v * q else p + up / w
        second = 0.0 if v * q <= w * (1 - p) else q - up / v
    else:
        first = 0.0 if w * p <= v * (1 - q) else p - down / w
        second = 1.0 if v * (1 - q) <= w * p else q + down / v
    return first, second


COLUMNS = ("source", "leaf", "doc_id", "size", "source_size", "target", "key", "whole", "share")
SCHEMA = (
    "source string, leaf long, doc_id long, size long, source_size long, target double, key string, "
    "whole long, share double"
)
TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.int64(), pa.float64()]


def _rounded(batches):
    """Rows sorted by source, leaf and key; all but one of each group leave with share 0 or 1.

    Only the unfinished row is held, however long a group is.
    """
    share, size, key = COLUMNS.index("share"), COLUMNS.index("size"), COLUMNS.index("key")
    held, out = None, []

    def flushed():
        arrays = [pa.array([r[k] for r in out], t) for k, t in enumerate(TYPES)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names=list(COLUMNS))

    for batch in batches:
        for row in map(list, zip(*(batch.column(c).to_pylist() for c in COLUMNS), strict=True)):
            if not 0 < row[share] < 1 or not row[size]:
                out.append(row)
                continue
            if held and held[:2] != row[:2]:
                out.append(held)
                held = None
            if held is None:
                held = row
                continue
            u = draw(held[key], row[key])
            held[share], row[share] = pivot(held[share], held[size], row[share], row[size], u)
            if 0 < held[share] < 1:
                out.append(row)
            else:
                out.append(held)
                held = row
                if not 0 < row[share] < 1:
                    out.append(row)
                    held = None
        yield flushed()
    if held:
        out.append(held)
    yield flushed()


def _level(rows: DataFrame) -> DataFrame:
    return stored(
        rows.select(*COLUMNS)
        .repartition("source", "leaf")
        .sortWithinPartitions("source", "leaf", "key", "doc_id")
        .mapInArrow(_rounded, SCHEMA),
        "mixing",
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    in_part: bool = True,
) -> DataFrame:
    """One row per row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``key``, ``copies``.

    ``copies`` is how often the document is taken in full, ``taken`` its words in the
    mix. The document left at the root of a source's tree is taken in part, which meets
    the target to a word; with ``in_part=False`` it is drawn as a whole. Null texts have
    no words and are taken 0 times; null sources are one source; null ids and repeated
    rows are kept; other columns are not read. Draws come from row keys, so reruns agree.
    An empty table gives an empty result.
    """
    rows = sizes(docs, id_column, text_column, source_column)
    goals = stored(targets(rows), "targets")
    leaves = F.ceil(F.col("docs") / LEAF).cast("long")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    level = _level(
        rows.join(goals.withColumnRenamed("source", "goal"), F.col("source").eqNullSafe(F.col("goal")))
        .withColumn("leaf", F.pmod(F.xxhash64("key", "doc_id"), leaves))
        .withColumn("whole", F.floor(rate).cast("long"))
        .withColumn("share", rate - F.floor(rate))
    )
    unfinished = (F.col("share") > 0) & (F.col("share") < 1) & (F.col("size") > 0)
    done = [level.where(~unfinished)]
    most = goals.agg(F.max(leaves)).first()[0] or 1
    for _ in range(math.ceil(math.log(most, FAN_IN)) if most > 1 else 0):
        level = _level(level.where(unfinished).withColumn("leaf", F.floor(F.col("leaf") / FAN_IN).cast("long")))
        done.append(level.where(~unfinished))
    last = level.where(unfinished)
    if not in_part:
        coin = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
        last = last.withColumn("share", (coin < F.col("share")).cast("double"))
    out = done[0]
    for part in itertools.chain(done[1:], [last]):
        out = out.unionByName(part)
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("whole") * F.col("size") + F.round(F.col("share") * F.col("size")).cast("long")).alias("taken"),
        "key",
        (F.col("whole") + F.floor("share").cast("long")).alias("copies"),
    )


def mixed(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source"
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it as a whole.

    Rows equal in id and text are taken as often as all of them together; the one whose
    columns have the smallest digest is repeated.
    """
    copies = (
        mix(docs, id_column, text_column, source_column, in_part=False)
        .groupBy(F.col("key").alias("__key"))
        .agg(F.sum("copies").cast("int").alias("__copies"))
        .where("__copies > 0")
    )
    found = docs.withColumn("__row", row_key(id_column, text_column)).join(
        copies, F.col("__row") == F.col("__key")
    )
    return (
        one_row(found, docs.columns, "__row", "__copies")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select("__one.*")
    )
