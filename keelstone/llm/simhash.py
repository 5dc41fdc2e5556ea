"""Near-duplicate documents by SimHash and a covering code.

Fingerprints that differ in at most two bits have a common neighbour at one bit from
each. That neighbour decodes to one anchor of the code, so it is enough to replicate
every fingerprint to the anchors of its own ball of radius one: two linked
fingerprints always meet at an anchor. The code is a product: ``FREE`` bits are kept
as they are (covering radius 0) and the other 48 bits form blocks of three, each
decoded to its majority (the perfect repetition code, covering radius 1). A flipped
free bit changes the anchor; a flipped block bit does so only where the block is not
unanimous. That makes 16 + 16 = 32 anchor bits, so four billion anchors, for about 29
replicas of a fingerprint.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import components, one_row, row_key, stored

SEED = 42
WORDS_PER_SHINGLE = 3
THRESHOLD = 2
FREE = 16
BLOCKS = (64 - FREE) // 3
#: Runs up to this many fingerprints at one anchor are compared pair by pair, longer
#: ones through their one-bit neighbours, which costs 65 rows for each fingerprint.
DENSE = 512


def fingerprint(text: str | None) -> int:
    """SimHash of a whole text; null, empty and blank texts give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < WORDS_PER_SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        last = WORDS_PER_SHINGLE - 1
        starts = (ends - lengths)[: len(words) - last].tolist()
        pieces = map(joined.__getitem__, map(slice, starts, ends[last:].tolist()))
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), dtype=np.uint64, count=len(starts)
        )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for row in range(0, len(bits), 255):  # sums of 255 bits fit a byte
            counts += np.add.reduce(bits[row : row + 255], axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("text")
        values = [_signed(fingerprint(text.as_py())) for text in texts]
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(values, pa.int64())], names=[*batch.schema.names[:-1], "fp"]
        )


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``row_key`` and the signed 64-bit ``fp`` of every row."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        row_key(id_column, text_column).alias("row_key"),
        F.col(text_column).cast("string").alias("text"),
    )
    return rows.mapInArrow(_fingerprints, "doc_id long, row_key string, fp long")


def anchors_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and anchors of the balls of radius one around 64-bit fingerprints."""
    free = values & np.uint64((1 << FREE) - 1)
    home, mixed = free.copy(), []
    for block in range(BLOCKS):
        x, y, z = (
            (values >> np.uint64(FREE + 3 * block + k)) & np.uint64(1) for k in range(3)
        )
        home |= ((x & y) | (y & z) | (x & z)) << np.uint64(FREE + block)
        mixed.append(~((x == y) & (y == z)))
    rows, anchors = [np.arange(len(values))], [home]
    for bit in range(FREE):
        rows.append(rows[0])
        anchors.append(home ^ np.uint64(1 << bit))
    for block in range(BLOCKS):
        at = np.flatnonzero(mixed[block])
        rows.append(at)
        anchors.append(home[at] ^ np.uint64(1 << (FREE + block)))
    return np.concatenate(rows), np.concatenate(anchors)


def _replicas(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            part = batch.slice(at, 8192)
            fps = part.column("fp").to_numpy(zero_copy_only=False)
            rows, anchors = anchors_of(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors.astype(np.int64)),
                    pa.array(fps[rows]),
                    part.column("node").take(pa.array(rows)),
                ],
                names=["anchor", "fp", "node"],
            )


def _spread(adjacent: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row of a symmetric matrix with a true diagonal."""
    labels = np.arange(len(adjacent))
    while True:
        lower = np.where(adjacent, labels[None, :], len(labels)).min(axis=1)
        lower = lower[lower]
        if np.array_equal(lower, labels):
            return labels
        labels = lower


def _by_neighbours(fps: np.ndarray) -> np.ndarray:
    """As ``_spread``, over fingerprints that share a one-bit neighbour."""
    masks = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    middle = (fps[:, None] ^ masks[None, :]).ravel()
    order = np.argsort(middle, kind="stable")
    owner = np.repeat(np.arange(len(fps)), len(masks))[order]
    starts = np.flatnonzero(np.r_[True, middle[order][1:] != middle[order][:-1]])
    sizes = np.diff(np.r_[starts, len(owner)])
    labels = np.arange(len(fps))
    while True:
        lowest = np.repeat(np.minimum.reduceat(labels[owner], starts), sizes)
        lower = labels.copy()
        np.minimum.at(lower, owner, lowest)
        lower = lower[lower]
        if np.array_equal(lower, labels):
            return labels
        labels = lower


def linked_rows(fps: np.ndarray) -> np.ndarray:
    """For the fingerprints at one anchor, the smallest row each is connected with."""
    if len(fps) <= DENSE:
        return _spread(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= THRESHOLD)
    return _by_neighbours(fps)


def _edges_at_anchors(batches):
    """Spanning edges at each anchor of rows sorted by anchor; never all pairs."""

    def edges(anchor, fps, nodes):
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        ends = np.r_[starts[1:], len(anchor)]
        a, b = [], []
        twos = starts[ends - starts == 2]
        near = twos[np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= THRESHOLD]
        a.append(nodes[near])
        b.append(nodes[near + 1])
        for s, e in zip(*(x[ends - starts > 2].tolist() for x in (starts, ends)), strict=True):
            labels = linked_rows(fps[s:e])
            moved = np.flatnonzero(labels != np.arange(e - s))
            a.append(nodes[s:e][moved])
            b.append(nodes[s:e][labels[moved]])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"]
        )

    held = [np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)]
    for batch in batches:
        columns = [
            batch.column("anchor").to_numpy(zero_copy_only=False),
            batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64),
            batch.column("node").to_numpy(zero_copy_only=False),
        ]
        held = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        if cut:  # the last anchor may go on in the next batch
            yield edges(*(x[:cut] for x in held))
            held = [x[cut:] for x in held]
    if len(held[0]):
        yield edges(*held)


def linked(fps: DataFrame) -> DataFrame:
    """``fp`` and ``component_id`` of every distinct fingerprint that has an id.

    The smallest doc_id of a fingerprint stands for all its copies, so a fingerprint
    behind a third of all rows is one row here.
    """
    classes = stored(
        fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "classes"
    )
    replicas = classes.mapInArrow(_replicas, "anchor long, fp long, node long")
    edges = (
        replicas.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_edges_at_anchors, "a long, b long")
    )
    found = components(edges)
    return classes.join(found, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint``, ``component_id``.

    Null, empty and blank texts have fingerprint zero and link like any other. Rows
    without id do not link others; they get the component of their fingerprint, or
    null. Repeated rows appear as often as they come. Other columns are not read. An
    empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, id_column, text_column), "fingerprints")
    return rows.join(linked(rows), "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: the smallest id of each.

    Of rows that repeat that id the one with the smallest key stays, and of those equal in
    id and text the one whose columns have the smallest digest. Rows without id stay only
    where no other row has their fingerprint.
    """
    rows = stored(fingerprints(docs, id_column, text_column), "fingerprints")
    groups = rows.join(linked(rows), "fp", "left")
    kept = groups.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))).agg(
        F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("__kept")
    )
    found = docs.withColumn("__row", row_key(id_column, text_column)).join(
        kept.select("__kept"), F.col("__row") == F.col("__kept")
    )
    return one_row(found, docs.columns, "__row").select("__one.*")
