"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits the unit vectors at medians of random projections; a vector near a
median goes to both sides (spill). Vectors that share a leaf of any tree are compared
in double precision. A pair is counted in the first leaf its vectors share, which every
task can tell because the forest is small and known everywhere, so no pair has to be
sent anywhere: a leaf gives back, for each vector, how many it links with and one
vector it is connected with.

The forest is fitted on a bounded sample; every vector is indexed and compared. Where the
sample is too thin for further medians, a node is split on by what it had last, so the depth
follows the table and leaves stay near one block, while the forest grows with the logarithm
of the rows only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import components, stored

MIN_COSINE = 0.95
TREES = 8
#: Distinct vectors a leaf should hold without spill, rows of the sample, and rows of it that
#: both halves of a node must have for a median of its own, so that a tree has about
#: SAMPLE / LEAF_SAMPLE nodes with rows of the sample.
LEAF = 256
SAMPLE = 32_768
LEAF_SAMPLE = 32
#: Spill to each side of a split, in standard deviations of the projected difference of
#: two vectors at the smallest cosine. A node where more than half would go to both
#: sides stays a leaf.
SPILL = 0.5
#: Share of its rows of the sample from which on a split at the median gives way to one at a
#: sparser place, and up to which a level below the sampled nodes splits at all.
SHARED = 0.25
#: Spill below the sampled nodes, and levels there beyond the needed ones, for directions that
#: do not split.
DEEP_SPILL = 0.25
SPARE = 8
#: Splits below a node, so that the path fits a leaf's number: enough for 10^12 vectors.
DEEPEST = 27
#: Vectors of a leaf that are compared in one go; larger leaves are cut into blocks and
#: every pair of blocks is compared.
BLOCK = 1024
#: Leaves cut into blocks that every task may know by name; if more are above a block, only
#: the largest are cut and the others are compared block by block in one task.
NAMED = 100_000
SEED = 10


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest component comes first to 1, against overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class Forest:
    """Trees over vectors of one length.

    ``bounds[t][level]`` holds the medians of the nodes of a level that have enough rows of
    the sample, NaN for others. ``deep[t][k]`` holds the bounds of all levels below node
    ``names[t][k]``, the last with rows of its own; NaN where a level does not split it.
    """

    def __init__(self, sample: np.ndarray, rows: int, number: int):
        self.number = number
        self.length = sample.shape[1]
        wanted = max(0, int(np.ceil(np.log2(max(1, rows) / LEAF))))
        self.depth = min(wanted, int(np.log2(max(1, len(sample) / LEAF_SAMPLE))))
        # spill adds rows: a level leaves at most 0.65 of them where shares are as expected
        weight = rows / len(sample)
        self.levels = max(0, int(np.ceil(np.log2(max(1, rows) / BLOCK) / 0.6))) + SPARE
        rng = np.random.default_rng((SEED, self.length))
        self.directions = self._directions(rng, max(1, self.depth))
        self.beyond = self._directions(rng, self.levels)
        self.margin = SPILL * np.sqrt((2 - 2 * MIN_COSINE) / self.length)
        self.deep_margin = self.margin * DEEP_SPILL / SPILL
        self.bounds = [[] for _ in range(TREES)]
        self.names, self.deep = [], []
        units = unit(sample)
        for tree in range(TREES):
            at = np.arange(len(units))
            node = np.zeros(len(units), dtype=np.int64)
            ended: list = []
            for level in range(self.depth):
                values = units[at] @ self.directions[tree, level]
                bound = np.full(1 << level, np.nan)
                for k, own in _groups(node):
                    if len(own) >= 2 * LEAF_SAMPLE:
                        place, shared = _cut(values[own], self.margin)
                        if shared <= 0.5:
                            bound[k] = place
                self.bounds[tree].append(bound)
                at, node = self._step(at, node, values, bound[node], self.margin, ended, level)
            ended.append((at, node + (np.int64(1) << self.depth)))
            at, node = (np.concatenate(x) for x in zip(*ended, strict=True))
            names, bounds = [], []
            for name, own in _groups(node):
                if len(own) * weight > BLOCK:
                    names.append(name)
                    bounds.append(self._below(units[at[own]], len(own) * weight, tree))
            self.names.append(np.array(names, dtype=np.int64))
            self.deep.append(np.array(bounds).reshape(len(names), self.levels))

    def _directions(self, rng, levels: int) -> np.ndarray:
        found = rng.standard_normal((TREES, levels, self.length))
        return found / np.linalg.norm(found, axis=2, keepdims=True)

    def _below(self, own: np.ndarray, rows: float, tree: int) -> np.ndarray:
        """Bounds of the levels below a node, until about half a block of the table is left."""
        own = own[:: -(-len(own) // 256)]
        bounds = np.full(self.levels, np.nan)
        for level in range(self.levels):
            if rows <= BLOCK / 2 or len(own) < 4 or (~np.isnan(bounds)).sum() == DEEPEST:
                break
            place, shared = _cut(own @ self.beyond[tree, level], self.deep_margin)
            if shared <= SHARED:
                bounds[level] = place
                rows *= (1 + shared) / 2
        return bounds

    @staticmethod
    def _step(at, node, values, own, margin, ended, level):
        """Rows and nodes of the next level; rows whose node is not split end in it. A node is
        named by its place among all nodes down to its level."""
        leaf = np.isnan(own)
        ended.append((at[leaf], node[leaf] + (np.int64(1) << level)))
        left, right = values <= own + margin, values > own - margin
        return np.concatenate([at[left], at[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])

    def _deeper(self, vectors, tree, at, name):
        """Leaves below nodes that have rows of the sample; others are leaves."""
        place = np.searchsorted(self.names[tree], name)
        inside = place < len(self.names[tree])
        inside[inside] = self.names[tree][place[inside]] == name[inside]
        rows, leaves = [at[~inside]], [name[~inside]]
        at, place, path = at[inside], place[inside], np.ones(inside.sum(), dtype=np.int64)
        for level in range(self.levels if len(at) else 0):
            own = self.deep[tree][place, level]
            cut = ~np.isnan(own)
            values = np.full(len(at), np.nan)
            values[cut] = vectors[at[cut]] @ self.beyond[tree, level]
            left, right = ~cut | (values <= own + self.deep_margin), cut & (values > own - self.deep_margin)
            # a one in front keeps paths of different lengths apart
            path = np.concatenate([np.where(cut, 2 * path, path)[left], 2 * path[right] + 1])
            at, place = np.concatenate([at[left], at[right]]), np.concatenate([place[left], place[right]])
        rows.append(at)
        leaves.append((path << 12) + self.names[tree][place] if len(at) else path)
        return np.concatenate(rows), np.concatenate(leaves)

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaf numbers of all leaves of unit vectors, over all trees."""
        rows, leaves = [], []
        for tree in range(TREES):
            at, node = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
            ended: list = []
            for level in range(self.depth):
                values = vectors[at] @ self.directions[tree, level]
                at, node = self._step(at, node, values, self.bounds[tree][level][node], self.margin, ended, level)
            ended.append((at, node + (np.int64(1) << self.depth)))
            at, name = self._deeper(vectors, tree, *(np.concatenate(x) for x in zip(*ended, strict=True)))
            rows.append(at)
            leaves.append((np.int64(self.number * TREES + tree) << 40) + name)
        return np.concatenate(rows), np.concatenate(leaves)


def _groups(names: np.ndarray):
    """Each name with the places where it stands."""
    order = np.argsort(names, kind="stable")
    found, starts = np.unique(names[order], return_index=True)
    for name, start, end in zip(found.tolist(), starts, np.r_[starts[1:], len(order)], strict=True):
        yield name, order[start:end]


def _cut(values: np.ndarray, margin: float) -> tuple[float, float]:
    """Where to split values, and the share of them within the margin: at the median, or
    where it is crowded (a dense group) at the sparsest of 64 places in the middle half."""
    median = np.median(values)
    shared = (np.abs(values - median) < margin).mean()
    if shared <= SHARED:
        return median, shared
    places = np.quantile(values, np.linspace(0.25, 0.75, 64))
    ordered = np.sort(values)
    crowds = np.searchsorted(ordered, places + margin) - np.searchsorted(ordered, places - margin, "right")
    best = int(np.argmin(crowds))
    return places[best], crowds[best] / len(values)


def _matrix(column) -> np.ndarray:
    """Arrow lists of one length as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64)


def _by_length(batch):
    """Row numbers and unit vectors of the vectors of each length of a batch."""
    vectors = batch.column("vector")
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield int(length), at, unit(_matrix(vectors.take(pa.array(at))))


def _forests(classes: DataFrame) -> dict[int, Forest]:
    """One forest for each length of vectors, from about ``SAMPLE`` vectors in all, drawn by hash."""
    rows = {x["n"]: x["count"] for x in classes.groupBy(F.size("vector").alias("n")).count().collect()}
    share = int(SAMPLE / max(1, sum(rows.values())) * (1 << 30))
    drawn = classes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < share)
    sample = drawn.select("vector").toArrow()
    found: dict[int, list] = {length: [] for length in rows}
    for batch in sample.to_batches():
        vectors = batch.column("vector")
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for length in np.unique(lengths):
            found[int(length)].append(_matrix(vectors.take(pa.array(np.flatnonzero(lengths == length)))))
    return {
        length: Forest(np.concatenate(found[length]) if found[length] else np.ones((1, length)), rows[length], k)
        for k, length in enumerate(sorted(rows))
    }


def _earlier(forest: Forest, units: np.ndarray, leaf: int) -> np.ndarray:
    """Whether two vectors share a leaf that comes before this one."""
    rows, leaves = forest.leaves(units)
    before = leaves < leaf
    names, columns = np.unique(leaves[before], return_inverse=True)
    member = np.zeros((len(units), len(names)), dtype=np.float32)
    member[rows[before], columns] = 1
    return member @ member.T > 0


def compare(forest: Forest, leaf: int, vectors, copies, blocks, first: int, second: int):
    """Links and connected rows among the vectors of a leaf, or of a pair of its blocks.

    Returns the number of linked vectors and the smallest connected row for each row.
    """
    # powers of two change no digits of the cosine and keep squares in range
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    near = vectors @ vectors.T / (norms[:, None] * norms[None, :]) >= MIN_COSINE
    np.fill_diagonal(near, False)
    if first != second:  # pairs within a block are compared elsewhere
        near &= blocks[:, None] != blocks[None, :]
    some = np.flatnonzero(near.any(axis=1))
    links = np.zeros(len(vectors), dtype=np.int64)
    labels = np.arange(len(vectors))
    if not len(some):
        return links, labels
    near = near[np.ix_(some, some)] & ~_earlier(forest, unit(vectors[some]), leaf)
    links[some] = near @ copies[some]
    np.fill_diagonal(near, True)
    names = np.arange(len(some))
    while True:
        lower = np.where(near, names[None, :], len(some)).min(axis=1)
        lower = lower[lower]
        if np.array_equal(lower, names):
            break
        names = lower
    labels[some] = some[names]
    return links, labels


def near_duplicates(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Equal vectors are one class; its smallest id stands for it, and a class counts with
    all its copies. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, as do vectors of different lengths and rows without
    id, whose ``component_id`` is null and which are not kept. Repeated rows are further
    vectors. Other columns are not read; an empty table gives an empty result.
    """
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.when(finite & F.exists(vector, lambda x: x != 0), F.col(vector_column)).alias("vector"),
    )
    classes = stored(
        rows.where("vec_id IS NOT NULL AND vector IS NOT NULL")
        .groupBy("vector")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")),
        "classes",
    )
    found = stored(_linked(classes, _forests(classes)), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classes = classes.join(links, "node", "left").join(groups, "node", "left")
    return rows.join(classes, "vector", "left").select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "node", "vec_id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "node", "vec_id"), F.lit(False)).alias("kept"),
    )


def _linked(classes: DataFrame, forests: dict[int, Forest]) -> DataFrame:
    """``node``, ``root``, ``links`` from every leaf in which a vector links with another."""

    def leaves_only(batches):
        for batch in batches:
            for length, _, units in _by_length(batch):
                names, counts = np.unique(forests[length].leaves(units)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts)], names=["leaf", "n"])

    counts = stored(
        classes.mapInArrow(leaves_only, "leaf long, n long")
        .groupBy("leaf")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > BLOCK),
        "leaves",
    )
    # at most NAMED leaves are cut: those above the smallest power of two that leaves so few
    sizes = {x["size"]: x["count"] for x in counts.groupBy(F.expr("bigint(log2(n - 1))").alias("size")).count().collect()}
    least = BLOCK
    while sum(n for size, n in sizes.items() if 1 << size >= least) > NAMED:
        least *= 2
    large = {x["leaf"]: -(-x["n"] // BLOCK) for x in counts.where(F.col("n") > least).collect()}

    def placed(batches):
        names = ["leaf", "first", "second", "block", "node", "copies", "vector"]
        for batch in batches:
            for length, at, units in _by_length(batch):
                rows, leaves = forests[length].leaves(units)
                nodes = batch.column("node").to_numpy(zero_copy_only=False)[at]
                cut = np.array([large.get(x, 1) for x in leaves.tolist()], dtype=np.int64)
                own = (nodes[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % cut
                again = np.repeat(np.arange(len(rows)), cut)
                other = np.arange(len(again)) - np.repeat(np.cumsum(cut) - cut, cut)
                for start in range(0, len(again), 4096):
                    part = again[start : start + 4096]
                    block, partner = own[part], other[start : start + 4096]
                    taken = batch.take(pa.array(at[rows[part]]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(leaves[part]),
                            pa.array(np.minimum(block, partner)),
                            pa.array(np.maximum(block, partner)),
                            pa.array(block),
                            *(taken.column(n) for n in names[4:]),
                        ],
                        names=names,
                    )

    def compared(batches):
        def result(run):
            leaf, first, second = (run.column(k)[0].as_py() for k in range(3))
            parts = -(-run.num_rows // BLOCK)
            if first != second or parts <= 2:  # the blocks are rows of two tasks' making
                yield linked(run, leaf, run.column("block").to_numpy(zero_copy_only=False), first, second)
                return
            for one in range(parts):  # a leaf too large for one matrix and too small to be cut
                here = run.slice(one * BLOCK, BLOCK)
                yield linked(here, leaf, np.zeros(here.num_rows), 0, 0)
                for other in range(one + 1, parts):
                    there = run.slice(other * BLOCK, BLOCK)
                    both = pa.Table.from_batches([here, there]).combine_chunks().to_batches()[0]
                    yield linked(both, leaf, np.arange(both.num_rows) >= here.num_rows, 0, 1)

        def linked(run, leaf, blocks, first, second):
            vectors, nodes = _matrix(run.column("vector")), run.column("node").to_numpy(zero_copy_only=False)
            copies = run.column("copies").to_numpy(zero_copy_only=False)
            links, labels = compare(forests[vectors.shape[1]], leaf, vectors, copies, blocks, first, second)
            some = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes[some]), pa.array(nodes[labels[some]]), pa.array(links[some])],
                names=["node", "root", "links"],
            )

        held: list = []
        name = None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
            starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            for start, end in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
                if (key := tuple(keys[:, start])) != name and held:
                    yield from result(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held = []
                name = key
                held.append(batch.slice(start, end - start))
        if held:
            yield from result(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    kind = classes.schema["vector"].dataType.simpleString()
    return (
        classes.select("node", "copies", "vector")
        .mapInArrow(placed, f"leaf long, first long, second long, block long, node long, copies long, vector {kind}")
        .repartition("leaf", "first", "second")
        .sortWithinPartitions("leaf", "first", "second")
        .mapInArrow(compared, "node long, root long, links long")
    )
