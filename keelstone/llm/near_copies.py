"""One document of each group of near copies: SimHash of five-word shingles, Jaccard 0.8.

Every shingle votes on each bit of ``FINGERPRINTS`` SimHash fingerprints of ``BITS`` bits.
At Jaccard 0.8 one bit in seven differs, too many for a code over all bits, but what
differs are the bits with close votes. So each fingerprint keeps its ``STRONG`` bits with
the widest margins, and any ``TRIPLE`` of them, with their values, are an anchor: two
fingerprints meet where at most three of their six strong bits differ, with probability
0.65 at the limit. All twelve miss such a pair with probability (1 - 0.65)^12 = 4e-6, more
similar ones less often. Few shingles make equal margins: texts of 10 and 8 shingles, the
worst sizes found, are missed with 2e-4.

Of the pairs that meet, those go on whose first ``COMPARED`` bits differ in at most
``DIFFERING`` places (39 are expected at the limit with a deviation of 6, 128 of unrelated
texts), and every link is then checked on the shingles themselves.

Texts with the same words are one node, and only the hashes of a node's shingles travel.
The bucket of an anchor is cut where the sizes of its nodes' shingle sets leave a gap that
no pair at the limit spans. The largest node of each piece is its hub, and all pieces of
one hub are one crowd, in which a node is one row however many anchors it shares.

* Every node is first compared with ``HUBS`` of its hubs, and with all that it meets alone. A
  hub that many others meet is copied once for each of ``PARTS`` parts of them, not once for
  each pair.
* A node then goes on only if enough of its shingles occur in a node of another component
  that shares an anchor with two others; with fewer it has no link to find.
* In crowds whose nodes are not all connected, nodes outside the component of the hub are
  held in blocks of ``BLOCK`` and all others stream past them, first the fingerprints, then
  the shingles of the nodes that can be like another one. Each pair is proposed in its first
  common crowd only, pairs stay inside the task, and what leaves it are edges that connect
  something new.

So a node is a row for each of its hubs (240 at most), once more for each further block of
its crowd, and every pair that meets at an anchor is compared or known not to be similar.
"""

from __future__ import annotations

from itertools import combinations, groupby, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import components, one_row, row_key, stored

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
FINGERPRINTS = 12
BITS = 512
STRONG = 6
TRIPLE = 3
COMPARED = 256
DIFFERING = 80
SEED = 42
#: Up to so many keys of wanted texts are broadcast; more are sorted and merged.
FEW = 100_000
#: So many hubs of larger crowds each node is compared with before the others.
HUBS = 2
#: Parts in which the nodes are compared with their hub.
PARTS = 64
#: Nodes held at a time while the others of their bucket stream past.
BLOCK = 512
BLOCK_KEY = ["first", "block", "part"]

_WORDS = FINGERPRINTS * BITS // 64
_draw = np.random.Generator(np.random.PCG64(SEED))
_MASKS = _draw.integers(0, 1 << 64, _WORDS, dtype=np.uint64)
_FACTORS = _draw.integers(0, 1 << 64, (2, _WORDS), dtype=np.uint64) | np.uint64(1)
#: A strong bit is a number of ``_CODE`` bits: its place and its value.
_CODE = BITS.bit_length()
_TRIPLES = np.array(list(combinations(range(STRONG), TRIPLE)))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None) -> set[bytes]:
    """All runs of five words; a shorter text is one shingle, a text without words none."""
    parts = words(text)
    if len(parts) <= WORDS_PER_SHINGLE:
        return {b" ".join(parts)} if parts else set()
    return {b" ".join(parts[k : k + WORDS_PER_SHINGLE]) for k in range(len(parts) - WORDS_PER_SHINGLE + 1)}


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    found = shingles(text)
    hashes = map(xxhash.xxh64_intdigest, found, repeat(SEED))
    return np.unique(np.fromiter(hashes, dtype=np.uint64, count=len(found)))


def votes(hashes: np.ndarray) -> np.ndarray:
    """How many shingles set each bit of the fingerprints."""
    counts = np.zeros(_WORDS * 64, dtype=np.int64)
    for at in range(0, len(hashes), 64):  # sums of up to 255 bits fit a byte
        mixed = (hashes[at : at + 64, None] ^ _MASKS) * _FACTORS[0]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _FACTORS[1]
        mixed ^= mixed >> np.uint64(29)
        bits = np.unpackbits(mixed.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return counts


def fingerprint(text: str | None) -> tuple[bytes, bytes]:
    """The compared bits and, sorted for each fingerprint, the codes of the strong bits."""
    return _fingerprint(shingle_hashes(text))


def _fingerprint(hashes: np.ndarray) -> tuple[bytes, bytes]:
    margins = 2 * votes(hashes) - len(hashes)
    compared = np.packbits(margins[:COMPARED] > 0, bitorder="little")
    margins = margins.reshape(FINGERPRINTS, BITS)
    # of equal margins the first bits are taken, in every text the same
    ranks = np.abs(margins) * BITS + np.arange(BITS)[::-1]
    places = np.argpartition(ranks, BITS - STRONG, axis=1)[:, BITS - STRONG :]
    codes = 2 * places + (np.take_along_axis(margins, places, axis=1) > 0)
    return compared.tobytes(), np.sort(codes, axis=1).astype("<i2").tobytes()


def _bits(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, COMPARED // 64)


def _codes(column) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), "<i2")
    return flat.reshape(-1, FINGERPRINTS, STRONG).astype(np.int64)


def anchors_of(codes: np.ndarray) -> np.ndarray:
    """The anchors of nodes, one row for each: number of the fingerprint, then the codes."""
    parts = codes[:, :, _TRIPLES]
    anchors = np.broadcast_to(np.arange(FINGERPRINTS)[None, :, None], parts.shape[:3])
    for k in range(TRIPLE):
        anchors = anchors << _CODE | parts[..., k]
    return anchors.reshape(len(codes), -1)


def _nodes(batches):
    for batch in batches:
        texts = [x.as_py() for x in batch.column("text")]
        nodes = [xxhash.xxh64_intdigest(b" ".join(words(x)), SEED) for x in texts]
        hashes = [shingle_hashes(x) for x in texts]
        found = [_fingerprint(x) for x in hashes]
        bits = [np.frombuffer(x, "<i8") for x, _ in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("row_key"),
                pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
                pa.array(bits, pa.list_(pa.int64())),
                pa.array([x for _, x in found], pa.binary()),
                pa.array([len(x) for x in hashes], pa.int32()),
            ],
            names=["doc_id", "row_key", "node", "bits", "codes", "size"],
        )


def _at_anchors(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            anchors = anchors_of(_codes(part.column("codes")))
            repeated = [
                pa.array(np.repeat(part.column(c).to_numpy(zero_copy_only=False), anchors.shape[1]))
                for c in ("size", "node")
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.ravel()), *repeated], names=["anchor", "size", "node"]
            )


def _too_small(sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which sets have too few elements to be similar to the others, which are no smaller."""
    return sizes < SIMILARITY * others - 1e-9


def _shared(batches):
    """Rows sorted by anchor, falling size and node that are not alone at their anchor, with the
    first node, and whether there may be more than two. With sizes, an anchor is cut where they
    leave a gap, and ``like`` says whether the row's is like the first one's."""
    anchor, size, first, top, alone = None, 0, None, 0, False  # of the last row so far
    for batch in batches:
        if not batch.num_rows:
            continue
        at, nodes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "node"))
        sized = "size" in batch.schema.names
        sizes = batch.column("size").to_numpy(zero_copy_only=False) if sized else np.zeros(len(at), np.int32)
        goes_on = at[0] == anchor and not _too_small(sizes[0], size)
        if goes_on and alone:
            at, sizes, nodes = np.r_[anchor, at], np.r_[size, sizes], np.r_[first, nodes]
        starts = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | _too_small(sizes[1:], sizes[:-1])])
        runs = np.diff(np.r_[starts, len(at)])
        lowest, tops, more, several = nodes[starts], sizes[starts], runs > 2, runs > 1
        if goes_on:
            lowest[0], tops[0], more[0], several[0] = first, top, True, True
        more[-1] |= several[-1]  # the last anchor may go on in the next batch
        anchor, size, first, top, alone = at[-1], sizes[-1], lowest[-1], tops[-1], not several[-1]
        lowest, tops, more, kept = (np.repeat(x, runs) for x in (lowest, tops, more, several))
        columns = {
            "band": pa.array((at[kept] >> TRIPLE * _CODE).astype(np.int32)),
            "key": pa.array(at[kept] & (1 << TRIPLE * _CODE) - 1),
            "node": pa.array(nodes[kept]),
            "first": pa.array(lowest[kept]),
            "more": pa.array(more[kept]),
        }
        if sized:
            columns["like"] = pa.array(~_too_small(sizes, tops)[kept])
        yield pa.RecordBatch.from_pydict(columns)


def _hashed(batches):
    for batch in batches:
        hashes = [shingle_hashes(x.as_py()).astype("<u8").tobytes() for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(hashes, pa.binary())], names=["node", "hashes"]
        )


def _hashes(nodes: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node`` and the ``hashes`` of its shingles, once for each of ``nodes``."""
    wanted = stored(classes.join(nodes, "node").select("node", "row_key"), "wanted")
    if wanted.count() <= FEW:
        wanted = F.broadcast(wanted)
    found = texts.join(wanted, "row_key").dropDuplicates(["node"]).select("node", "text")
    return stored(found.mapInArrow(_hashed, "node long, hashes binary"), "hashes")


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), "<u8") for x in column]


def common(one: list[np.ndarray], many: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """How many hashes ``one[i]`` and ``many[j]`` share, for the pairs that are wanted."""
    shared = np.zeros(wanted.shape, dtype=np.int64)
    at, of = np.nonzero(wanted)
    # numbers of the hashes of each side, where the other side has them too
    left, right = (np.concatenate([np.empty(0, np.uint64), *x]) for x in (one, many))
    values = np.intersect1d(left, right)
    # a product of indicator matrices costs rows x rows x values, a pair by itself some microseconds
    if 40_000 * len(at) < wanted.size * len(values):
        for i, j in zip(at.tolist(), of.tolist(), strict=True):
            a, b = (one[i], many[j]) if len(one[i]) < len(many[j]) else (many[j], one[i])
            places = np.minimum(np.searchsorted(b, a), max(0, len(b) - 1))
            shared[i, j] = (b[places] == a).sum() if len(b) else 0
        return shared

    def cells(sets, flat):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        column = np.searchsorted(values, flat)
        inside = column < len(values)
        inside[inside] = values[column[inside]] == flat[inside]
        return row[inside], column[inside]

    (row_a, column_a), (row_b, column_b) = cells(one, left), cells(many, right)
    order_a, order_b = np.argsort(column_a, kind="stable"), np.argsort(column_b, kind="stable")
    row_a, column_a, row_b, column_b = row_a[order_a], column_a[order_a], row_b[order_b], column_b[order_b]
    for low in range(0, len(values), 4096):
        tables = []
        for rows, columns, n in ((row_a, column_a, len(one)), (row_b, column_b, len(many))):
            s, e = np.searchsorted(columns, [low, low + 4096])
            table = np.zeros((n, 4096), dtype=np.float32)
            table[rows[s:e], columns[s:e] - low] = 1
            tables.append(table)
        shared += (tables[0] @ tables[1].T).astype(np.int64)
    return shared


def similar(one: list[np.ndarray], many: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Which of the wanted pairs share enough of their shingles."""
    a, b = np.array([len(x) for x in one])[:, None], np.array([len(x) for x in many])[None, :]
    wanted = wanted & (np.minimum(a, b) >= SIMILARITY * np.maximum(a, b))
    if not wanted.any():
        return wanted
    shared = common(one, many, wanted)
    return wanted & (shared >= SIMILARITY * np.maximum(1, a + b - shared) - 1e-9)


def _runs(batches, key: list[str]):
    """Slices of batches that belong together, one list for each run of equal keys, lazily."""

    def pieces():
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in key]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                yield tuple(int(c[low]) for c in columns), batch.slice(low, high - low)

    for name, run in groupby(pieces(), key=lambda piece: piece[0]):
        yield name, (piece for _, piece in run)


def _edges(a, b):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x, dtype=np.int64)) for x in (a, b)], names=["a", "b"]
    )


def _at_hubs(batches):
    """Edges of the nodes like their hub, which comes first in each run."""
    for (hub, _), pieces in _runs(batches, ["a", "part"]):
        own = None
        for piece in pieces:
            # with nulls in it the column would become one of floats, which round the ids
            sets, nodes = _sets(piece.column("hashes")), piece.column("b").fill_null(0).to_numpy()
            if own is None:
                own, sets, nodes = sets[:1], sets[1:], nodes[1:]
            if len(sets):
                found = similar(own, sets, np.ones((1, len(sets)), dtype=bool))[0]
                yield _edges(np.full(found.sum(), hub), nodes[found])


def near(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which pairs of fingerprints differ in few of the compared bits."""
    differing = np.zeros((len(one), len(many)), dtype=np.int32)
    for k in range(one.shape[1]):
        differing += np.bitwise_count(one[:, None, k] ^ many[None, :, k])
    return differing <= DIFFERING


def _before(hubs, first: int) -> np.ndarray:
    """Those of the hubs that are smaller than this one."""
    found = hubs.values.to_numpy(zero_copy_only=False)
    return np.sort(found[found < first].view(np.uint64))


def _near_another(batches):
    """The rows of blocks that can be similar to one of another component on the other side, as
    far as fingerprints, sizes and shared shingles tell, and meet it in no smaller crowd."""

    def columns(piece, first):
        plain = [piece.column(c).to_numpy(zero_copy_only=False) for c in ("component", "size", "shared")]
        return *plain, _bits(piece.column("bits")), [_before(x, first) for x in piece.column("hubs")]

    def meet(a, b):
        both = np.minimum(a[2][:, None], b[2][None, :])
        wanted = both >= SIMILARITY * (a[1][:, None] + b[1][None, :] - both) - 1e-9
        wanted &= (a[0][:, None] != b[0][None, :]) & near(a[3], b[3])
        return wanted & (common(a[4], b[4], wanted) == 0) if wanted.any() else wanted

    def joined(held, first):
        parts = zip(*(columns(x, first) for x in held), strict=True)
        *plain, hubs = ([*x] for x in parts)
        return *map(np.concatenate, plain), [x for y in hubs for x in y]

    spent = ["size", "shared", "bits", "hubs"]
    for (first, _, part), pieces in _runs(batches, BLOCK_KEY):
        held, closed = [], None
        for piece in pieces:
            cut = int(np.searchsorted(piece.column("streamed").to_numpy(zero_copy_only=False), 1))
            if cut:
                held.append(piece.slice(0, cut))
            if held and cut < piece.num_rows:
                if closed is None:
                    closed = joined(held, first)
                    seen = np.zeros(len(closed[0]), dtype=bool)
                for at in range(cut, piece.num_rows, BLOCK):
                    others = piece.slice(at, BLOCK)
                    found = meet(closed, columns(others, first))
                    seen |= found.any(axis=1)
                    yield others.filter(pa.array(found.any(axis=0))).drop_columns(spent)
        if not held:
            continue
        if closed is None:
            closed = joined(held, first)
            seen = np.zeros(len(closed[0]), dtype=bool)
        if part == 0:  # the first part compares the held nodes with each other
            seen |= meet(closed, closed).any(axis=1)
        at = 0
        for piece in held:
            yield piece.filter(pa.array(seen[at : at + piece.num_rows])).drop_columns(spent)
            at += piece.num_rows


def _agreeing(one: np.ndarray, many: np.ndarray, last: int) -> np.ndarray:
    """How many codes up to ``last`` the strong bits of each pair share."""
    both = np.intersect1d(one, many)
    both = both[both <= last]
    tables = []
    for codes in (one, many):
        column = np.searchsorted(both, codes)
        inside = column < len(both)
        inside[inside] = both[column[inside]] == codes[inside]
        table = np.zeros((len(codes), len(both)), dtype=np.float32)
        table[np.nonzero(inside)[0], column[inside]] = 1
        tables.append(table)
    return tables[0] @ tables[1].T


def first_met(one: np.ndarray, many: np.ndarray, band: int, key: int) -> np.ndarray:
    """Which pairs that share this anchor share none before it."""
    first = _agreeing(one[:, band], many[:, band], key & (1 << _CODE) - 1) == TRIPLE
    for earlier in range(band):
        if not first.any():
            break
        first &= _agreeing(one[:, earlier], many[:, earlier], 2 * BITS) < TRIPLE
    return first


def _at_blocks(batches):
    """Edges that connect the components within a crowd."""

    def columns(piece):
        plain = [piece.column(c).to_numpy(zero_copy_only=False) for c in ("node", "component")]
        return *plain, _sets(piece.column("hashes"))

    def connect(held, others, parent, upper):
        """Edges between held and other nodes that join what was apart."""

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        wanted = held[1][:, None] != others[1][None, :]
        if upper:
            wanted &= held[0][:, None] < others[0][None, :]
        if not wanted.any():
            return [], []
        a, b = [], []
        for i, j in zip(*(x.tolist() for x in np.nonzero(similar(held[2], others[2], wanted))), strict=True):
            x, y = find(int(held[1][i])), find(int(others[1][j]))
            if x != y:
                parent[y] = x
                a.append(held[0][i])
                b.append(others[0][j])
        return a, b

    for (*_, part), pieces in _runs(batches, BLOCK_KEY):
        held, parent, closed = [], {}, None
        for piece in pieces:
            streamed = piece.column("streamed").to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(streamed, 1))
            if cut:
                held.append(columns(piece.slice(0, cut)))
            if held and cut < piece.num_rows:  # a block may have no nodes
                closed = closed or _joined(held)
                for at in range(cut, piece.num_rows, BLOCK):
                    yield _edges(*connect(closed, columns(piece.slice(at, BLOCK)), parent, False))
        if part == 0 and held:  # the first part compares the held nodes with each other
            closed = closed or _joined(held)
            yield _edges(*connect(closed, closed, parent, True))


def _joined(held):
    nodes, components_, sets = zip(*held, strict=True)
    return np.concatenate(nodes), np.concatenate(components_), [x for y in sets for x in y]


def _grouped(classes: DataFrame, edges: DataFrame) -> DataFrame:
    return classes.join(components(edges), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _like_the_hub(stars: DataFrame, hashes: DataFrame) -> DataFrame:
    """The pairs (hub ``a``, ``b``) whose texts are similar."""
    stars = stars.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(PARTS)).cast("int"))
    others = stars.join(hashes, F.col("b") == F.col("node")).select("a", "part", "b", "hashes")
    hubs = stars.select("a", "part").distinct().join(hashes, F.col("a") == F.col("node"))
    # a null other end sorts first, so the hub leads its run
    rows = others.unionByName(hubs.select("a", "part", F.lit(None).cast("long").alias("b"), "hashes"))
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "b")
    return rows.mapInArrow(_at_hubs, "a long, b long")


def _each_hash(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = _sets(part.column("hashes"))
            sizes = [len(x) for x in sets]
            ends = [np.repeat(part.column(c).to_numpy(zero_copy_only=False), sizes) for c in ("node", "component")]
            hashes = np.concatenate([np.empty(0, "<u8"), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (*ends, hashes)], names=["node", "component", "hash"]
            )


def _able(members: DataFrame) -> DataFrame:
    """The members that can be similar to one of another component, with the ``size`` of their
    set and how many of its hashes are ``shared`` with other components at all."""
    flat = members.select("node", "component", "hashes").mapInArrow(
        _each_hash, "node long, component long, hash long"
    )
    met = flat.groupBy("hash").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    shared = flat.join(met.where("x < y").select("hash"), "hash").groupBy("node").agg(F.count("*").alias("shared"))
    sizes = members.select("node", F.expr("octet_length(hashes) DIV 8").alias("size"))
    return sizes.join(shared, "node").where(F.col("shared") >= SIMILARITY * F.col("size") - 1e-9)


def _mixed(crowds: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of crowds with more than one component: blocks of held nodes, and what streams past."""
    rows = crowds.join(groups, "node").join(
        groups.select(F.col("node").alias("first"), F.col("component").alias("core")), "first"
    )
    rows = stored(rows.select("first", "node", "component", "core"), "members")
    apart = F.col("component") != F.col("core")
    sizes = rows.groupBy("first").agg(
        F.count_if(apart).alias("apart"),
        F.count(F.lit(1)).alias("n"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    sizes = sizes.where("low < high").select(
        "first",
        F.ceil(F.col("apart") / BLOCK).alias("blocks"),
        F.ceil(F.col("n") / (8 * BLOCK)).alias("parts"),
    )
    rows = rows.join(sizes, "first").withColumn("own", F.when(apart, F.pmod(F.xxhash64("node"), "blocks")))
    # a held node streams past the later blocks, any other past all of them
    start = F.coalesce(F.col("own"), F.lit(0).cast("long"))
    rows = rows.withColumn("block", F.explode(F.sequence(start, F.col("blocks") - 1)))
    held = F.col("own").eqNullSafe(F.col("block"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), "parts")
    rows = rows.withColumns(
        {
            "streamed": F.when(held, 0).otherwise(1),
            "part": F.explode(
                F.when(held, F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array(part))
            ),
        }
    )
    return rows.select(*BLOCK_KEY, "streamed", "node", "component")


def _stars(crowds: DataFrame) -> DataFrame:
    """The pairs (hub ``a``, ``b``) to compare first: all that meet alone, and of its larger
    crowds each node with the ``HUBS`` smallest hubs."""
    pairs = crowds.where("like AND node <> first")
    hubs = pairs.where("more").groupBy(F.col("node").alias("b"))
    hubs = hubs.agg(F.slice(F.sort_array(F.collect_set("first")), 1, HUBS).alias("a"))
    alone = pairs.where("NOT more").select(F.col("first").alias("a"), F.col("node").alias("b"))
    return alone.unionByName(hubs.select(F.explode("a").alias("a"), "b"))


def _near_the_hub(stars: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (hub ``a``, ``b``) whose fingerprints are near."""
    one = classes.select(F.col("node").alias("a"), F.col("bits").alias("x"))
    many = classes.select(F.col("node").alias("b"), F.col("bits").alias("y"))
    differing = sum(F.bit_count(F.col("x")[k].bitwiseXOR(F.col("y")[k])) for k in range(COMPARED // 64))
    return stars.join(one, "a").join(many, "b").where(differing <= DIFFERING).select("a", "b")


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY, "streamed")


def linked(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``node`` and ``component`` of every node: connected by similar pairs."""
    facts = [F.any_value(c).alias(c) for c in ("bits", "codes", "size")]
    classes = stored(rows.groupBy("node").agg(F.min("row_key").alias("row_key"), *facts), "classes")
    anchors = classes.select("node", "size", "codes").mapInArrow(_at_anchors, "anchor long, size int, node long")
    buckets = anchors.repartition("anchor").sortWithinPartitions("anchor", F.desc("size"), "node")
    schema = "band int, key long, node long, first long, more boolean, like boolean"
    crowds = buckets.mapInArrow(_shared, schema).groupBy("first", "node")
    crowds = stored(crowds.agg(F.max("more").alias("more"), F.max("like").alias("like")), "crowds")

    stars = stored(_near_the_hub(_stars(crowds), classes), "stars")
    hashes = _hashes(stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, texts)
    edges = stored(_like_the_hub(stars, hashes), "similar")
    groups = stored(_grouped(classes, edges), "groups")

    crowds = crowds.where("more").select("first", "node")
    members = stored(crowds.select("node").distinct(), "crowded")
    others = members.join(hashes, "node", "left_anti")
    hashes = hashes.union(_hashes(others, classes, texts))
    able = stored(_able(members.join(groups, "node").join(hashes, "node")), "able")
    crowds = crowds.join(able.select("node"), "node")
    hubs = crowds.groupBy("node").agg(F.collect_set("first").alias("hubs"))  # one for each anchor at most
    facts = able.join(hubs, "node").join(classes.select("node", "bits"), "node")
    members = _in_blocks(_mixed(crowds, groups).join(facts, "node"))
    schema = "first long, block long, part long, streamed int, node long, component long"
    order = [*BLOCK_KEY, "streamed", "node", "component", "size", "shared", "bits", "hubs"]
    members = stored(members.select(*order).mapInArrow(_near_another, schema), "near")
    more = stored(_in_blocks(members.join(hashes, "node")).mapInArrow(_at_blocks, "a long, b long"), "connecting")
    return _grouped(classes, edges.union(more))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: the smallest id of each.

    A group is what similar pairs connect, ignoring ASCII case and white space. Texts
    without words are one group. Of rows that repeat the id the one with the smallest
    key stays, and of those equal in id and text the one whose columns have the smallest
    digest; rows without id stay only where no row of their group has one. An empty table
    gives an empty result.
    """
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        row_key(id_column, text_column).alias("row_key"),
        F.col(text_column).cast("string").alias("text"),
    )
    schema = "doc_id long, row_key string, node long, bits array<long>, codes binary, size int"
    rows = stored(keyed.mapInArrow(_nodes, schema), "nodes")
    groups = rows.select("doc_id", "row_key", "node").join(linked(rows, keyed.select("row_key", "text")), "node")
    kept = groups.groupBy("component").agg(
        F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("__kept")
    )
    found = docs.withColumn("__row", row_key(id_column, text_column)).join(
        kept.select("__kept"), F.col("__row") == F.col("__kept")
    )
    return one_row(found, docs.columns, "__row").select("__one.*")
