"""Near copies against every pair's Jaccard similarity of five-word shingles."""

from __future__ import annotations

import itertools
import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelstone.llm import near_copies
from keelstone.llm.common import read

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_shingles(text):
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return frozenset()
    return frozenset(tuple(parts[k : k + 5]) for k in range(max(1, len(parts) - 4)))


def plain_kept(rows):
    """The smallest id of each group that pairs at 0.8 connect, over all pairs."""
    smallest: dict = {}
    for doc_id, text in rows:
        found = plain_shingles(text)
        smallest[found] = min(doc_id, smallest.get(found, doc_id))
    sets = sorted(smallest, key=smallest.get)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i], sets[j]
        if len(a & b) >= 0.8 * len(a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return sorted({smallest[sets[find(i)]] for i in range(len(sets))})


def kept(spark, docs):
    return sorted(r["doc_id"] for r in corpus_pipeline.distinct(spark, docs, None).collect())


def test_given_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    assert kept(spark, docs) == plain_kept([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_chains_of_edits(spark):
    """Each text edits the one before it, so the ends of a chain are not similar."""
    rng = random.Random(11)
    rows = []
    for size in (6, 30, 80, 400):
        for _ in range(4):
            text = [f"w{rng.randint(0, 3000)}" for _ in range(size)]
            for _ in range(12):
                rows.append((len(rows), " ".join(text)))
                for _ in range(max(1, size // 80)):
                    text[rng.randrange(size)] = f"w{rng.randint(0, 3000)}"
    rng.shuffle(rows)
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in rows], SCHEMA)
    wanted = plain_kept(rows)
    assert len(wanted) < len(rows)
    assert kept(spark, docs) == wanted


def crowd(n, size, changes, seed):
    """Texts that each change some words of one base, so that most pairs lie near the limit."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(size)]
    rows = []
    for k in range(n):
        text = list(base)
        for _ in range(rng.randint(1, changes)):
            text[rng.randrange(size)] = f"v{rng.randint(0, 10**9)}"
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_crowds_near_the_limit(monkeypatch, spark, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rows = crowd(150, 200, 8, 1) + [(1000 + k, t) for k, t in crowd(60, 60, 4, 2)]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in rows], SCHEMA)
    wanted = plain_kept(rows)
    assert 10 < len(wanted) < len(rows)  # neither all alike nor all apart
    assert kept(spark, docs) == wanted


def test_rows_grow_with_the_nodes_of_a_bucket(spark):
    """One bucket in which every node stays apart: compared in full, but not as rows of pairs."""

    def rows(n):
        nodes = spark.range(n).select(F.col("id").alias("node"))
        buckets = nodes.select(F.lit(0).alias("band"), F.lit(7).cast("long").alias("key"), "node", F.lit(0).cast("long").alias("first"))
        return near_copies._mixed(buckets, nodes.withColumn("component", F.col("node")))

    few, many = rows(500).count(), rows(2000)
    assert few == 500 and many.count() < 8 * 2000
    pairs = set()
    held = many.where("streamed = 0 AND part = 0").groupBy("block").agg(F.collect_list("node").alias("n")).collect()
    assert sorted(x for r in held for x in r["n"] if x) == list(range(1, 2000))
    assert max(len(r["n"]) for r in held) < 2 * near_copies.BLOCK
    for r in many.groupBy("block", "part").agg(
        F.collect_list(F.when(F.col("streamed") == 0, F.col("node"))).alias("h"),
        F.collect_list(F.when(F.col("streamed") == 1, F.col("node"))).alias("s"),
    ).collect():
        pairs |= {(min(x, y), max(x, y)) for x in r["h"] for y in r["s"]}
        pairs |= {(x, y) for x in r["h"] for y in r["h"] if x < y}
    assert len(pairs) == 2000 * 1999 // 2


def test_shared_hashes():
    rng = np.random.default_rng(5)
    for size, span in ((0, 1), (3, 9), (40, 60), (300, 400)):
        one = [np.unique(rng.integers(0, span, size, dtype=np.uint64)) for _ in range(40)]
        many = [np.unique(rng.integers(0, span, size, dtype=np.uint64)) for _ in range(30)]
        for share in (0.01, 1.0):
            wanted = rng.random((40, 30)) < share
            found = near_copies.common(one, many, wanted)
            for i, j in zip(*np.nonzero(wanted), strict=True):
                assert found[i, j] == len(set(one[i].tolist()) & set(many[j].tolist()))


def test_odd_rows(spark, awkward, nothing):
    out = corpus_pipeline.distinct(spark, awkward, None)
    assert out.columns == awkward.columns
    found = [r["doc_id"] for r in out.collect()]
    assert found.count(6) == 1 and 7 not in found and found.count(10) == 1
    assert found.count(1) == 1 and not {2, 3} & set(found)  # texts without words
    # 6 of their 8 shingles are shared, so only the repeated texts go
    assert sorted(k for k in found if k is not None and 20 <= k < 30) == [20, 21, 22]
    assert corpus_pipeline.distinct(spark, nothing, None).count() == 0


def test_candidates_come_from_simhash(monkeypatch, spark):
    """Texts that share no anchor, or whose fingerprints are far apart, are not linked, however
    alike they are: nothing but SimHash proposes pairs."""
    text = " ".join(f"w{k}" for k in range(300))
    docs = spark.createDataFrame([(1, text, "en", "a", 9), (2, text + " end", "en", "a", 9)], SCHEMA)
    assert kept(spark, docs) == [1]
    with monkeypatch.context() as patch:
        patch.setattr(near_copies, "DIFFERING", -1)
        assert kept(spark, docs) == [1, 2]


def test_votes_and_strong_bits():
    """Fingerprints against votes counted shingle by shingle."""
    text = " ".join(f"w{k % 70}" for k in range(150))
    hashes = near_copies.shingle_hashes(text).tolist()
    counts = [0] * (near_copies.FINGERPRINTS * near_copies.BITS)
    for h in hashes:
        for k in range(len(counts) // 64):
            x = (h ^ int(near_copies._MASKS[k])) * int(near_copies._FACTORS[0, k]) % 2**64
            x = (x ^ x >> 32) * int(near_copies._FACTORS[1, k]) % 2**64
            x ^= x >> 29
            for bit in range(64):
                counts[64 * k + bit] += x >> bit & 1
    assert near_copies.votes(near_copies.shingle_hashes(text)).tolist() == counts
    compared, codes = near_copies.fingerprint(text)
    bits = [2 * c > len(hashes) for c in counts]
    assert int.from_bytes(compared, "little") == sum(b << k for k, b in enumerate(bits[: near_copies.COMPARED]))
    found = np.frombuffer(codes, "<i2").reshape(near_copies.FINGERPRINTS, near_copies.STRONG)
    for f, own in enumerate(found.tolist()):
        at = range(f * near_copies.BITS, (f + 1) * near_copies.BITS)
        strong = sorted(at, key=lambda k: (-abs(2 * counts[k] - len(hashes)), k))[: near_copies.STRONG]
        assert own == sorted(2 * (k - at[0]) + bits[k] for k in strong)


def test_texts_at_the_limit_share_an_anchor():
    """Pairs at 0.8 of the shingles: how many fingerprints meet, and how many bits differ."""
    rng = np.random.default_rng(3)

    def found(hashes):
        margins = 2 * near_copies.votes(hashes) - len(hashes)
        return margins[: near_copies.COMPARED] > 0

    for size, both in ((9, 8), (90, 80), (450, 400)):
        for _ in range(20):
            hashes = rng.integers(0, 1 << 64, 2 * size - both, dtype=np.uint64)
            assert (found(hashes[:size]) != found(hashes[size - both :])[: near_copies.COMPARED]).sum() <= near_copies.DIFFERING
    words = [f"w{k}" for k in range(404)]
    met = []
    for k in range(40):
        # 45 of 400 shingles change: 9 places of 5, far apart
        other = list(words)
        for place in range(10, 400, 44):
            other[place] = f"v{k}-{place}"
        a, b = (near_copies._codes(pa.array([near_copies.fingerprint(" ".join(x))[1]])) for x in (words, other))
        shared = set(near_copies.anchors_of(a)[0].tolist()) & set(near_copies.anchors_of(b)[0].tolist())
        assert shared
        met.append(len({x >> 30 for x in shared}))
        first = [near_copies.first_met(a, b, x >> 30, x & (1 << 30) - 1)[0, 0] for x in sorted(shared)]
        assert first == [True] + [False] * (len(first) - 1)
    assert 0.55 < np.mean(met) / near_copies.FINGERPRINTS < 0.75


def test_anchors_over_several_batches():
    """Runs of one anchor that are cut by batches: whole, and with their smallest node."""
    rng = random.Random(4)
    rows = sorted({(rng.randrange(40) << 30 | 5, rng.randrange(-50, 50)) for _ in range(90)})
    rows += [(99 << 30, k) for k in range(20)] + [(99 << 30 | 1, 3)]
    groups = {a: [n for b, n in rows if b == a] for a, _ in rows}
    wanted = sorted((a >> 30, a & (1 << 30) - 1, n, min(g)) for a, g in groups.items() if len(g) > 1 for n in g)
    for step in (1, 2, 3, 7, 200):
        batches = [
            pa.RecordBatch.from_pydict({"anchor": [a for a, _ in rows[k : k + step]], "node": [n for _, n in rows[k : k + step]]})
            for k in range(0, len(rows), step)
        ]
        out = [tuple(r.values()) for b in near_copies._shared(batches) for r in b.to_pylist()]
        assert sorted(r[:4] for r in out) == wanted
        flags = {}
        for band, key, _, _, more in out:
            flags.setdefault((band, key), set()).add(more)
        assert all(len(x) == 1 for x in flags.values())
        assert all(flags[a >> 30, a & (1 << 30) - 1] == {True} for a, g in groups.items() if len(g) > 2)


def test_star_edges_keep_all_digits():
    """Ids of 64 bits beside the null that marks the smallest node."""
    sets = np.arange(9, dtype="<u8").tobytes()
    rows = {"a": [2**60 + 1] * 2, "part": [0, 0], "b": [None, 2**62 + 3], "hashes": [sets, sets]}
    schema = pa.schema([("a", pa.int64()), ("part", pa.int32()), ("b", pa.int64()), ("hashes", pa.binary())])
    out = list(near_copies._at_hubs([pa.RecordBatch.from_pydict(rows, schema=schema)]))
    assert [x.to_pylist() for x in out] == [[{"a": 2**60 + 1, "b": 2**62 + 3}]]


def test_crowds_far_below_the_limit_are_not_compared_in_pairs(monkeypatch, spark):
    """Texts that share three quarters of their words meet at many anchors; none can be similar to
    another, as a quarter of its shingles are its own. Only the two that differ by a word go on."""
    rng = random.Random(6)
    common = [f"w{k}" for k in range(90)]
    rows = [(k, " ".join(common + [f"v{rng.randint(0, 10**9)}" for _ in range(30)])) for k in range(80)]
    rows.append((80, rows[7][1] + " end"))
    counts = {}

    def stored(df, name, write=near_copies.stored):
        out = write(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(near_copies, "stored", stored)
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in rows], SCHEMA)
    assert kept(spark, docs) == plain_kept(rows) == list(range(80))
    assert counts["crowds"] > 10 * counts["crowded"] / 2  # they do meet
    assert counts["members"] <= 2 * 240


def test_anchors_are_cut_where_sizes_leave_a_gap():
    """Sizes fall within an anchor; below 0.8 of the one before nothing can be similar."""
    sizes = {5: [(100, 3), (90, 1), (81, 9), (64, 2), (52, 8), (9, 4)], 6: [(7, 1)], 7: [(9, 6), (9, 7), (0, 5)]}
    rows = [(anchor, size, node) for anchor, x in sizes.items() for size, node in x]
    wanted = [(5, 3, 3, True), (5, 1, 3, True), (5, 9, 3, True), (5, 2, 2, True), (5, 8, 2, True), (7, 6, 6, True), (7, 7, 6, True)]
    for step in (1, 2, 3, 4, 20):
        batches = [
            pa.RecordBatch.from_pydict(dict(zip(("anchor", "size", "node"), map(list, zip(*rows[k : k + step], strict=True)), strict=True)))
            for k in range(0, len(rows), step)
        ]
        out = [r for b in near_copies._shared(batches) for r in b.to_pylist()]
        assert [(r["key"], r["node"], r["first"], r["like"]) for r in out] == wanted, step
        assert all(r["more"] for r in out if r["first"] == 3)
