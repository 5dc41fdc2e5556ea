"""Operators over the whole corpus against brute force: fingerprints, quality, mixing,
near-duplicates, embeddings and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
import pytest
import xxhash

from keelstone.llm import embeddings, fingerprints, mixing, near_copies, quality, simhash
from keelstone.llm.common import components

# --- components


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)]
    edges += [(1000 + k, 1001 + k) for k in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    wanted = {(x, find(x)) for x in parent if find(x) != x}
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {tuple(r) for r in components(frame).collect()} == wanted
    assert components(frame.limit(0)).count() == 0


# --- fingerprints


def test_spans_and_extensions():
    rng = random.Random(6)
    for _ in range(200):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))
        one, two = fingerprints.PrefixHash(a), fingerprints.PrefixHash(b)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        n = rng.randint(0, min(len(a) - i, len(b) - j))
        assert one.equal(i, two, j, n) == (a[i : i + n] == b[j : j + n])
        common = 0
        while common < min(len(a) - i, len(b) - j) and a[i + common] == b[j + common]:
            common += 1
        assert one.common_extension(i, two, j) == common


def test_likeness():
    def mark(text):
        return fingerprints.Fingerprint(fingerprints.PrefixHash(text))

    rng = random.Random(7)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    assert fingerprints.likeness(mark(text), mark(text)) == 1
    assert fingerprints.likeness(mark(""), mark("")) == 1
    assert fingerprints.likeness(mark(""), mark("a")) == 0
    inserted = text[:2000] + "xyz" + text[2000:]
    assert fingerprints.likeness(mark(text), mark(inserted)) > 0.9
    assert fingerprints.likeness(mark(text), mark(inserted)) == fingerprints.likeness(mark(inserted), mark(text))
    other = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    assert fingerprints.likeness(mark(text), mark(other)) < 0.05
    assert fingerprints.likeness(mark("ab"), mark("ac")) == 0.5


def five_word_share(a, b):
    """Jaccard similarity of five-word shingles."""
    a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (a.split(), b.split()))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("n", [60, 300, 3000, 30_000])
def test_likeness_follows_shared_text(n):
    def mark(words):
        return fingerprints.Fingerprint(fingerprints.PrefixHash(" ".join(words)))

    rng = random.Random(n)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n)]
    edited = list(words)
    for share in (0.9, 0.5, 0.1):  # three insertions
        edited.insert(int(n * share), "inserted")
    assert fingerprints.likeness(mark(words), mark(edited)) >= 0.8 * five_word_share(" ".join(words), " ".join(edited))
    for every in (60, 40):  # an edit of any kind every so many words
        edited = []
        for k, w in enumerate(words):
            kind = k % every == 7 and rng.choice("idr")
            edited += {"i": [w, "more"], "d": [], "r": ["other"]}.get(kind, [w])
        wanted = five_word_share(" ".join(words), " ".join(edited))
        assert fingerprints.likeness(mark(words), mark(edited)) >= 0.8 * wanted
    moved = words[n // 3 :] + words[: n // 3]
    assert fingerprints.likeness(mark(words), mark(moved)) > 0.7
    other = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n)]
    assert fingerprints.likeness(mark(words), mark(other)) < 0.1
    # by brute force: all spans of both texts, cut by the same rule without prefix arrays
    if n <= 300:
        def spans(text):
            m, b = fingerprints.MODULI[0], fingerprints.BASES[0]
            def value(x):
                return sum((ord(c) + 1) * pow(b, k, m) for k, c in enumerate(x)) % m
            w, cuts = fingerprints.WINDOW, [0]
            cuts += [k for k in range(w, len(text)) if value(text[k - w : k]) * 2654435761 % 2**32 >> 28 == 0]
            return collections.Counter(value(text[a:z]) for a, z in zip(cuts, [*cuts[1:], len(text)], strict=True))
        text = " ".join(words)
        found, kept = spans(text), mark(words)
        assert set(kept.spans.tolist()) <= set(found)
        assert kept.share > 1 or set(kept.spans.tolist()) == set(found)


def test_long_runs_of_one_letter():
    one, two = (fingerprints.Fingerprint(fingerprints.PrefixHash("a" * n)) for n in (200_000, 200_001))
    assert len(one.spans) <= fingerprints.SPANS and 0.9 < fingerprints.likeness(one, two) < 1


@pytest.mark.parametrize("bucket_rows", [3, 100_000])
def test_fingerprint_rows(monkeypatch, awkward, nothing, bucket_rows):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", bucket_rows)
    rows = [(r["doc_id"], r["text"] or "") for r in awkward.collect()]
    out = fingerprints.fingerprint(awkward).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in out) == sorted((str(a), len(b)) for a, b in rows)
    by_text = collections.defaultdict(set)
    for r in out:
        by_text[r["doc_id"], r["n_chars"]].add(r["fingerprint"])
    # ids that occur once, followed by ids that occur once: the edited text is known
    count = collections.Counter(a for a, _ in rows)
    ids = sorted({a for a, _ in rows if a is not None}, reverse=True)
    texts = dict(rows)
    for a, b in zip(ids, ids[1:], strict=False):
        if count[a] == count[b] == 1:
            r = next(x for x in out if x["doc_id"] == a)
            more = len(texts[a]) // 2
            edited = texts[a][: len(texts[a]) - more] + texts[b][:more]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            mark, after, own = (
                fingerprints.Fingerprint(fingerprints.PrefixHash(x)) for x in (edited, texts[b], texts[a])
            )
            assert (r["fingerprint"], r["edited_fingerprint"]) == (str(own), str(mark))
            assert r["near_edited"] == fingerprints.likeness(own, mark)
            assert r["near_next"] == fingerprints.likeness(own, after)
    assert fingerprints.fingerprint(nothing).count() == 0


def test_last_document_is_followed_by_the_first(spark):
    docs = spark.createDataFrame([(k, f"text {k} " * 5) for k in range(40)], "doc_id long, text string")
    last = fingerprints.fingerprint(docs).where("doc_id = 0").first()
    text, first = "text 0 " * 5, "text 39 " * 5
    edited = text[: len(text) - len(text) // 2] + first[: len(text) // 2]
    assert last["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    alone = fingerprints.fingerprint(docs.where("doc_id = 3")).first()
    assert alone["near_next"] == 1


# --- near-duplicate documents


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(items, linked):
    """Smallest id reachable, for distinct (id, value) pairs."""
    group = list(range(len(items)))

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i][1], items[j][1]):
                a, b = find(i), find(j)
                group[a] = group[b] = a if items[a][0] < items[b][0] else b
    return {items[k][0]: items[find(k)][0] for k in range(len(items))}


def test_anchors_bring_all_links_together():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 2**63, 300, dtype=np.uint64)
    for flips in (0, 1, 2):
        y = x.copy()
        for _ in range(flips):
            y ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
        (rx, ax), (ry, ay) = simhash.anchors_of(x), simhash.anchors_of(y)
        of_x = {(r, a) for r, a in zip(rx.tolist(), ax.tolist(), strict=True)}
        of_y = {(r, a) for r, a in zip(ry.tolist(), ay.tolist(), strict=True)}
        assert {r for r, _ in of_x & of_y} == set(range(300))


def test_both_ways_of_comparing_agree():
    rng = np.random.default_rng(9)
    fps = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([fps, fps ^ np.uint64(1 << 5), fps[:20] ^ np.uint64(0b1010000)])
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    assert np.array_equal(simhash._spread(near), simhash._by_neighbours(fps))


def test_near_duplicates_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    wanted = plain_groups(rows, lambda a, b: (a ^ b).bit_count() <= 2)
    out = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in out} == {a: f"{b:016x}" for a, b in rows}
    assert {r["doc_id"]: r["component_id"] for r in out} == wanted
    assert len(set(wanted.values())) < len(rows)
    kept = simhash.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(wanted.values()))
    assert kept.columns == docs.columns


def test_near_duplicate_rows(awkward, nothing):
    out = simhash.near_duplicates(awkward).collect()
    assert len(out) == awkward.count()
    blank = {r["component_id"] for r in out if r["fingerprint"] == "0" * 16}
    assert blank == {1}
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(10) == 1 and ids.count(1) == 1 and 2 not in ids and 7 not in ids and 6 in ids
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


# --- quality


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney over characters, straight from its definition."""
    pad = chr(quality.PAD)
    counts = [None] * (order + 1)
    counts[order] = collections.Counter()
    for text in texts:
        padded = pad * (order - 1) + text
        counts[order].update(padded[i : i + order] for i in range(len(text)))
    for n in range(order - 1, 0, -1):
        before = collections.defaultdict(set)
        for g in counts[order]:
            before[g[-n:]].add(g[order - n - 1])
        counts[n] = {g: len(v) for g, v in before.items()}
    discount, contexts = {}, {}
    for n in range(1, order + 1):
        t = collections.Counter(counts[n].values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] + t[2] else None
        discount[n] = [
            max(0.05, min(k, k - (k + 1) * y * t[k + 1] / t[k] if y is not None and t[k] else 0.5)) for k in (1, 2, 3)
        ]
        contexts[n] = collections.defaultdict(lambda: [0, 0, 0, 0])
        for g, a in counts[n].items():
            contexts[n][g[:-1]][0] += a
            contexts[n][g[:-1]][min(a, 3)] += 1

    def probability(gram):
        p = 1 / (len(counts[1]) + 1)
        for n in range(1, order + 1):
            total, *types = contexts[n].get(gram[-n:][:-1], [0, 0, 0, 0])
            if total:
                a = counts[n].get(gram[-n:], 0)
                own = max(a - discount[n][min(a, 3) - 1], 0) if a else 0
                p = (own + sum(d * k for d, k in zip(discount[n], types, strict=True)) * p) / total
        return p

    return probability, counts


@pytest.mark.parametrize("group", [60_000, 10**9])
def test_model_against_its_definition(monkeypatch, spark, sf_dir, group):
    monkeypatch.setattr(quality, "GROUP", group)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trusted = quality.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    counted = {r["doc_id"] for r in trusted.where(~quality.held_out()).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    probability, counts = plain_model([t for k, t in texts.items() if k in counted], quality.ORDER)
    got = {r["doc_id"]: r for r in quality.score(docs, trusted).collect()}
    assert set(got) == set(texts)
    pad = chr(quality.PAD) * (quality.ORDER - 1)
    for doc_id in sorted(texts)[:40]:
        text = texts[doc_id]
        nats = -sum(math.log(probability((pad + text)[i : i + quality.ORDER])) for i in range(len(text)))
        assert got[doc_id]["size"] == len(text)
        assert got[doc_id]["nats"] == pytest.approx(nats, rel=1e-6)
    # chances of all characters seen and the unseen one add up to 1 in any context
    context = next(iter(counts[quality.ORDER]))[1:]
    total = sum(probability(context + c) for c in counts[1]) + probability(context + "\U0010fffd")
    assert total == pytest.approx(1)


def test_more_characters_than_a_plain_code_can_hold(spark):
    rng = random.Random(3)
    letters = [chr(k) for k in range(0x20, 0x10000) if not 0xD800 <= k < 0xE000 and k != quality.PAD][:60_000]
    assert (len(letters) + 1) ** quality.ORDER > 1 << 63
    texts = ["".join(rng.sample(letters, len(letters)))]
    texts += [" ".join(rng.choice(["the", "one", "two", "é", letters[-k]]) for _ in range(200)) for k in range(1, 12)]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    trusted = docs.select("doc_id")
    counted = {r["doc_id"] for r in trusted.where(~quality.held_out()).collect()}
    assert 0 < len(counted) < len(texts)
    probability, _ = plain_model([t for k, t in enumerate(texts) if k in counted], quality.ORDER)
    pad = chr(quality.PAD) * (quality.ORDER - 1)
    for row in quality.score(docs, trusted).collect():
        text = texts[row["doc_id"]]
        nats = -sum(math.log(probability((pad + text)[i : i + quality.ORDER])) for i in range(len(text)))
        assert row["nats"] == pytest.approx(nats, rel=1e-6)


def test_threshold_is_a_quantile(monkeypatch, spark):
    monkeypatch.setattr(quality, "QUANTILE", 0.9)
    monkeypatch.setattr(quality, "ENOUGH", 60)
    rng = random.Random(4)
    rows = [(k, str(k), ["a", "b", None, "none"][k % 4 if k % 40 < 4 else 0], rng.uniform(50, 300), rng.randint(60, 130)) for k in range(2000)]
    rows += [(5000, "x", "b", 0.0, 0), (None, "y", "a", 99.0, 70)]
    scores = spark.createDataFrame(rows, "doc_id long, key string, lang string, nats double, size long")
    trusted = spark.createDataFrame([(k,) for k in range(2000) if k % 40 < 39 and k % 4 != 3], "doc_id long")
    known = {r["doc_id"] for r in trusted.collect()}
    held = {r["doc_id"] for r in trusted.where(quality.held_out()).collect()}

    def quantile(values, q):
        return sorted(values)[max(0, math.ceil(q * len(values)) - 1)]

    good = [r for r in rows if r[0] in held and r[4]]
    middles = collections.defaultdict(lambda: quantile([r[3] / r[4] for r in good], 0.5))
    for lang in {r[2] for r in good}:
        middles[lang] = quantile([r[3] / r[4] for r in good if r[2] == lang], 0.5)
    rate = {r[1]: (r[3] + quality.PRIOR * middles[r[2]]) / (r[4] + quality.PRIOR) for r in rows}
    parts = collections.defaultdict(list)
    for r in (r for r in rows if r[0] in known and r[4]):
        parts[r[2]].append(rate[r[1]] / middles[r[2]])
    pooled = [x for v in parts.values() for x in v]
    assert len(parts["a"]) >= 60 > len(parts["b"]) > 0 and not parts["none"]
    for got in quality.judge(scores, trusted).collect():
        own = parts[got["lang"]] if len(parts[got["lang"]]) >= 60 else pooled
        limit = middles[got["lang"]] * quantile(own, 0.9)
        assert got["threshold"] == pytest.approx(math.exp(limit))
        assert got["kept"] == (rate[got["key"]] <= limit * (1 + 1e-12) or got["n_scored"] == 0)


def test_quality_on_labelled_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = {r["doc_id"]: r["kept"] for r in quality.classify(docs, labels).collect()}
    clean = [r["doc_id"] for r in labels.where("quality = 1 AND toxic = 0").collect()]
    poor = [r["doc_id"] for r in labels.where("quality = 0").collect()]
    assert np.mean([out[k] for k in clean]) >= 0.99
    assert np.mean([not out[k] for k in poor]) >= 0.75


def test_quality_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (6, 1, 0), (7, 0, 0), (None, 1, 0), (8, 1, None), (8, None, 1)], "doc_id long, quality int, toxic int")
    out = quality.classify(awkward, labels).collect()
    assert len(out) == awkward.count()
    assert all(r["kept"] for r in out if r["n_scored"] == 0)
    assert quality.keep_good(awkward, labels).columns == awkward.columns
    assert quality.classify(nothing, labels).count() == 0
    unlabelled = quality.classify(awkward, labels.limit(0)).collect()
    assert len(unlabelled) == awkward.count() and all(r["kept"] for r in unlabelled)


# --- mixing


def plain_targets(sizes):
    """Shares by weight, stopped at three times the size, the excess reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + k % 3 for k, s in enumerate(order)}
    left, open_, targets = float(sum(sizes.values())), set(order), {}
    while open_:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 3 * sizes[s]}
        if not full:
            return targets | share
        for s in full:
            targets[s] = 3.0 * sizes[s]
            left -= targets[s]
        open_ -= full
    return targets


def check_mix(docs, rows):
    sizes = collections.Counter()
    for _, source, text in rows:
        sizes[source] += len((text or "").encode().split())
    targets = plain_targets(sizes)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    sources = dict((r[0], r[1]) for r in rows)
    taken = collections.Counter()
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[sources[r["doc_id"]]] += r["taken"]
        assert r["source_size"] == sizes[sources[r["doc_id"]]]
        assert r["target"] == pytest.approx(targets[sources[r["doc_id"]]])
    for source, target in targets.items():
        assert taken[source] == pytest.approx(target, abs=1.5)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)


@pytest.mark.parametrize("leaf", [3, 4096])
def test_mix_meets_targets(monkeypatch, spark, sf_dir, leaf):
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_mix(docs, [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()])


def test_mix_with_limits(spark):
    rows = [(k, s, "w " * n) for k, (s, n) in enumerate([("a", 500), ("b", 3), ("c", 1), ("b", 2), (None, 40), ("d", 0)])]
    check_mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), rows)


def test_pivot_keeps_words_and_expectations():
    rng = random.Random(11)
    for _ in range(300):
        p, q, w, v = rng.uniform(0.01, 0.99), rng.uniform(0.01, 0.99), rng.randint(1, 99), rng.randint(1, 99)
        up, down = min(w * (1 - p), v * q), min(w * p, v * (1 - q))
        chance = down / (up + down)
        first, second = mixing.pivot(p, w, q, v, 0.0), mixing.pivot(p, w, q, v, 1.0 - 1e-12)
        for a, b in (first, second):
            assert a * w + b * v == pytest.approx(p * w + q * v)
            assert {a, b} & {0.0, 1.0} and 0 <= a <= 1 and 0 <= b <= 1
        assert chance * first[0] + (1 - chance) * second[0] == pytest.approx(p)
        assert chance * first[1] + (1 - chance) * second[1] == pytest.approx(q)


def test_mix_rows(awkward, nothing):
    out = mixing.mix(awkward).collect()
    assert len(out) == awkward.count()
    assert all(r["taken"] == 0 for r in out if r["size"] == 0)
    whole = mixing.mixed(awkward)
    assert whole.columns == awkward.columns
    wanted = sum(r["copies"] for r in mixing.mix(awkward, in_part=False).collect())
    assert whole.count() == wanted
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_equal_rows_are_chosen_by_their_columns(spark):
    """Rows equal in id and text that differ elsewhere: any order of rows gives the same one."""
    rows = [(1, "one two three", "a", k, {"k": str(k)}) for k in range(20)] + [(2, "four", "b", 0, None)]
    schema = "doc_id long, text string, source string, `doc.no` int, more map<string,string>"
    for keep in (mixing.mixed, simhash.keep_one, near_copies.keep_one):
        found = []
        for part in (rows, rows[::-1]):
            out = keep(spark.createDataFrame(part, schema).repartition(3))
            assert out.columns == ["doc_id", "text", "source", "doc.no", "more"]
            found.append(sorted((tuple(r) for r in out.collect()), key=repr))
        assert found[0] == found[1] and found[0]


# --- embeddings


def plain_links(rows):
    """Cosines of all pairs of usable vectors."""
    good = [
        (k, np.array(v, dtype=np.float64))
        for k, v in rows
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = {}
    for length in {len(v) for _, v in good}:
        own = [(k, v) for k, v in good if len(v) == length]
        x = np.stack([v for _, v in own])
        n = np.sqrt((x * x).sum(axis=1))
        near = x @ x.T / (n[:, None] * n[None, :]) >= 0.95
        np.fill_diagonal(near, False)
        for (k, _), row in zip(own, near, strict=True):
            links[k] = {own[j][0] for j in np.flatnonzero(row)}
    return links


def check_embeddings(spark, rows, recall):
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, node int")
    out = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    assert len(out) == len(rows)
    links = plain_links([(k, v and [x if x is None else float(np.float32(x)) for x in v]) for k, v in rows])
    wanted = sum(map(len, links.values()))
    found = sum(r["n_links"] for r in out.values())
    assert recall * wanted <= found <= wanted
    assert all(out[k]["n_links"] <= len(links.get(k, ())) for k in out)
    if recall == 1:
        groups = {}
        for k in sorted(links):
            if k not in groups:
                todo = [k]
                while todo:
                    x = todo.pop()
                    if x not in groups:
                        groups[x] = k
                        todo += links[x]
        assert {k: r["component_id"] for k, r in out.items()} == {k: groups.get(k, k) for k in out}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())


def test_embeddings_with_recall(monkeypatch, spark):
    monkeypatch.setattr(embeddings, "LEAF", 64)
    monkeypatch.setattr(embeddings, "BLOCK", 100)
    rng = np.random.default_rng(12)
    base = rng.standard_normal((1200, 32))
    near = base[:400] + 0.05 * rng.standard_normal((400, 32))
    edge = base[400:800] + 0.28 * rng.standard_normal((400, 32))  # cosines around the limit
    dense = base[0] * 2 + 0.03 * rng.standard_normal((300, 32))  # one large group of near copies
    copies = np.repeat(base[1:2], 200, axis=0)
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([base, near, edge, dense, copies]))]
    check_embeddings(spark, rows, 0.97)


def test_embedding_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]),
        (8, [2.0, 4.0]), (9, [-1.0, -2.0]), (10, [1.0, 2.0, 0.0]), (11, [1.0, 2.0]), (12, [1.0, 2.2]),
        (13, [3e38, 3e38]), (14, [1e-38, 1e-38]), (15, [-0.0, 1.0]), (16, [0.0, 1.0]),
    ]
    check_embeddings(spark, rows, 1)
    frame = spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    out = sorted((tuple(r) for r in embeddings.near_duplicates(frame).collect()), key=repr)
    assert out == [(1, 1, 1, True), (1, 1, 1, True), (None, 1, None, False)]
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_given_embeddings(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_embeddings(spark, rows, 1)
