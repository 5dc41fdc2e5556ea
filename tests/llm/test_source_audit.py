"""The audit of sources against SQL and a plain version; the pointer sort against sorted()."""

from __future__ import annotations

import collections
import itertools
import random
import re

import compare
import numpy as np
import pytest

from keelstone.llm import source_audit
from keelstone.llm.queries import QUERIES, SQL

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def terms_of(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain(rows):
    """All rows wanted for (text, lang, source)."""
    per_lang = collections.defaultdict(list)
    for text, lang, source in rows:
        per_lang[lang or ""].append((source or "", terms_of(text)))
    out = []
    for lang, texts in per_lang.items():
        holding = collections.Counter(t for _, terms in texts for t in set(terms))
        kept = sorted(t for t, n in holding.items() if n >= 3)
        counts = {s: collections.Counter() for s, _ in texts}
        for s, terms in texts:
            counts[s].update(t for t in terms if holding[t] >= 3)
        every = sum(counts.values(), collections.Counter())

        def chance(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        chances, q = {s: chance(c) for s, c in counts.items()}, chance(every)
        for s in counts:
            parts = {"pair": [], "term": []}
            for o in counts:
                if o != s:
                    f = [(chances[s][t] - chances[o][t]) ** 2 // chances[o][t] for t in kept]
                    parts["pair"].append((-sum(f), o.encode()))
            for t in kept:
                if counts[s][t] and chances[s][t] > q[t]:
                    parts["term"].append((-((chances[s][t] - q[t]) ** 2 // q[t]), t.encode()))
            for part, found in parts.items():
                found = sorted(found)[: 200 if part == "term" else None]
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(found)]
    return sorted(out)


def result(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def triples(docs):
    return [tuple(r) for r in docs.select("text", "lang", "source").collect()]


def test_pointer_sort():
    rng = random.Random(3)
    for alphabet, longest in (("ab", 40), ("abcdefé日", 12), ("a", 30), ("xyz -\n.9", 25)):
        for _ in range(60):
            texts = ["".join(rng.choices(alphabet + " ", k=rng.randint(0, longest))) for _ in range(rng.randint(1, 30))]
            data = [t.encode() for t in texts]
            offsets = np.cumsum([0, *map(len, data)])[:-1]
            found = source_audit.slice_terms(np.frombuffer(b"".join(data), np.uint8), offsets)
            words = [terms_of(t) for t in texts]
            count = collections.Counter(itertools.chain(*words))
            holding = collections.Counter(itertools.chain(*map(set, words)))
            wanted = sorted(count, key=str.encode)
            assert found[0].to_pylist() == wanted
            assert found[1].tolist() == [count[t] for t in wanted]
            assert found[2].tolist() == [holding[t] for t in wanted]


def test_long_words_that_share_long_beginnings():
    words = ["a" * n for n in (1, 6, 7, 8, 13, 14, 15, 21, 500)] + ["a" * 14 + "b", "a" * 6 + "b"]
    texts = [" ".join(random.Random(k).sample(words, len(words))) for k in range(5)]
    data = [t.encode() for t in texts]
    terms, counts, holding = source_audit.slice_terms(
        np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])[:-1]
    )
    assert terms.to_pylist() == sorted(words)
    # the last word of a text touches the first of the next, yet they are two words
    assert counts.tolist() == holding.tolist() == [5] * len(words)


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows(monkeypatch, spark, awkward, nothing, small):
    docs = awkward.unionByName(awkward.limit(4)).unionByName(awkward.where("lang = 'en'"))
    rows = triples(docs)
    if small:  # many shards, groups and blocks
        for name, value in {"SHARD_BYTES": 1, "ROWS_PER_LOOK": 3, "ROWS_PER_GROUP": 5, "SOURCES_PER_BLOCK": 2, "CELLS": 8}.items():
            monkeypatch.setattr(source_audit, name, value)
    assert result(source_audit.audit(docs)) == plain(rows)
    empty = source_audit.audit(nothing)
    assert empty.columns == COLUMNS and empty.count() == 0
    assert dict(empty.dtypes)["value"] == "bigint" and dict(empty.dtypes)["rank"] == "int"


def test_no_term_in_three_documents(spark):
    rows = [("alone", "en", "a"), ("other", "en", "b"), (None, "en", "c"), ("x", None, None), ("y", "de", "a")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = result(source_audit.audit(docs))
    assert got == plain(rows) and len(got) == 6 and {r[4] for r in got} == {0}


def test_sql(spark, sf_dir):
    name = "op11_source_audit"
    error, n = compare.compare(spark, compare.connect(sf_dir), name, QUERIES[name], SQL[name], sf_dir)
    assert error is None and n > 1000


def test_one_exchange_before_the_counts(spark, sf_dir, plan_text):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = plan_text(source_audit.term_counts(docs))
    assert plan.split("== Physical Plan ==")[1].split("\n(1)")[0].count("Exchange") == 1
