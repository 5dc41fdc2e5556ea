"""Exact duplicates against SQL and a plain version."""

from __future__ import annotations

import collections
import hashlib
import re

import compare
import pytest
from pyspark.sql import functions as F

from keelstone.llm import exact_dedup
from keelstone.llm.queries import QUERIES, SQL

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def plain(rows):
    """The rows wanted for (id, text) pairs; of repeated rows one is kept."""
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[norm(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((x for x in ids if x is not None), default=None)
        first = True
        for x in sorted(ids, key=lambda x: (x is None, x or 0)):
            out.append((x, keep, len(ids), x == keep and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and x != keep
    return sorted(out, key=repr)


def result(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


DIGESTS = {
    "production": exact_dedup.content_hash,
    "one value": lambda text: F.lit(1),
    "few values": lambda text: F.length(text) % 3,
}


@pytest.mark.parametrize("kind", DIGESTS)
def test_odd_rows_and_collisions(spark, awkward, nothing, kind):
    got = result(exact_dedup.classify(awkward, digest=DIGESTS[kind]))
    assert got == plain(pairs(awkward))
    empty = exact_dedup.classify(nothing, digest=DIGESTS[kind])
    assert empty.columns == COLUMNS and empty.count() == 0


def test_white_space_only_counts_as_one_space(spark):
    texts = ["a b", "a  b", "a\t\n b", "a b", " a b", "", None, " ", "\n\n", "A b", "a\x0bb", "a\x1cb"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(exact_dedup.classify(docs)) == plain(rows)


def test_a_third_of_all_rows_in_one_group(spark):
    rows = [(k, "hot text" if k % 3 == 0 else f"text {k % 1000}") for k in range(5000, 0, -1)]
    rows += [(3, "hot text")] * 10_000  # one row repeated
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(exact_dedup.classify(docs)) == plain(rows)


def test_sql(spark, sf_dir):
    name = "op12_exact_dedup"
    error, n = compare.compare(spark, compare.connect(sf_dir), name, QUERIES[name], SQL[name], sf_dir)
    assert error is None and n == 200


def test_no_python_in_the_plan(spark, sf_dir, plan_text):
    plan = plan_text(QUERIES["op12_exact_dedup"](spark, sf_dir))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_keep_one(spark, awkward, nothing):
    out = exact_dedup.keep_one(awkward)
    assert out.columns == awkward.columns
    best = {}
    for doc_id, text in pairs(awkward):
        rank = (doc_id is None, doc_id or 0)
        best[norm(text)] = min(best.get(norm(text), rank), rank)
    assert sorted((norm(t), (i is None, i or 0)) for i, t in pairs(out)) == sorted(best.items())
    assert exact_dedup.keep_one(nothing).count() == 0
    again = exact_dedup.keep_one(awkward.repartition(3))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, out.collect()))
