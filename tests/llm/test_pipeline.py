"""The pipeline and the contract of the registered queries."""

from __future__ import annotations

import __spark_entry__ as contract
import corpus_pipeline
from test_near_copies import plain_kept
from test_row_by_row import check_packing, plain_spans

from keelstone.llm import packing
from keelstone.llm.common import read
from keelstone.llm.queries import QUERIES, vocabulary


def test_every_operator_is_registered():
    names = contract.queries()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) <= set(names) and "pipeline" in names


def test_stages(spark, sf_dir, folder):
    """Each stage on what the one before it wrote."""
    docs = read(spark, sf_dir, "documents")
    columns, seen = docs.columns, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage-{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs)
    raw, good, distinct, masked, mixed, packed = seen
    assert all(x.columns == columns for x in (good, distinct, masked, mixed))
    assert good.exceptAll(raw).count() == 0 and distinct.exceptAll(good).count() == 0

    labels = read(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    clean = raw.join(labels, "doc_id", "left_semi")
    kept = good.join(labels, "doc_id", "left_semi")
    assert kept.count() >= 0.98 * clean.count()

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert sorted(r["doc_id"] for r in distinct.collect()) == plain_kept(rows)

    texts = {r["doc_id"]: r["text"] for r in distinct.collect()}
    for r in masked.collect():
        assert plain_spans(r["text"] or "") == []
        assert r["n_chars"] == len(r["text"]) or r["text"] is None
        if not plain_spans(texts[r["doc_id"]] or "") and "<" not in (r["text"] or ""):
            assert r["text"] == texts[r["doc_id"]]

    assert mixed.distinct().exceptAll(masked.distinct()).count() == 0
    assert 0.9 < mixed.count() / max(1, masked.count()) < 1.1 or mixed.count() > 0

    documents = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    check_packing(packed.collect(), documents)
    assert packing.pack(mixed, *vocabulary()).count() > 0


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [x.split()[0] for x in packing.SCHEMA.split(", ")]
    assert out.count() > 0
