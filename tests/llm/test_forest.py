"""The projection forest follows the table: depth, leaves, copies and recall by number of rows."""

from __future__ import annotations

import numpy as np
import pytest

from keelstone.llm import embeddings

LENGTH = 64


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    sample = rng.standard_normal((embeddings.SAMPLE, LENGTH))
    base = embeddings.unit(rng.standard_normal((8_000, LENGTH)))
    aside = rng.standard_normal((1_000, LENGTH))
    aside -= (aside * base[:1_000]).sum(axis=1, keepdims=True) * base[:1_000]
    partners = 0.951 * base[:1_000] + np.sqrt(1 - 0.951**2) * embeddings.unit(aside)
    return sample, base, partners


@pytest.mark.parametrize(
    ("rows", "copies", "comparisons"), [(10**5, 26, 15_000), (10**9, 66, 150_000)]
)
def test_work_a_vector(vectors, rows, copies, comparisons):
    """Ten thousand times the rows cost three times the copies and under twelve times the comparisons."""
    sample, base, partners = vectors
    forest = embeddings.Forest(sample, rows, 0)
    at, leaves = forest.leaves(base)
    assert len(at) <= copies * len(base)
    sizes = np.unique(leaves, return_counts=True)[1].astype(float)
    assert (sizes * (sizes - 1)).sum() / len(base) ** 2 * rows <= comparisons
    near, own = forest.leaves(partners)
    first = at < len(partners)
    shared = set(zip(at[first].tolist(), leaves[first].tolist(), strict=True)) & set(
        zip(near.tolist(), own.tolist(), strict=True)
    )
    assert len({row for row, _ in shared}) >= 0.98 * len(partners)


def test_every_vector_is_in_every_tree_once_a_leaf(vectors):
    sample, base, _ = vectors
    forest = embeddings.Forest(sample, 10**8, 3)
    at, leaves = forest.leaves(base[:3_000])
    pairs = np.stack([at, leaves], axis=1)
    assert len(np.unique(pairs, axis=0)) == len(pairs)
    trees = np.unique(np.stack([at, leaves >> 40], axis=1), axis=0)
    assert len(trees) == 3_000 * embeddings.TREES
    assert set(trees[:, 1].tolist()) == set(range(3 * embeddings.TREES, 4 * embeddings.TREES))


def test_dense_group_is_not_copied_at_every_level():
    """A group of near copies that is a third of all rows stays in few leaves."""
    rng = np.random.default_rng(6)
    sample = rng.standard_normal((embeddings.SAMPLE, LENGTH))
    sample[::3] = sample[0] + 0.02 * rng.standard_normal(sample[::3].shape)
    forest = embeddings.Forest(sample, 10**8, 0)
    at, _ = forest.leaves(embeddings.unit(sample[:3_000:3]))
    assert len(at) <= 100 * 1_000


@pytest.mark.parametrize("named", [100_000, 3])
def test_leaves_above_a_block(monkeypatch, spark, named):
    """Whether large leaves are cut or compared in one task, every link is counted once."""
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    monkeypatch.setattr(embeddings, "NAMED", named)
    rng = np.random.default_rng(7)
    dense = rng.standard_normal(16) + 0.02 * rng.standard_normal((300, 16))
    loose = rng.standard_normal((500, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([dense, loose]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    x = embeddings.unit(np.concatenate([dense, loose]))
    near = x @ x.T >= embeddings.MIN_COSINE
    assert [out[k]["n_links"] for k in range(300)] == (near.sum(axis=1) - 1)[:300].tolist()
    assert {out[k]["component_id"] for k in range(300)} == {0}
