"""Whitening against a dense eigensolver, and the exact columns against Python's integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from keelstone.llm import whitening
from keelstone.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<float>, label int"


def dense(matrix, wanted=8):
    """n, deviations, covariance, and leading pairs of whole-number vectors."""
    n = len(matrix)
    sums = [sum(int(v) for v in col) for col in matrix.T]
    scaled = np.array([[n * int(v) - s for v, s in zip(row, sums, strict=True)] for row in matrix], dtype=object)
    deviation = [sum(v * v for v in row) for row in scaled]
    centred = (scaled / n).astype(float)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    return n, deviation, centred, covariance, values[::-1][:wanted], vectors[:, ::-1][:, :wanted]


def check(rows, vectors):
    """The rows of the query against the dense solution; ``vectors`` are (id, entries) kept."""
    matrix = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in vectors])
    n, deviation, centred, covariance, values, axes = dense(matrix)
    assert len(rows) == len(vectors) * len(values)
    wanted = sorted((i, d) for (i, _), d in zip(vectors, deviation, strict=True))
    assert sorted((r["vec_id"], r["deviation"]) for r in rows if r["component"] == 1) == wanted
    assert {r["n"] for r in rows} == {n}
    assert {r["component"] for r in rows} == set(range(1, len(values) + 1))
    of = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    for k in range(len(values)):
        expected = centred @ axes[:, k] / np.sqrt(values[k])
        got = np.array([of[i, k + 1] for i, _ in vectors])
        sign = np.sign(got @ expected)
        assert np.abs(got - sign * expected).max() < 1e-8
        (explained,) = {r["explained"] for r in rows if r["component"] == k + 1}
        assert abs(explained - values[k] / np.trace(covariance)) < 1e-9
    (error,) = {r["identity_error"] for r in rows}
    assert error < 1e-10
    return of


def test_query(spark, sf_dir):
    rows = QUERIES["op13_whitening"](spark, sf_dir).collect()
    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    check(rows, [(r["vec_id"], r["embedding"]) for r in source])


@pytest.mark.parametrize("size", [1, 2, 7, 64, 300])
def test_pairs_of_known_matrices(size):
    draw = np.random.default_rng(size)
    axes = np.linalg.qr(draw.standard_normal((size, size)))[0]
    for values in (
        0.9 ** np.arange(size),  # close together
        np.r_[1e6, np.ones(size - 1)],  # one far off, the rest equal
        np.arange(size, 0.0, -1),
        np.r_[np.ones(min(3, size)), np.zeros(max(0, size - 3))],  # fewer directions than wanted
    ):
        matrix = (axes * values) @ axes.T
        found = whitening.leading_pairs(lambda block, m=matrix: m @ block, size)
        k = len(found.values)
        assert k == min(8, size)
        assert np.abs(found.values - values[:k]).max() <= 1e-12 * values[0]
        assert np.linalg.norm(matrix @ found.vectors - found.vectors * found.values, axis=0).max() <= 1e-13 * values[0]
        assert np.abs(found.vectors.T @ found.vectors - np.eye(k)).max() < 1e-13


def test_the_search_is_not_a_whole_decomposition():
    """Far fewer products than columns, each with few columns."""
    draw = np.random.default_rng(1)
    axes = np.linalg.qr(draw.standard_normal((1500, 1500)))[0]
    matrix = (axes * (0.8 ** np.arange(1500) + 1e-4)) @ axes.T
    widths = []

    def product(block):
        widths.append(block.shape[1])
        return matrix @ block

    found = whitening.leading_pairs(product, 1500)
    assert np.abs(found.values - (0.8 ** np.arange(8) + 1e-4)).max() < 1e-13
    assert max(widths) <= 16 and sum(widths) < 750


def test_odd_rows(spark):
    rng = random.Random(2)
    good = [(k, [rng.gauss(k % 5, 1) for _ in range(5)]) for k in range(60)]
    good += [(7, good[7][1]), (None, good[3][1]), (2**62, [0.0] * 5), (-4, [-0.0] * 5)]
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [math.nan] * 5)]
    bad += [(904, [math.inf, 0.0, 0.0, 0.0, 0.0]), (905, [0.0] * 4), (906, [1e20, 0.0, 0.0, 0.0, 0.0])]
    rows = [(i, v, 1, 0.5, i, "k") for i, v in good + bad]
    schema = "vec_id long, embedding array<double>, label int, whitened double, x long, n string"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    out = whitening.whiten(docs)
    got = out.collect()
    assert len(got) == 5 * len(good) and {r["vec_id"] for r in got} == {i for i, _ in good}
    once = [r for r in got if r["component"] == 1]
    assert len([r for r in once if r["vec_id"] == 7]) == 2
    matrix = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in good])
    wanted = sorted(dense(matrix)[1])
    assert sorted(r["deviation"] for r in once) == wanted


def test_large_entries_stay_exact(spark):
    rng = random.Random(3)
    good = [(k, [rng.uniform(-1, 1) * 2.0**45 for _ in range(3)]) for k in range(40)]
    out = whitening.whiten(spark.createDataFrame(good, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in out} == {None} and {r["n"] for r in out} == {40}
    assert all(r["identity_error"] < 1e-9 for r in out)
    small = [(k, [rng.uniform(-1, 1) for _ in range(3)]) for k in range(40)]
    check(whitening.whiten(spark.createDataFrame(small, "vec_id long, embedding array<double>")).collect(), small)


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [None, []]])
def test_nothing_varies(spark, vectors):
    out = whitening.whiten(spark.createDataFrame([(k, v, 1) for k, v in enumerate(vectors)], ROWS))
    assert out.columns == [x.split()[0] for x in whitening.SCHEMA.split(", ")] and out.count() == 0


def test_fewer_directions_than_wanted(spark):
    rng = random.Random(4)
    rows = []
    for k in range(50):
        a, b = rng.randint(-9, 9), rng.randint(-9, 9)
        rows.append((k, [float(a), float(b), float(a + b), float(a - b)] + [1.0] * 10, 0))
    out = whitening.whiten(spark.createDataFrame(rows, ROWS)).collect()
    assert {r["component"] for r in out} == {1, 2}
    assert abs(sum({r["explained"] for r in out}) - 1) < 1e-9 and out[0]["identity_error"] < 1e-9
