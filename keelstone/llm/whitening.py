"""Whitening of embeddings by their leading principal components: Jacobi-Davidson.

The covariance is never formed. Spark multiplies it with a thin block of columns: every
task centres its blocks of vectors exactly, multiplies twice and adds up, and the sums
of all tasks meet in one aggregation with a row per dimension. The search itself works
on a few columns as long as a vector:

* Rayleigh-Ritz in the subspace searched so far gives the leading pairs and residuals;
* a pair whose residual has reached double precision is locked: it stays in the
  subspace but gets no further corrections;
* every other pair gets the correction equation ``(I - UU')(V - e)(I - UU') t = -r``,
  solved roughly by MINRES. All equations advance together, so a step of the solver is
  one product over the data whatever the number of pairs;
* the corrections extend the subspace, and a full one shrinks to its best directions.

Vectors are read as whole numbers, ``floor(1024 c) + 100000``, and kept as such in
stored blocks, so that sums, deviations and ``n x - S`` are exact.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelstone.llm.common import stored

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
#: Entries from here on have no exact whole number in 64 bits; their rows are dropped.
LARGEST = float(1 << 52)
ROWS_PER_BLOCK = 2048
SEED = 42
INNER_STEPS = 4
OUTER_STEPS = 100
#: A residual of so many units in the last place of the largest eigenvalue is double precision.
UNITS = 64
EPS = np.finfo(np.float64).eps
#: The covariance and its trace agree with zero below this share of the largest eigenvalue.
RANK_SHARE = 1e-12


# --- the search, on blocks of columns


def _minres(apply, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of ``apply(x) = rhs`` for every column at once."""

    def unit(block):
        length = np.linalg.norm(block, axis=0)
        return length, block / np.where(length > 0, length, 1)

    eta, v = unit(rhs)
    x = np.zeros_like(rhs)
    v_old, w, w_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    c = c_old = np.ones(rhs.shape[1])
    s = s_old = beta = np.zeros(rhs.shape[1])
    for _ in range(steps):
        image = apply(v)
        alpha = (v * image).sum(axis=0)
        next_beta, v_next = unit(image - alpha * v - beta * v_old)
        delta = c * alpha - c_old * s * beta
        rho = np.hypot(delta, next_beta)
        rho = np.where(rho > 0, rho, 1)
        direction = (v - s_old * beta * w_old - (s * alpha + c_old * c * beta) * w) / rho
        c_old, s_old, c, s = c, s, delta / rho, next_beta / rho
        x += c * eta * direction
        eta = -s * eta
        v_old, v, w_old, w, beta = v, v_next, w, direction, next_beta
    return x


def _extended(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Orthonormal columns that ``block`` adds to ``basis``."""
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
        length = np.linalg.norm(block, axis=0)
        block = block[:, length > 0] / length[length > 0]
    block, r = np.linalg.qr(block)
    block = block[:, np.abs(np.diag(r)) > 1e-10]
    block -= basis @ (basis.T @ block)
    return np.linalg.qr(block)[0]


@dataclasses.dataclass
class Pairs:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


def leading_pairs(product: Callable, size: int, wanted: int = COMPONENTS) -> Pairs:
    """The largest eigenvalues of a symmetric operator and their unit vectors, to double precision.

    ``product`` multiplies a block of columns. Values fall; the largest entry of every
    vector is positive. Raises where residuals stay above double precision.
    """
    wanted, full, calls = min(wanted, size), min(size, 8 * wanted), 0

    def times(block):
        nonlocal calls
        calls += 1
        return product(block)

    draw = np.random.default_rng(SEED)
    basis = np.linalg.qr(draw.standard_normal((size, min(size, 2 * wanted))))[0]
    images = times(basis)
    best, stalled = np.inf, 0
    for _ in range(OUTER_STEPS):
        small = basis.T @ images
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        e, u = values[:wanted], basis @ turns[:, :wanted]
        residual = images @ turns[:, :wanted] - u * e
        norms = np.linalg.norm(residual, axis=0)
        scale = max(abs(values[0]), abs(values[-1]))
        locked = norms <= UNITS * EPS * scale
        stalled = stalled + 1 if norms.max() > 0.5 * best else 0
        best = min(best, norms.max())
        if locked.all() or basis.shape[1] == size or (stalled > 3 and best <= RANK_SHARE * scale):
            break
        open_ = ~locked

        def projected(block, u=u, shift=e[open_]):
            image = times(block)
            image = image - block * shift
            return image - u @ (u.T @ image)

        rhs = -residual[:, open_]
        rhs -= u @ (u.T @ rhs)
        steps = _minres(projected, rhs, INNER_STEPS)
        if basis.shape[1] + steps.shape[1] > full < size:
            keep = turns[:, : 2 * wanted]
            basis, images = basis @ keep, images @ keep
        more = _extended(basis, np.c_[steps, draw.standard_normal((size, 1))])
        more = more[:, : size - basis.shape[1]]
        basis, images = np.c_[basis, more], np.c_[images, times(more)]
    else:
        raise RuntimeError(f"residuals stay at {norms.max() / scale:.1e} of the largest eigenvalue")
    # once more from fresh products, free of what restarts have added up
    basis = np.linalg.qr(basis @ turns[:, : min(size, 2 * wanted)])[0] if basis.shape[1] < size else basis
    images = times(basis)
    small = basis.T @ images
    values, turns = np.linalg.eigh((small + small.T) / 2)
    e, turns = values[::-1][:wanted], turns[:, ::-1][:, :wanted]
    u = basis @ turns
    norms = np.linalg.norm(images @ turns - u * e, axis=0)
    signs = np.sign(u[np.abs(u).argmax(axis=0), np.arange(wanted)])
    return Pairs(e, u * np.where(signs == 0, 1, signs), norms, calls)


# --- vectors as whole numbers


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id`` and ``x`` of the rows whose vector has finite entries throughout."""
    entries = rows.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)) & ~F.isnan(c))
    # one of many branches, not a filter, so that no entry is turned into a number before it is known to be finite
    whole = F.when(
        F.coalesce(finite, F.lit(False)) & (F.size("vector") > 0),
        F.transform("vector", lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(SHIFT)),
    )
    return entries.select("vec_id", whole.alias("x")).where("x IS NOT NULL")


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_BLOCK):
            x = _matrix(batch.column("x").slice(at, ROWS_PER_BLOCK))
            # int64 holds these sums: fewer than 2^12 entries below 2^63 / 2^12 or Python's integers
            wide = x if np.abs(x).max() < 1 << 50 else x.astype(object)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(x)], pa.int32()),
                    pa.array([x.astype("<i8").tobytes()], pa.binary()),
                    pa.array([[str(v) for v in wide.sum(axis=0)]], pa.list_(pa.string())),
                    pa.array([int(np.abs(x).max())], pa.int64()),
                ],
                names=["rows", "data", "sums", "most"],
            )


@dataclasses.dataclass(frozen=True)
class Centre:
    """Count, sums and largest magnitude of all vectors."""

    n: int
    sums: tuple[int, ...]
    most: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: 64-bit numbers where they suffice, else Python's."""
        if 2 * self.n * self.most < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def _decoded(batches, size: int):
    for batch in batches:
        for data in batch.column("data"):
            yield np.frombuffer(data.as_py(), "<i8").reshape(-1, size)


def _sums(blocks: DataFrame, of: Callable, columns: int) -> np.ndarray:
    """Sum over all blocks of a matrix with few rows that ``of`` gives for the blocks of a task."""

    def partial(batches):
        total = of(batches)
        if total is not None:
            names = [f"c{k}" for k in range(columns)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), *map(pa.array, np.ascontiguousarray(total.T))], names=["row", *names]
            )

    schema = ", ".join(["row long", *(f"c{k} double" for k in range(columns))])
    parts = blocks.select("data").mapInArrow(partial, schema)
    total = parts.groupBy("row").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(columns)])
    return np.array([r[1:] for r in sorted(tuple(r) for r in total.collect())])


def covariance_product(blocks: DataFrame, centre: Centre, block: np.ndarray) -> np.ndarray:
    """The covariance times a block of columns, from one pass over the data."""

    def of(batches):
        total = None
        for x in _decoded(batches, len(centre.sums)):
            c = centre.centred(x)
            part = c.T @ (c @ block)
            total = part if total is None else total + part
        return total

    return _sums(blocks, of, block.shape[1]) / centre.n


def _moments(blocks: DataFrame, centre: Centre, whitener: np.ndarray) -> tuple[np.ndarray, float]:
    """Covariance of the whitened vectors, and the trace of the covariance."""
    k = whitener.shape[1]

    def of(batches):
        total = None
        for x in _decoded(batches, len(centre.sums)):
            c = centre.centred(x)
            w = c @ whitener
            part = np.vstack([w.T @ w, w.sum(axis=0), np.full(k, (c * c).sum())])
            total = part if total is None else total + part
        return total

    sums = _sums(blocks, of, k) / centre.n
    return sums[:k] - np.outer(sums[k], sums[k]), sums[k + 1, 0]


@dataclasses.dataclass
class Whitening:
    """A fitted whitening: ``whitener`` turns centred vectors into components."""

    centre: Centre
    pairs: Pairs
    whitener: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(vectors: DataFrame, wanted: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The whitening of all vectors, and the vectors that it can be applied to.

    Vectors of another length than most (of two equally frequent the longer) are left
    out. None where no vector varies.
    """
    lengths = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return None, vectors
    size = lengths["d"]
    vectors = vectors.where(F.size("x") == size)
    schema = "rows int, data binary, sums array<string>, most long"
    blocks = stored(vectors.select("x").mapInArrow(_blocks, schema), "blocks")
    n, most = blocks.agg(F.sum("rows"), F.max("most")).first()
    total = blocks.select(F.posexplode("sums").alias("d", "s")).groupBy("d")
    total = total.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    centre = Centre(n, tuple(int(r["s"]) for r in sorted(total)), most)
    pairs = leading_pairs(lambda block: covariance_product(blocks, centre, block), size, wanted)
    count = int((pairs.values > RANK_SHARE * pairs.values[0]).sum()) if pairs.values[0] > 0 else 0
    if not count:
        return None, vectors
    whitener = pairs.vectors[:, :count] / np.sqrt(pairs.values[:count])
    covariance, trace = _moments(blocks, centre, whitener)
    error = float(np.abs(covariance - np.eye(count)).max())
    return Whitening(centre, pairs, whitener, pairs.values[:count] / trace, error), vectors


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _squares(deviations: np.ndarray) -> list:
    """Sums of squares, exact; None where one exceeds 64 bits."""
    if float(np.abs(deviations).max()) ** 2 * deviations.shape[1] < 2.0**62:
        return (deviations * deviations).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in deviations]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", wanted: int = COMPONENTS
) -> DataFrame:
    """For every usable vector a row per component, numbered from 1 by falling eigenvalue.

    Vectors that are null or empty, or hold null or non-finite entries (or entries of
    2^52 and more), give no rows. Repeated rows and ids are repeated in the result and
    count in the fit; a null id stays null. Directions in which the vectors do not vary
    are no components, so there may be fewer than ``wanted``, and none at all for an
    empty table, one vector, or equal vectors: the result is empty then. ``deviation``
    is null where it exceeds 64 bits. Other columns are not read.
    """
    fitted, vectors = fit(whole_vectors(rows, id_column, vector_column), wanted)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    centre, whitener, explained = fitted.centre, fitted.whitener, fitted.explained
    error, count = fitted.identity_error, fitted.whitener.shape[1]

    def project(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            deviations = centre.deviations(_matrix(batch.column("x")))
            whitened = (deviations / centre.n).astype(np.float64) @ whitener
            at = pa.array(np.repeat(np.arange(batch.num_rows), count))
            ids = batch.column("vec_id").take(at)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(ids), centre.n, dtype=np.int64)),
                    pa.array(_squares(deviations), pa.int64()).take(at),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array(np.full(len(ids), error)),
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return vectors.mapInArrow(project, SCHEMA)
