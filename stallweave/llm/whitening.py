"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers, so sums and deviations are exact.  The centred rows X are never moved: a step sends a direction to
the tasks and gets back X'Xq, the norm of Xq and its products with the former left vectors, added up on the way.  A left
vector is always a combination of X's columns, u_j = X p_j; tasks make it again from p_j, so nothing as long as the table
is kept and a lost executor costs one task's work.

    alpha_k u_k = X v_k - beta_(k-1) u_(k-1)        beta_k v_(k+1) = X'u_k - alpha_k v_k

Both sequences are orthogonalised in full, the left one again in a second pass where the first leaves a rest.  The
small bidiagonal's SVD gives the components.  Where beta vanishes, a fresh start vector orthogonal to all former ones goes on,
which finds equal eigenvalues, too.  Steps end when the wanted components have converged and the trace proves that
nothing of their size is missing, at the latest after as many steps as the vectors have dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.llm.tables import slices, stored

SCALE, SHIFT = 64, 1_000_000
#: Left vectors whose products with a former one exceed this are orthogonalised once more.
REST = 1e-13
#: Steps whose bound on every wanted component's residual is below this, relative to the largest, have converged.
CONVERGED = 1e-15
#: Directions shorter than this, relative to the largest, are rounding noise.
NOISE = 1e-12
#: Arrow's batches are worked through in slices of this size.
SLICE_BYTES = 8 << 20


class Fit(NamedTuple):
    """What the fit list gives: its size, the sums of each dimension, unit components by falling eigenvalue, the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 of each entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT))


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is there, not empty and without null or non-finite entries."""
    infinite = F.lit(float("inf"))
    good = F.forall(column, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < infinite), F.lit(False)))
    return vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & good)


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims)


def centred(batch: pa.RecordBatch, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, from the exact numerator."""
    return (matrix(batch, len(sums)) * n - sums) / n


def added(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``part`` (``size`` doubles) over all rows; every task sends one row, one task adds these."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in slices(batches, SLICE_BYTES):
            if batch.num_rows:
                total += part(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def of_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for data in batch.column("part").to_pylist():
                total += np.frombuffer(data)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    # Collected, since a limit would end the Python workers before their time and every step would start new ones.
    found = rows.mapInArrow(of_task, "part binary").repartition(1).mapInArrow(of_all, "part binary").collect()
    return sum((np.frombuffer(row["part"]) for row in found), np.zeros(size))


def orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``vector`` without its parts along ``basis``; twice is enough."""
    if basis:
        rows = np.array(basis)
        for _ in range(2):
            vector = vector - rows.T @ (rows @ vector)
    return vector


def left_step(rows: DataFrame, n: int, sums: np.ndarray, q: np.ndarray, lefts: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
    """|Xq|, X'Xq and the products of Xq with the left vectors X p_j."""
    dims, basis = len(sums), np.array(lefts).reshape(-1, len(sums)).T

    def part(batch: pa.RecordBatch) -> np.ndarray:
        x = centred(batch, n, sums)
        t = x @ q
        return np.r_[t @ t, x.T @ t, (x @ basis).T @ t]

    got = added(rows, part, 1 + dims + len(lefts))
    return float(np.sqrt(got[0])), got[1 : 1 + dims], got[1 + dims :]


def bidiagonalise(rows: DataFrame, n: int, sums: np.ndarray, wanted: int, trace: float, seed: int = 20240229) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit components (as rows) of the covariance of ``rows``, at most ``wanted`` and none of value 0."""
    dims, rng = len(sums), np.random.default_rng(seed)
    rights: list[np.ndarray] = []
    lefts: list[np.ndarray] = []
    products: list[np.ndarray] = []
    alphas: list[float] = []
    betas: list[float] = []
    values, vectors = np.empty(0), np.empty((0, dims))
    scale = np.sqrt(trace * n)
    v = orthogonal(rng.standard_normal(dims), rights)
    v /= np.linalg.norm(v)
    while len(rights) < dims:
        # X v_k without its parts along all former left vectors, whose products with it are known: (X'u_j) v_k.
        q = v.copy()
        for p, z in zip(lefts, products):
            q -= (z @ v) * p
        rights.append(v)
        alpha, z, rest = left_step(rows, n, sums, q, lefts)
        if lefts and alpha > NOISE * scale and np.abs(rest).max() > REST * alpha:
            q = q - np.array(lefts).T @ rest
            alpha, z, rest = left_step(rows, n, sums, q, lefts)
        if alpha <= NOISE * scale:
            # Nothing of X is left along v: a zero on the diagonal, and a fresh start.
            alpha, p, z = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            p, z = q / alpha, z / alpha
        lefts.append(p)
        products.append(z)
        alphas.append(alpha)
        after = orthogonal(z, rights)
        beta = float(np.linalg.norm(after))
        if len(rights) < dims and beta <= NOISE * scale:
            beta, after = 0.0, orthogonal(rng.standard_normal(dims), rights)
            after /= np.linalg.norm(after)
            v = after
        elif len(rights) < dims:
            v = orthogonal(after / beta, rights)
            v /= np.linalg.norm(v)
        betas.append(beta)
        small = np.diag(alphas) + np.diag(betas[:-1], 1)
        left, values, right = np.linalg.svd(small)
        vectors = right @ np.array(rights)
        if len(rights) >= wanted:
            found = values**2 / n
            residuals = beta * np.abs(left[-1, :wanted])
            if (residuals <= CONVERGED * values[0]).all() and trace * (1 + 1e-12) - found.sum() < found[wanted - 1] * (1 - 1e-9):
                break
    real = min(wanted, int((values > NOISE * scale).sum()))
    return values[:real] ** 2 / n, vectors[:real] / np.linalg.norm(vectors[:real], axis=1, keepdims=True)


def prepared(vectors: DataFrame, key: str, column: str) -> tuple[DataFrame, int, np.ndarray]:
    """The usable rows as (key, x), written, with their number and the sums of each dimension.

    The dimension is that of most usable vectors, the larger one in a tie; vectors of another size are not usable.
    """
    rows = usable(vectors.select(F.col(key).alias("key"), F.col(column).alias("v")), "v")
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("m")).agg(F.max(F.struct("m", "dims")).alias("best")).first()["best"]
    if sizes is None:
        return rows.select("key", F.lit(None).cast("array<long>").alias("x")), 0, np.empty(0, np.int64)
    rows, _ = stored(rows.where(F.size("v") == sizes["dims"]).select("key", whole_numbers(F.col("v")).alias("x")), "whole-vectors")
    sums = rows.select(F.posexplode("x").alias("dim", "c")).groupBy("dim").agg(F.sum("c").alias("s"), F.max(F.abs("c")).alias("most")).orderBy("dim").collect()
    if max(r["most"] for r in sums) * 2 * sizes["m"] >= 1 << 63:
        raise OverflowError("n x - S exceeds 64 bits")
    return rows, sizes["m"], np.array([r["s"] for r in sums], np.int64)


def fit(rows: DataFrame, n: int, sums: np.ndarray, components: int) -> Fit:
    """Leading components of all ``rows`` (key, x)."""
    dims = len(sums)
    squares = added(rows, lambda batch: (centred(batch, n, sums) ** 2).sum(axis=0), dims)
    trace = float(squares.sum() / n)
    if trace == 0.0:
        return Fit(n, sums, np.empty((0, dims)), np.empty(0), 0.0)
    values, found = bidiagonalise(rows, n, sums, min(components, dims), trace)
    return Fit(n, sums, found, values, trace)


def whitened_rows(batch: pa.RecordBatch, model: Fit) -> np.ndarray:
    return centred(batch, model.n, model.sums) @ model.components.T / np.sqrt(model.eigenvalues)


def identity_error(rows: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    k = len(model.eigenvalues)
    mean = added(rows, lambda batch: whitened_rows(batch, model).sum(axis=0), k) / model.n

    def part(batch: pa.RecordBatch) -> np.ndarray:
        w = whitened_rows(batch, model) - mean
        return (w.T @ w).ravel()

    return float(np.abs(added(rows, part, k * k).reshape(k, k) / model.n - np.eye(k)).max())


def deviations(batch: pa.RecordBatch, model: Fit) -> np.ndarray:
    """Sum over dimensions of (n x - S)^2, exact; an error where it exceeds 64 bits."""
    numerator = matrix(batch, len(model.sums)) * model.n - model.sums
    if (numerator.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0) >= 9.2e18:
        raise OverflowError("a deviation exceeds 64 bits")
    return (numerator * numerator).sum(axis=1)


def whiten(vectors: DataFrame, components: int = 32, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable row and component of ``vectors``.

    Vectors that are null, empty, hold null or non-finite entries or have another size than most go.  Components of variance
    0 cannot be whitened and are left out, so equal vectors, a single one or an empty table give no rows.  Repeated rows count
    each; null ids stay; other columns are ignored.
    """
    rows, n, sums = prepared(vectors, key, column)
    model = fit(rows, n, sums, components) if n else Fit(0, sums, np.empty((0, 0)), np.empty(0), 0.0)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    k = len(model.eigenvalues)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    error, explained = identity_error(rows, model), model.eigenvalues / model.trace

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_BYTES // 16):
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(np.repeat(deviations(batch, model), k)),
                    pa.array(whitened_rows(batch, model).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(work, schema)
