"""Operator 13: embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never multiplied out to a covariance.  Each step is one pass
over the written rows: every task forms its part of u = Xv (the recurrence is kept in
the row space, u = Xz) and of X'u, together with the products that reorthogonalise u
against all earlier left vectors.  Right vectors are reorthogonalised twice.  What
reaches the driver is one row of at most 2d + 1 numbers a task; the d by d bidiagonal
matrix is decomposed there.  A breakdown restarts from a vector orthogonal to all
earlier ones, so repeated eigenvalues are found as often as they occur.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.scratch import written

#: Entries of one numpy block: rows are taken a slice at a time, whatever the batch holds.
BLOCK = 1 << 21
SEED = 20240229
#: A singular value of less than this share of the largest counts as zero (it can't be divided by).
RANK = 1e-9


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """(vec_id, x): entries as floor(scale * c) + shift.

    Rows go whose vector is null, is empty, holds a null or non-finite entry or one
    that doesn't fit a long, or is not of the commonest length (ties: the longest).
    """
    c = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    sound = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(2.0**62 / scale))
    doubles = vectors.select(F.col(id_col).cast("long").alias("vec_id"), c.alias("c")).where((F.size("c") > 0) & F.forall("c", sound))
    rows = written(doubles.select("vec_id", F.transform("c", lambda v: F.floor(v * F.lit(float(scale))) + F.lit(shift)).alias("x")), "whitening-rows")
    commonest = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (commonest.d if commonest else 0))


def _blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, int, pa.RecordBatch, np.ndarray]]:
    """Slices (from, to) of each batch with their rows as an integer matrix."""
    for b in batches:
        if not b.num_rows:
            continue
        lists = b.column(b.schema.get_field_index(column))
        x = lists.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        step = max(1, BLOCK // x.shape[1])
        for at in range(0, len(x), step):
            yield at, min(at + step, len(x)), b, x[at : at + step]


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``part`` over all blocks of ``rows.x``: one row a task, added in the order of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, _, _, x in _blocks(batches, "x"):
            y = part(x)
            total = y if total is None else total + y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])

    return np.sum([r["total"] for r in rows.select("x").mapInArrow(run, "total array<double>").collect()], axis=0)


def _exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the sum of each dimension, as whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for a, b, _, x in _blocks(batches, "x"):
            wide = x if int(np.abs(x).max()) < 2**62 // max(len(x), 1) else x.astype(object)
            n, total = n + b - a, total + wide.sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(s) for s in total]])], names=["n", "sums"])

    parts = rows.select("x").mapInArrow(run, "n long, sums array<string>").collect()
    return sum(r["n"] for r in parts), [sum(map(int, s)) for s in zip(*(r["sums"] for r in parts))]


class Centre:
    """The mean S/n as a whole part and a fraction, so that x - S/n loses no digit."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2 of each row, exact; null where it doesn't fit a long."""
        far = x - self.whole
        if self.n * (int(np.abs(far).max()) + 1) < int((2**62 // x.shape[1]) ** 0.5):
            return ((self.n * far - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * far.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def principal_axes(rows: DataFrame, centre: Centre, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of the centred rows and their right vectors (columns), by bidiagonalisation."""
    rng = np.random.default_rng(SEED)

    def orthogonal(w: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
        if to:
            basis = np.array(to)
            for _ in range(2):
                w = w - basis.T @ (basis @ w)
        return w

    def products(z: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """X'u, u_i'u for all earlier i, u'u, where u = Xz and u_i = X left_i."""

        def part(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            u = c @ z
            return np.concatenate([c.T @ u, (c @ left).T @ u, [u @ u]])

        total = _summed(rows, part)
        return total[:d], total[d:-1], float(total[-1])

    v = rng.standard_normal(d)
    v /= np.linalg.norm(v)
    rights, lefts, images = [v], [], []  # v_j;  z_j with u_j = X z_j;  X'u_j
    alphas, betas, scale = [], [], 0.0
    while True:
        z = rights[-1] - (betas[-1] * lefts[-1] if betas else 0.0)
        for _ in range(3):  # once more where most of u was cancelled
            s, dots, square = products(z, np.array(lefts).reshape(-1, d).T)
            if len(dots):
                z, s = z - np.array(lefts).T @ dots, s - np.array(images).T @ dots
            left_over = square - float(dots @ dots)
            if left_over >= 0.5 * square:
                break
        alpha = max(left_over, 0.0) ** 0.5
        scale = max(scale, alpha)
        if alpha <= 1e-12 * scale or not alpha:  # v lies where X is zero
            alpha, z, s = 0.0, np.zeros(d), np.zeros(d)
        else:
            z, s = z / alpha, s / alpha
        lefts.append(z)
        images.append(s)
        alphas.append(alpha)
        if len(rights) == d:
            break
        w = orthogonal(s - alpha * rights[-1], rights)
        beta = float(np.linalg.norm(w))
        scale = max(scale, beta)
        if beta <= 1e-12 * scale or not beta:  # the space is whole: go on outside it
            beta, w = 0.0, orthogonal(rng.standard_normal(d), rights)
        betas.append(beta)
        rights.append(w / np.linalg.norm(w))
    _, sigma, q = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
    return sigma, np.array(rights).T @ q.T


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    The fit list is each distinct scaled vector once; all means and covariances are
    over it (divisor n).  Which rows are left out: see ``scaled``.  A component's sign
    makes its largest entry positive.  Components without variance are not returned,
    so equal vectors alone (or one) give no rows, as an empty table does.  Null ids
    and repeated rows stay.  A deviation beyond a long is null.  Other columns are
    ignored.  Passes: one for each dimension, and four.
    """
    rows = scaled(vectors, id_col, vec_col)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = written(rows.select("x").distinct(), "whitening-fit")
    n, sums = _exact_sums(fit)
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    centre, d = Centre(n, sums), len(sums)
    trace = float(_summed(fit, lambda x: np.array([(centre(x) ** 2).sum()]))[0])
    if not trace:
        return vectors.sparkSession.createDataFrame([], schema)
    sigma, axes = principal_axes(fit, centre, d)
    m = min(components, int((sigma > RANK * sigma[0]).sum()))
    axes = axes[:, :m]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(m)])
    scaling = axes * (n**0.5 / sigma[:m])
    explained = sigma[:m] ** 2 / trace
    mean = _summed(fit, lambda x: (centre(x) @ scaling).sum(axis=0)) / n

    def square(x: np.ndarray) -> np.ndarray:
        w = centre(x) @ scaling - mean
        return (w.T @ w).ravel()

    error = float(np.abs(_summed(fit, square).reshape(m, m) / n - np.eye(m)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, batch, x in _blocks(batches, "x"):
            k, w = b - a, centre(x) @ scaling
            ids = batch.column(0).slice(a, k).take(pa.array(np.repeat(np.arange(k), m)))
            deviation = pa.array(centre.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(k), m)))
            numbers = pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k))
            columns = [ids, numbers, pa.array(np.full(k * m, n)), deviation, pa.array(w.ravel()), pa.array(np.tile(explained, k)), pa.array(np.full(k * m, error))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.replace(",", "").split()[::2])

    return rows.select("vec_id", "x").mapInArrow(run, schema)
