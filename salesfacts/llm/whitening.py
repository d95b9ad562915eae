"""Embedding whitening by mixed-precision eigenvectors of a distributed covariance.

Components become whole numbers x = floor(scale * c) + shift. One pass of built-in
sums gives n and the sum S of every dimension; a second adds, task by task, the
products of x centred by floor(S / n) before multiplying. Both are whole numbers that
Spark adds exactly in any order, so a repeated task changes nothing, and what
floor() left of the mean is taken out exactly: n * n * V = n * Y'Y - s s'. Only this
matrix (width squared numbers, whatever the table's size) reaches the driver.

There the eigenvectors are found in float32 and refined by Ogita and Aishima's
iteration: from an approximate X, R = I - X'X and S = X'VX give the correction E of
every pair of separated eigenvalues, and X + XE is right to twice the digits.
Matrix products run in extended precision. Eigenvalues that are closer than the
present error bound do not determine their vectors this way; for each such cluster
the matrix, shifted by the cluster's mean, is projected on the cluster's basis and the
small problem is solved by itself (its own scale keeps the differences), then the
iteration goes on until the vectors no longer move.

Projections run on exact integers n * x - S, rounded once. The covariance of the whitened
rows is measured on the rows as stored, not derived.

Defined results: vectors that are null or hold a null, NaN or infinite component are
dropped; vectors shorter than the longest count as zero-padded; a null id is kept;
repeated rows are rows each; a width below the number of components gives as many as
there are; where V has no variance along a component (one row, or all equal) its
whitened value is null and it takes no part in the identity error, and ``explained``
is null if V is zero; an empty table gives no rows; vectors of width 0 give none.
``deviation`` is a decimal, since it leaves 64 bits on large tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesfacts.llm.codes import good_vector, whole_numbers
from salesfacts.llm.common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
ROWS = 2048  # rows of a matrix product
STEPS = 40  # corrections at most; each doubles the digits, so a few do


@dataclass(frozen=True)
class Moments:
    """n rows, exact sums of each dimension and the exact covariance times n * n."""

    n: int
    sums: list[int]
    scatter: np.ndarray  # (width, width) of int objects

    def covariance(self) -> np.ndarray:
        """V, each entry rounded once to extended precision."""
        return np.array([[_extended(Fraction(int(v), self.n * self.n)) for v in row] for row in self.scatter],
                        dtype=np.longdouble).reshape(self.scatter.shape)


def _extended(value: Fraction) -> np.longdouble:
    high = float(value)
    return np.longdouble(high) + np.longdouble(float(value - Fraction(high)))


def _products(y: np.ndarray) -> np.ndarray:
    """Y'Y of whole numbers, exactly: in doubles where no sum can pass 2 ** 53, else in unbounded integers."""
    most = max(int(y.max(initial=0)), -int(y.min(initial=0)))
    if most * most * max(1, len(y)) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    y = y.astype(object)
    return y.T @ y


def moments(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> Moments:
    """Exact moments of ``vectors`` (_vec); two passes, nothing but sums is shuffled."""
    width = vectors.agg(F.max(F.size("_vec"))).first()[0] or 0
    x = lambda i: F.floor(F.coalesce(F.get("_vec", F.lit(i)), F.lit(0.0)) * scale).cast("decimal(38,0)")
    total = vectors.agg(F.count("*").alias("n"), *[F.sum(x(i)).alias(f"s{i}") for i in range(width)]).first()
    n = total["n"]
    raw = [int(total[f"s{i}"] or 0) for i in range(width)]
    if not n or not width:
        return Moments(n, [r + n * shift for r in raw], np.zeros((width, width), dtype=object))
    middle = [r // n for r in raw]
    upper = [(i, j) for i in range(width) for j in range(i, width)]

    def run(batches):
        held, centre = np.zeros((width, width), dtype=object), np.array(middle, dtype=object)
        small = max(map(abs, middle)) < 1 << 62
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = whole_numbers(batch.slice(at, ROWS).column("_vec"), scale, width)
                y = y - (centre.astype(np.int64) if small and y.dtype != object else centre)
                held = held + _products(y)
        yield pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in upper], pa.int32()), pa.array([j for _, j in upper], pa.int32()),
            pa.array([Decimal(int(held[i, j])) for i, j in upper], pa.decimal128(38, 0))], names=["i", "j", "v"])

    found = vectors.select("_vec").mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    rest = [r - n * m for r, m in zip(raw, middle)]
    scatter = np.zeros((width, width), dtype=object)
    for r in found:  # width * (width + 1) / 2 rows
        scatter[r["i"], r["j"]] = scatter[r["j"], r["i"]] = n * int(r["v"]) - rest[r["i"]] * rest[r["j"]]
    return Moments(n, [r + n * shift for r in raw], scatter)


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues (falling) whose neighbours are within ``gap``."""
    cuts = np.flatnonzero(values[:-1] - values[1:] > gap) + 1
    return [c for c in np.split(np.arange(len(values)), cuts) if len(c) > 1]


def _correct(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: corrected vectors, eigenvalues, the gap that separates them and the largest correction."""
    one = np.eye(len(v), dtype=np.longdouble)
    r = one - x.T @ x
    s = x.T @ (v @ x)
    values = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: float(np.sqrt((m.astype(np.float64) ** 2).sum()))
    gap = 2 * (norm(s - np.diag(values)) + norm(v) * norm(r))
    apart = values[None, :] - values[:, None]
    far = np.abs(apart) > gap
    e = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
    return x + x @ e, values, gap, float(np.abs(e).max())


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix, in extended precision.

    The sign makes each vector's largest component positive.
    """
    v = v.astype(np.longdouble)
    size = float(np.abs(v).max(initial=0.0))
    if not size:
        return np.zeros(len(v), dtype=np.longdouble), np.eye(len(v), dtype=np.longdouble)
    v = v / np.longdouble(size)
    x = np.linalg.eigh(v.astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    least = 64 * len(v) * float(np.finfo(np.longdouble).eps)
    for _ in range(STEPS):
        x, values, gap, moved = _correct(v, x)
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        for c in _clusters(values, gap):
            # The cluster's own problem: shifted by its mean, on its basis made orthonormal.
            basis = x[:, c]
            basis = basis @ (1.5 * np.eye(len(c), dtype=np.longdouble) - 0.5 * (basis.T @ basis))
            middle = values[c].mean()
            small = basis.T @ (v @ basis - middle * basis)
            small = (small + small.T) / 2
            turn = np.linalg.eigh((small / max(float(np.abs(small).max()), 1e-300)).astype(np.float64))[1][:, ::-1]
            x[:, c] = basis @ turn.astype(np.longdouble)
        if moved <= least:
            break
    for _ in range(2):  # orthonormal to the last digits
        x = x @ (1.5 * np.eye(len(v), dtype=np.longdouble) - 0.5 * (x.T @ x))
    values = np.einsum("ij,ij->j", x, v @ x)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    at = np.abs(x).argmax(axis=0)
    return values * np.longdouble(size), x * np.sign(x[at, np.arange(len(v))])


@dataclass(frozen=True)
class Whitening:
    """Exact moments and the leading components; ``components`` are columns."""

    moments: Moments
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: np.longdouble

    @property
    def live(self) -> np.ndarray:
        """Whether there is variance along a component, beyond rounding."""
        return self.eigenvalues > len(self.components) * np.finfo(np.float64).eps * (self.trace or 1)


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening:
    m = moments(vectors, scale, shift)
    v = m.covariance() if m.n else np.zeros((0, 0), dtype=np.longdouble)
    values, x = eigenvectors(v)
    return Whitening(m, values[:components], x[:, :components], np.trace(v))


def _deviations(y: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S as whole numbers, in 64 bits where their squares' sum fits."""
    most = n * max(int(y.max(initial=0)), -int(y.min(initial=0))) + max((abs(int(s)) for s in sums), default=0)
    exact = object if most * most * max(1, y.shape[1]) >= 1 << 63 else np.int64
    return n * y.astype(exact) - sums.astype(exact)


def whiten(vectors: DataFrame, fitted: Whitening, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vectors`` (_id, _vec) as (_id, deviation decimal, whitened array<double>)."""
    m = fitted.moments
    live = fitted.live
    # sums of x - shift: n * x - S is the same, with smaller numbers
    raw = np.array([s - m.n * shift for s in m.sums], dtype=object)
    scaled = np.array([[float(c / np.sqrt(e)) if ok else 0.0 for c, e, ok in zip(row, fitted.eigenvalues, live)] for row in fitted.components])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                d = _deviations(whole_numbers(piece.column("_vec"), scale, len(m.sums)), m.n, raw)
                w = (d.astype(np.float64) / m.n) @ scaled
                yield pa.RecordBatch.from_arrays([
                    piece.column("_id"), pa.array([Decimal(int(q)) for q in (d * d).sum(axis=1)], pa.decimal128(38, 0)),
                    pa.array([[float(z) if ok else None for z, ok in zip(row, live)] for row in w], pa.list_(pa.float64()))],
                    names=["_id", "deviation", "whitened"])

    return vectors.select("_id", "_vec").mapInArrow(run, f"_id {dict(vectors.dtypes)['_id']}, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, n: int, components: list[int]) -> float | None:
    """The largest absolute entry of the covariance of ``rows.whitened`` minus the identity, over ``components`` (positions)."""
    if not components:
        return None
    w = lambda i: F.col("whitened")[i]
    means = rows.agg(*[(F.sum(w(i)) / n).alias(f"m{i}") for i in components]).first()
    pairs = [(i, j) for i in components for j in components if i <= j]
    got = rows.agg(*[(F.sum((w(i) - means[f"m{i}"]) * (w(j) - means[f"m{j}"])) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened_embeddings(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
                        scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per kept vector of ``df``: id, n, deviation, whitened (array), explained (array) and identity_error."""
    vectors = df.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_vec")).where(good_vector(F.col("_vec")))
    fitted = fit(vectors, components, scale, shift)
    if not fitted.components.size:
        empty = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
        return df.sparkSession.createDataFrame([], empty)
    rows = stored(whiten(vectors, fitted, scale, shift))
    error = identity_error(rows, fitted.moments.n, [int(i) for i in np.flatnonzero(fitted.live)])
    explained = [float(e / fitted.trace) if fitted.trace else None for e in fitted.eigenvalues]
    return rows.select(F.col("_id").alias("vec_id"), F.lit(fitted.moments.n).cast("long").alias("n"), "deviation", "whitened",
                       F.array(*[F.lit(e).cast("double") for e in explained]).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
