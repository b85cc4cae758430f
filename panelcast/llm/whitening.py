"""Embedding whitening: incremental eigendecomposition of the covariance, refined by Rayleigh-Ritz.

Vectors are put on a grid of whole numbers, so that sums and deviations are
exact. Each task goes through its vectors by centred rank-one updates of an
eigendecomposition; the spectra of tasks are combined by further rank-one
updates; a last pass over all vectors projects the covariance on the basis
found and solves that small problem.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from panelcast.llm.shared import tidy
from panelcast.session import discard, stored

#: Vectors that one task goes through, about.
TASK_ROWS = 2048
#: Spectra, or partial sums, that one task combines.
FAN = 16
EPS = float(np.finfo(float).eps)


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z', and the matrix of d_j - eigenvalue_i, accurate in every entry.

    ``d`` ascends strictly and no z is 0, so root i lies between d_i and the
    next pole (the last one within |z|^2). Each root is sought as a distance
    from the nearer pole by the rational iteration that matches both poles,
    with bisection where it leaves its bracket; all roots go together.
    """
    k, weight = len(d), z * z
    total = float(weight.sum())
    poles = np.append(d, d[-1] + 2 * total)
    gap = np.diff(poles)
    middle = d + gap / 2
    f_middle = 1 + (weight / (d - middle[:, None])).sum(axis=1)
    right = f_middle < 0  # the root is in the second half
    right[-1] = False
    origin = np.arange(k) + right
    shifted = d - poles[origin][:, None]  # row i: d_j minus the origin of root i
    near, far = poles[:-1] - poles[origin], poles[1:] - poles[origin]
    low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
    low[-1], high[-1] = (total * (1 - 4 * EPS), total * (1 + 4 * EPS)) if k == 1 else (0.0, total * (1 + 4 * EPS))
    tau, left_of = (low + high) / 2, np.tril(np.ones((k, k), bool))
    for _ in range(60):
        terms = weight / (shifted - tau[:, None])
        slopes = terms / (shifted - tau[:, None])
        f, size = 1 + terms.sum(axis=1), 1 + np.abs(terms).sum(axis=1)
        done = np.abs(f) <= 4 * EPS * size * np.sqrt(k)
        if done.all():
            break
        low, high = np.where(f < 0, tau, low), np.where(f > 0, tau, high)
        d1, d2 = near - tau, far - tau
        psi, slope = np.where(left_of, slopes, 0.0).sum(axis=1), slopes.sum(axis=1)
        a = (d1 + d2) * f - d1 * d2 * slope
        b, c = d1 * d2 * f, f - d1 * psi - d2 * (slope - psi)
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = tau + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        new = np.where(inside, new, (low + high) / 2)
        new = np.where(done, tau, new)
        if (new == tau).all():
            break
        tau = new
    return poles[origin] + tau, shifted - tau[:, None]


def rank_one(d: np.ndarray, basis: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and orthonormal vectors (columns) of basis diag(d) basis' + v v'.

    Deflation first: directions that v does not touch stay as they are, and in
    a group of equal eigenvalues a reflection leaves v one direction. The
    vectors come from weights recomputed from the roots, which keeps them
    orthogonal however close the roots are.
    """
    z = basis.T @ v
    size = float(z @ z)
    if not size:
        return d, basis
    small = 8 * EPS * max(float(d[-1]), size)
    edges = np.flatnonzero(np.diff(d) > small) + 1
    if len(edges) < len(d) - 1:
        basis = basis.copy()
        for group in np.split(np.arange(len(d)), edges):
            part = z[group]
            length = np.sqrt(part @ part)
            if len(group) < 2 or not length:
                continue
            mirror = part.copy()
            mirror[-1] += np.copysign(length, part[-1])
            mirror /= np.sqrt(mirror @ mirror)
            basis[:, group] -= 2 * np.outer(basis[:, group] @ mirror, mirror)
            z[group] = 0
            z[group[-1]] = -np.copysign(length, part[-1])
    touched = np.flatnonzero(np.abs(z) * np.sqrt(size) > small)
    if not len(touched):
        return d, basis
    # of a group of equal eigenvalues one at most is touched, so these ascend strictly
    poles, weights = d[touched], z[touched]
    values, apart = secular_roots(poles, weights)  # apart[i, j] = poles_j - root_i
    # |weight_j|^2 = prod_i (root_i - pole_j) / prod_{i != j} (pole_i - pole_j)
    between = poles[:, None] - poles
    np.fill_diagonal(between, 1.0)
    ratio = np.abs(apart) / np.abs(between)
    exact = np.copysign(np.sqrt(np.exp(np.log(ratio).sum(axis=0))), weights)
    turn = exact / apart
    turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
    out, vectors = d.copy(), basis.copy()
    out[touched], vectors[:, touched] = values, basis[:, touched] @ turn.T
    order = np.argsort(out, kind="stable")
    return out[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number and exact sums of some vectors, and the eigendecomposition of their scatter about the mean."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def none(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size, np.int64), np.zeros(size), np.eye(size))

    def add(self, x: np.ndarray) -> None:
        """One more vector: an update by its distance from the mean so far."""
        if self.n:
            away = centred(x, self.n, self.sums) * np.sqrt(self.n / (self.n + 1))
            self.values, self.basis = rank_one(self.values, self.basis, away)
        self.n, self.sums = self.n + 1, self.sums + x

    def join(self, other: Spectrum) -> Spectrum:
        """The spectrum of both together: an update for each of the other's directions and one for the means."""
        if not self.n or not other.n:
            return other if not self.n else self
        values, basis = self.values, self.basis
        for value, vector in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                values, basis = rank_one(values, basis, np.sqrt(value) * vector)
        away = centred(other.sums, self.n * other.n, self.sums * other.n, self.n) * np.sqrt(self.n * other.n / (self.n + other.n))
        values, basis = rank_one(values, basis, away)
        return Spectrum(self.n + other.n, self.sums + other.sums, values, basis)

    def dump(self) -> bytes:
        return np.int64(self.n).tobytes() + self.sums.tobytes() + self.values.tobytes() + np.ascontiguousarray(self.basis).tobytes()

    @classmethod
    def load(cls, data: bytes, size: int) -> Spectrum:
        n, sums = int(np.frombuffer(data, np.int64, 1)[0]), np.frombuffer(data, np.int64, size, 8)
        values = np.frombuffer(data, float, size, 8 + 8 * size)
        return cls(n, sums, values, np.frombuffer(data, float, size * size, 8 + 16 * size).reshape(size, size))


def centred(x: np.ndarray, n: int, sums: np.ndarray, times: int | None = None) -> np.ndarray:
    """(times x - sums) / n, the numerator in whole numbers; ``times`` is n if not given."""
    return deviations(x, n if times is None else times, sums).astype(float) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - sums in whole numbers."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < 1 << 62 and int(np.abs(sums).max(initial=0)) < 1 << 62:
        return x * n - sums
    return x.astype(object) * n - sums.astype(object)


def square_sums(deviation: np.ndarray) -> np.ndarray:
    """Exact sum of squares of each row; one that passes 64 bits raises OverflowError."""
    most = int(np.abs(deviation).max(initial=0))
    if most * most * max(1, deviation.shape[1]) < 1 << 63:
        wide = deviation.astype(np.int64)
        return (wide * wide).sum(axis=1)
    return np.array([sum(int(v) ** 2 for v in row) for row in deviation], object).astype(np.int64)


def on_grid(vectors: DataFrame, column: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Rows with ``x``: floor(scale * entry) + shift of each entry; rows whose vector is null or holds null or non-finite entries go."""
    entry = lambda c: c.cast("double")
    fine = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < float("inf")))
    return vectors.where(F.col(column).isNotNull() & fine).withColumn("x", F.transform(column, lambda c: F.floor(entry(c) * scale) + F.lit(shift).cast("long")))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)


def _per_task(fit: DataFrame, size: int, work: Callable[[Iterator[np.ndarray]], bytes]) -> DataFrame:
    """(task, data): what ``work`` makes of the vectors of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = work(_matrix(b, size) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_pydict({"task": pa.array([TaskContext.get().partitionId()], pa.int64()), "data": pa.array([made], pa.binary())})

    return stored(fit.mapInArrow(tidy(run), "task long, data binary"), "parts")


def combined(parts: DataFrame, join: Callable[[bytes, bytes], bytes]) -> bytes | None:
    """All (task, data) of a stored table, deleted after use, joined FAN at a time in tasks, in rounds; None without parts."""
    tasks = parts.agg(F.max("task")).first()[0]
    while tasks is not None and tasks > 0:

        def merge(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("task")
            return pd.DataFrame({"task": [int(rows["task"].iloc[0]) // FAN], "data": [reduce(join, rows["data"])]})

        fewer = stored(parts.groupBy(F.expr(f"task div {FAN}")).applyInPandas(merge, "task long, data binary"), "parts")
        discard(parts)
        parts, tasks = fewer, tasks // FAN
    last = None if tasks is None else bytes(parts.first()["data"])
    discard(parts)
    return last


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: unit components (columns) by falling eigenvalue, of the vectors on the grid."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.components / np.sqrt(self.values)


def fit_whitening(fit: DataFrame, components: int = 16) -> Whitening | None:
    """The whitening of the vectors ``x`` of ``fit``, each row counting once; None without rows.

    Components without variance (1e-12 of the largest or less) are left out.
    What the driver sees are sums and a square matrix of the vectors' size.
    """
    first = fit.select(F.size("x").alias("size")).first()
    if first is None or first["size"] == 0:
        return None
    size = first["size"]
    dealt = stored(fit.select("x").repartition(max(1, -(-fit.count() // TASK_ROWS))), "fit")

    def spectrum(parts: Iterator[np.ndarray]) -> bytes:
        found = Spectrum.none(size)
        for part in parts:
            for x in part:
                found.add(x)
        return found.dump()

    load = lambda data: Spectrum.load(data, size)
    whole = load(combined(_per_task(dealt, size, spectrum), lambda a, b: load(a).join(load(b)).dump()))
    n, sums, basis = whole.n, whole.sums, np.linalg.qr(whole.basis)[0]
    add = lambda a, b: (np.frombuffer(a) + np.frombuffer(b)).tobytes()

    def gram(project: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        """The covariance of the projected vectors, by one pass."""

        def work(parts: Iterator[np.ndarray]) -> bytes:
            out = np.zeros((width, width))
            for part in parts:
                y = project(part)
                out += y.T @ y
            return out.tobytes()

        return np.frombuffer(combined(_per_task(dealt, size, work), add)).reshape(width, width) / n

    ritz = gram(lambda x: centred(x, n, sums) @ basis, size)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    kept = [k for k in range(min(components, size)) if values[k] > max(1e-12 * values[0], 0)]
    model = Whitening(n, sums, values[kept], vectors[:, kept], float(np.trace(ritz)))
    if not kept:
        discard(dealt)
        return model
    error = float(np.abs(gram(model.project, len(kept)) - np.eye(len(kept))).max())
    discard(dealt)
    return Whitening(n, sums, model.values, model.components, model.trace, error)


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Whitened coordinates of every vector: ``key``, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries are dropped, and
    so are those of another length than most have (of lengths as frequent, the
    longest stays). The others are put on the grid (``on_grid``); the model is fitted on
    each distinct grid vector once. A row for each remaining row, repeated and
    null keys too, and component; vectors without variance, and empty ones,
    have no component. An entry beyond the grid's 64 bits raises. Other
    columns are not read.
    """
    rows = on_grid(vectors.select(F.col(key), F.col(column)), column, scale, shift).select(key, "x")
    common = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    rows = rows.where(F.size("x") == size)
    model = fit_whitening(stored(rows.select("x").distinct(), "distinct"), components)
    kind = vectors.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error"))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.values) if model else 0
        for batch in batches:
            if not width or not batch.num_rows:
                continue
            x = _matrix(batch, size)
            which, count = np.repeat(np.arange(len(x)), width), len(x)
            columns = [
                np.tile(np.arange(1, width + 1, dtype=np.int32), count), np.full(count * width, model.n), square_sums(deviations(x, model.n, model.sums))[which],
                model.project(x).ravel(), np.tile(model.values / model.trace, count), np.full(count * width, model.identity_error),
            ]
            yield pa.RecordBatch.from_arrays([batch[key].take(pa.array(which)), *map(pa.array, columns)], names=schema.names)

    return rows.mapInArrow(tidy(project), schema)
