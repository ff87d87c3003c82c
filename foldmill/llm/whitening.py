"""Whitened embeddings from an incremental eigendecomposition.

The fit list is every distinct vector once. Each task reads its share of it row by row and keeps the eigenvalues and eigenvectors of the scatter
around its own running mean: a row adds one centred rank-one term, and the new eigenvalues are the roots of the secular equation
1 + sum z_i^2 / (d_i - t) = 0, found between the old ones after deflation (equal old values are rotated so that one carries the whole group, and
parts too small to matter stay). The eigenvectors follow from the roots by Loewner's formula, which keeps them orthogonal. The
tasks' spectra are put together in two levels: the terms of one are added to the other as rank-one updates, and one more joins their means.

Each row costs a product of matrices of the vectors' length. The result is a basis near the true one. A last distributed pass refines it (Rayleigh-Ritz):
rows are written in that basis around the exact mean, the small matrix of their products is summed over the tasks and solved, which gives
the eigenvectors to double precision. Another pass measures the covariance of the whitened fit list.

The driver holds matrices of the vectors' length squared. Sums of the integer vectors are exact.

Rows whose vector is null or holds null or non-finite components are dropped; shorter vectors are filled up with zeros. Repeated rows and vec_ids get their own
rows but count once in the fit list; a null vec_id is kept. Components without variance (of one vector, or beyond the rank) have no whitened
value and give no rows; an empty table gives none. Equal eigenvalues leave the choice within their plane open; it is the same for all rows. Columns other
than vec_id and embedding are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmill.llm.common import discard, partitions, ready, stored
from foldmill.llm.integer_vectors import integer_vectors, matrix_of

COMPONENTS = 4
EPSILON = np.finfo(np.float64).eps
MOST_STEPS = 60
#: Steps of the roots end below this relative change; the next one would be its square, and the vectors are orthogonal for any roots between the poles.
ACCURACY = 1e-8
SPECTRUM = "shard long, n long, sums array<long>, eigenvalues array<double>, eigenvectors array<double>"


def roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots t of 1 + sum z_i^2 / (d_i - t) for distinct ascending ``d`` and non-zero ``z``, each as the distance to its nearest pole, and
    those distances to all poles: ``t_i - d_j``. All roots are sought at once, by a rational approximation inside a bracket."""
    m, squares = len(d), z * z
    total = squares.sum()
    half = (np.append(d[1:], d[-1] + total) - d) / 2
    from_own = d[None, :] - d[:, None]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        left = 1 + (squares / (from_own - half[:, None])).sum(axis=1) >= 0
        origin = np.arange(m) + ~left
        origin[-1] = m - 1
        poles = d[None, :] - d[origin][:, None]
        low, high = np.where(left, 0.0, -half), np.where(left, half, 0.0)
        if not left[-1]:
            low[-1], high[-1] = half[-1], 2 * half[-1]
        before, rows = np.tri(m), np.arange(m)
        p, q = poles[rows, rows], poles[rows, np.minimum(rows + 1, m - 1)]
        inner = rows < m - 1
        upper = np.where(inner, q, np.inf)

        def crossing(a, b, c):
            """Where c + a / (p - x) + b / (q - x) is zero between its poles, kept within the bracket; the last root has no pole above it."""
            middle, last = c * (p + q) + a + b, c * p * q + a * q + b * p
            side = (middle + np.copysign(np.sqrt(np.maximum(middle**2 - 4 * c * last, 0)), middle)) / 2
            first, second = side / c, last / side
            first[-1] = second[-1] = p[-1] + a[-1] / c[-1]
            between = lambda x: (x > p) & (x < upper)
            found = np.where(between(first), first, np.where(between(second), second, (low + high) / 2))
            return np.clip(found, low, high)

        # first with the two nearest poles as they are and the others as seen from the middle
        t = (low + high) / 2
        a, b = squares, np.where(inner, np.append(squares[1:], 0), 0)
        gap = poles - t[:, None]
        c = 1 + (squares / gap).sum(axis=1) - a / (p - t) - np.where(inner, b / (q - t), 0)
        t = crossing(a, b, c)
        for _ in range(MOST_STEPS):
            np.subtract(poles, t[:, None], out=gap)
            terms = squares / gap
            value = 1 + terms.sum(axis=1)
            high, low = np.where(value >= 0, t, high), np.where(value < 0, t, low)
            terms /= gap
            a = np.einsum("ij,ij->i", terms, before)
            b = (terms.sum(axis=1) - a) * (q - t) ** 2
            a *= (p - t) ** 2
            c = value - a / (p - t) - np.where(inner, b / (q - t), 0)
            moved = crossing(a, b, c)
            done = (np.abs(moved - t) <= ACCURACY * np.abs(moved)) | (value == 0)
            t = np.where(value == 0, t, moved)
            if done.all():
                break
    return d[origin] + t, t[:, None] - poles


def updated(d: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``vectors diag(d) vectors' + v v'``."""
    z = v @ vectors
    size = z @ z
    if size == 0:
        return d, vectors
    small = 8 * EPSILON * max(abs(d[-1]), size)
    vectors = vectors.copy()
    starts = np.flatnonzero(np.append(True, np.diff(d) > small))
    if len(starts) < len(d):
        for a, b in zip(starts, np.append(starts[1:], len(d))):
            if b - a > 1:  # a reflection that leaves the whole of z in the group's first direction
                norm = np.linalg.norm(z[a:b])
                if norm > 0:
                    mirror = z[a:b].copy()
                    mirror[0] += np.copysign(norm, mirror[0])
                    mirror /= np.linalg.norm(mirror)
                    vectors[:, a:b] -= 2 * np.outer(vectors[:, a:b] @ mirror, mirror)
                    z[a], z[a + 1 : b] = -np.copysign(norm, z[a]), 0.0
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) > small)
    if not len(live):
        return d, vectors
    old, part = d[live], z[live]
    new, away = roots(old, part)
    apart = old[:, None] - old[None, :]
    np.fill_diagonal(apart, 1.0)
    part = np.copysign(np.sqrt(np.abs((away / apart).prod(axis=0))), part)
    turned = (part / -away).T
    turned /= np.linalg.norm(turned, axis=0)
    d = d.copy()
    d[live], vectors[:, live] = new, vectors[:, live] @ turned
    order = np.argsort(d, kind="stable")
    return d[order], vectors[:, order]


class Spectrum:
    """Rows seen, their exact sums, and the eigenvalues and eigenvectors of their scatter."""

    def __init__(self, length: int):
        self.n, self.sums = 0, np.zeros(length, np.int64)
        self.values, self.vectors = np.zeros(length), np.eye(length)

    def add(self, x: np.ndarray) -> None:
        if self.n:
            centred = (x - self.sums / self.n) * np.sqrt(self.n / (self.n + 1))
            self.values, self.vectors = updated(self.values, self.vectors, centred)
        self.n, self.sums = self.n + 1, self.sums + x

    def merge(self, other: Spectrum) -> None:
        if self.n and other.n:
            for value, vector in zip(other.values, other.vectors.T):
                if value > 0:
                    self.values, self.vectors = updated(self.values, self.vectors, np.sqrt(value) * vector)
            between = (other.sums / other.n - self.sums / self.n) * np.sqrt(self.n * other.n / (self.n + other.n))
            self.values, self.vectors = updated(self.values, self.vectors, between)
        elif other.n:
            self.values, self.vectors = other.values, other.vectors
        self.n, self.sums = self.n + other.n, self.sums + other.sums

    def row(self, shard: int) -> list:
        return [shard, self.n, self.sums.tolist(), self.values.tolist(), self.vectors.ravel().tolist()]

    @classmethod
    def read(cls, n, sums, values, vectors) -> Spectrum:
        out = cls(len(sums))
        out.n, out.sums, out.values = int(n), np.array(sums, np.int64), np.array(values, np.float64)
        out.vectors = np.array(vectors, np.float64).reshape(len(out.values), -1)
        return out


def spectrum_of(fit: DataFrame, length: int) -> Spectrum:
    """The spectrum of all rows (column x): one of each task, put together in two levels."""
    names = [c.split()[0] for c in SPECTRUM.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        own = Spectrum(length)
        for batch in batches:
            for x in matrix_of(batch.column(0), length):
                own.add(x)
        if own.n:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.list_(pa.int64()) if n == "sums" else pa.list_(pa.float64()) if isinstance(v, list) else pa.int64()) for n, v in zip(names, own.row(TaskContext.get().partitionId()))], names=names)

    def together(key, pdf):
        whole = Spectrum(length)
        for r in pdf.sort_values("shard").itertuples(index=False):
            whole.merge(Spectrum.read(r.n, r.sums, r.eigenvalues, r.eigenvectors))
        return pd.DataFrame([whole.row(int(key[0]))], columns=names)

    parts = stored(fit.select("x").mapInArrow(run, SPECTRUM), "spectra")
    fan = max(1, int(parts.count() ** 0.5))
    once = parts.withColumn("shard", F.col("shard") % fan).groupBy("shard").applyInPandas(together, SPECTRUM) if fan > 1 else parts
    [row] = once.groupBy(F.lit(0).cast("long").alias("all")).applyInPandas(together, SPECTRUM).collect()
    discard(parts)
    return Spectrum.read(row["n"], row["sums"], row["eigenvalues"], row["eigenvectors"])


def summed(rows: DataFrame, width: int, run) -> np.ndarray:
    """``run`` gives each task's vector of ``width`` sums; their total, added up in two levels."""

    def work(batches):
        from pyspark import TaskContext

        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([run(batches)], pa.list_(pa.float64()))], names=["shard", "v"])

    fan = max(1, int(partitions(rows.sparkSession) ** 0.5))
    parts = rows.mapInArrow(work, "shard long, v array<double>").select((F.col("shard") % fan).alias("g"), array_to_vector("v").alias("v"))
    total = parts.groupBy("g").agg(Summarizer.sum(F.col("v")).alias("v")).agg(Summarizer.sum(F.col("v")).alias("v")).first()
    return total["v"].toArray() if total and total["v"] is not None else np.zeros(width)


class Whitening:
    """The fitted components: ``n``, exact ``sums``, unit ``axes`` (columns), eigenvalues ``e``, ``trace``, ``identity_error``."""

    def __init__(self, fit: DataFrame, length: int, most: int = COMPONENTS):
        rough = spectrum_of(fit, length)
        self.n, self.sums = rough.n, rough.sums
        mean, (basis, _) = rough.sums / rough.n, np.linalg.qr(rough.vectors)

        def products(batches):
            out = np.zeros((length, length))
            for batch in batches:
                y = (matrix_of(batch.column(0), length) - mean) @ basis
                out += y.T @ y
            return out.ravel()

        small = summed(fit.select("x"), length * length, products).reshape(length, length) / self.n
        values, turned = np.linalg.eigh((small + small.T) / 2)
        top = np.argsort(values)[::-1][:most]
        top = top[values[top] > 4 * length * EPSILON * max(values.max(initial=0.0), 0.0)]
        axes = basis @ turned[:, top]
        axes /= np.linalg.norm(axes, axis=0)
        self.axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(top))]) if len(top) else axes
        self.e, self.trace, self.mean = values[top], float(np.trace(small)), mean
        self.identity_error = self._identity_error(fit, length)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.axes / np.sqrt(self.e)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """sum (n * x - S)^2, exact; what does not fit 64 bits becomes the largest number that does."""
        most = 2 * self.n * int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0))
        if most * most * x.shape[1] < 2**62:
            return ((self.n * x - self.sums) ** 2).sum(axis=1)
        sums = [int(s) for s in self.sums]
        return np.array([min(sum((self.n * int(c) - s) ** 2 for c, s in zip(row, sums)), 2**63 - 1) for row in x], np.int64)

    def _identity_error(self, fit: DataFrame, length: int) -> float:
        k = len(self.e)

        def run(batches):
            first, second = np.zeros(k), np.zeros((k, k))
            for batch in batches:
                w = self.whitened(matrix_of(batch.column(0), length))
                first += w.sum(axis=0)
                second += w.T @ w
            return np.concatenate([first, second.ravel()])

        if not k:
            return 0.0
        total = summed(fit.select("x"), k + k * k, run) / self.n
        covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])  # the means are zero but for rounding
        return float(np.abs(covariance - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def report(vectors: DataFrame) -> DataFrame:
    """A row for each vector that takes part and component up to ``COMPONENTS``."""
    spark = ready(vectors.sparkSession)
    rows, length = integer_vectors(vectors)
    fit = stored(rows.groupBy("x").agg(F.count("*").alias("copies")).select("x"), "fit")
    if not length or fit.isEmpty():
        return spark.createDataFrame([], SCHEMA)
    model = Whitening(fit, length)
    k = len(model.e)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            x = matrix_of(batch.column(1), length)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(model.deviation(x)[each]), pa.array(model.whitened(x).ravel()), pa.array(np.tile(model.e / model.trace, m) if k else np.zeros(0)),
                    pa.array(np.full(m * k, model.identity_error)),
                ],
                names=names,
            )

    return rows.select("vec_id", "x").mapInArrow(run, SCHEMA)
