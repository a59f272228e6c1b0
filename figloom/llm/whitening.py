"""Embedding whitening by an incremental eigendecomposition.

Each partition of the different vectors keeps the spectrum of what it has read (count, mean, eigenvalues and eigenvectors of
the scatter): a vector is a centred rank-one update, whose eigenvalues are the roots of the secular equation between the
old ones; directions that the update hardly touches, and one of each two directions of equal eigenvalues, are deflated and
stay as they are. Two spectra are combined by as many rank-one updates as one has eigenvectors, and one for the distance of
the means; spectra meet in a tree, eight at a time. The eigenvectors so found span the space of a final Rayleigh-Ritz step: a
distributed pass sums up the covariance in their coordinates, exactly centred, and the small eigenproblem turns them. How far
that matrix is from diagonal (`drift`) tells how good the incremental spectrum was. A last pass measures the covariance of
the whitened vectors.

A vector's entries become whole numbers first (floor of 64 times the entry, plus a million), so counts, sums and deviations
are exact. Rows whose vector is null, of another length than most (the longer of equally frequent lengths), or holds null,
NaN or infinite entries, or such that don't fit into a long, are left out. Repeated rows are whitened each, but learned once;
components whose eigenvalue vanishes beside the largest aren't told (none for a single vector); equal eigenvalues give any
basis of their space, the same for all rows; a deviation beyond a long is null; an empty table gives an empty result; null
ids pass through; other columns are left out. A task holds a batch of vectors and a few matrices of the vectors' length
squared; the driver one of these.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figloom.functions.session import discard, materialise

SCALE, SHIFT = 64, 1_000_000
EPS = np.finfo(float).eps
#: So many spectra or sums meet in one task.
FAN_IN = 8


def secular_roots(d: np.ndarray, z: np.ndarray):
    """Eigenvalues of diag(d) + z z', for rising d that differ and z without zeros, and d_j - value_i to full precision.

    Each root lies between two poles; it is counted from the nearer one, and found by fitting a rational function on either
    side of it (the middle way), within a bracket that halves where a step leaves it."""
    m, z2 = len(d), z * z
    upper = np.append(d[1:], d[-1] + z2.sum())
    gap = upper - d
    last = np.arange(m) == m - 1
    below = (np.arange(m)[:, None] <= np.arange(m)[None, :]).astype(float)
    with np.errstate(all="ignore"):
        middle = 1 + (z2[:, None] / ((d[:, None] - d[None, :]) - gap / 2)).sum(0)
        left = (middle >= 0) | last
        delta = d[:, None] - d[np.where(left, np.arange(m), np.minimum(np.arange(m) + 1, m - 1))]
        lo = np.where(left, np.where(last & (middle < 0), gap / 2, 0.0), -gap / 2)
        hi = np.where(left, np.where(last & (middle < 0), gap, gap / 2), 0.0)
        t = (lo + hi) / 2
        ends = np.where(left, gap, 0.0)  # the upper pole, seen from the root's origin
        for step in range(80):
            den = delta - t
            r = z2[:, None] / den
            f = 1 + r.sum(0)
            size = 1 + np.abs(r).sum(0)
            lo, hi = np.where(f < 0, t, lo), np.where(f < 0, hi, t)
            if (np.abs(f) <= 2 * EPS * size).all():
                break
            r /= den
            slope, psi = r.sum(0), np.einsum("ij,ij->j", r, below)
            phi = slope - psi
            a0, a1 = np.diagonal(den), ends - t
            c = f - a0 * psi - a1 * phi
            a = (a0 + a1) * f - a0 * a1 * (psi + phi)
            b = a0 * a1 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            new = t + np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
            inside = (new > lo) & (new < hi)
            new = np.where(inside & (step % 8 != 7), new, (lo + hi) / 2)
            if (new == t).all() or (hi - lo <= EPS * np.maximum(np.abs(lo), np.abs(hi))).all():
                break
            t = np.where(np.abs(f) <= 2 * EPS * size, t, new)
    origin = np.where(left, d, np.append(d[1:], d[-1]))
    return origin + t, delta - t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray):
    """The eigendecomposition (values rising, vectors in columns) of vectors diag(values) vectors' + v v'."""
    z = vectors.T @ v
    size = z @ z
    if size == 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    limit = 8 * EPS * max(abs(values[-1]), abs(values[0]), size)
    keep = np.flatnonzero(np.abs(z) * np.sqrt(size) > limit)
    d = values[keep]
    if len(keep) > 1:
        zz = np.hypot(z[keep[1:]], z[keep[:-1]])
        if (np.abs(np.diff(d) * z[keep[1:]] * z[keep[:-1]]) <= limit * zz * zz).any():
            # Of two directions of equal values one takes the update, the other is left.
            held, before = [], keep[0]
            for i in keep[1:]:
                r = np.hypot(z[i], z[before])
                c, s = z[i] / r, z[before] / r
                if abs((values[i] - values[before]) * c * s) <= limit:
                    a, b = vectors[:, before].copy(), vectors[:, i].copy()
                    vectors[:, before], vectors[:, i] = c * a - s * b, s * a + c * b
                    values[before], values[i] = c * c * values[before] + s * s * values[i], s * s * values[before] + c * c * values[i]
                    z[before], z[i] = 0.0, r
                else:
                    held.append(before)
                before = i
            keep = np.array([*held, before])
            keep = keep[np.argsort(values[keep], kind="stable")]
            d = values[keep]
    if len(keep):
        zk, m = z[keep], len(keep)
        roots, den = secular_roots(d, zk)
        # The update that has exactly these roots, so that the vectors are orthogonal.
        poles = d[:, None]
        below = np.arange(m)[None, :] < np.arange(m)[:, None]
        others = np.where(below, d[None, :] - poles, np.append(d[1:], d[-1] + 1)[None, :] - poles)
        others[:, m - 1] = 1.0
        true = np.sqrt(np.abs(np.prod(-den / others, axis=1))) * np.sign(zk)
        turn = true[:, None] / den
        turn /= np.sqrt((turn * turn).sum(0))
        values[keep], vectors[:, keep] = roots, vectors[:, keep] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean, eigenvalues and eigenvectors of the scatter of the vectors seen, and their exact sum (x less SHIFT,
    Python's integers)."""

    def __init__(self, n: int, total: np.ndarray, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.total, self.mean, self.values, self.vectors = n, total, mean, values, vectors

    @classmethod
    def empty(cls, d: int) -> "Spectrum":
        return cls(0, np.zeros(d, object), np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.total = self.total + x.astype(object)
        self.mean = self.mean + off / self.n

    def absorb(self, other: "Spectrum") -> None:
        if not other.n or not self.n:
            if other.n:
                self.__dict__.update(other.__dict__)
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector * np.sqrt(value))
        n, off = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off * np.sqrt(self.n * other.n / n))
        self.mean, self.total, self.n = self.mean + off * (other.n / n), self.total + other.total, n

    def row(self) -> tuple[bytes, ...]:
        whole = " ".join(map(str, self.total)).encode()
        return (str(self.n).encode(), whole, *(np.ascontiguousarray(a).tobytes() for a in (self.mean, self.values, self.vectors)))

    @classmethod
    def of(cls, row) -> "Spectrum":
        n, total, mean, values, vectors = row
        d = len(mean) // 8
        return cls(int(n), np.array([int(t) for t in total.split()], object), np.frombuffer(mean), np.frombuffer(values), np.frombuffer(vectors).reshape(d, d))


def _vectors(batch, column: int, d: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _gathered(parts: DataFrame, names: list[str], join) -> list[bytes]:
    """Rows (_part, names: binary) joined in a tree by join(rows), eight at a time, until one is left."""
    schema = "_part long, " + ", ".join(f"{c} binary" for c in names)

    def together(key, rows):
        import pandas as pd

        one = join([tuple(r) for r in rows.sort_values("_part")[names].itertuples(index=False)])
        return pd.DataFrame([(int(key[0]), *one)], columns=["_part", *names])

    most = parts.agg(F.max("_part")).first()[0]
    while most > 0:
        parts = parts.groupBy(F.floor(F.col("_part") / FAN_IN).alias("_group")).applyInPandas(together, schema)
        most //= FAN_IN
    return [bytes(x) for x in parts.select(*names).first()]


def _summed(rows):
    return tuple(functools.reduce(np.add, [np.frombuffer(r[k]) for r in rows]).tobytes() for k in range(len(rows[0])))


def _each(fit: DataFrame, d: int, names: list[str], start, add, end) -> DataFrame:
    """One row (_part, names) of each partition of fit: start(), add(state, vectors), end(state) to bytes."""

    def run(batches):
        from pyspark import TaskContext

        state, seen = start(), False
        for batch in batches:
            if batch.num_rows:
                state, seen = add(state, _vectors(batch, 0, d)), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), *(pa.array([x], pa.binary()) for x in end(state))], ["_part", *names])

    return fit.select("x").mapInArrow(run, "_part long, " + ", ".join(f"{c} binary" for c in names))


def spectrum(fit: DataFrame, d: int) -> Spectrum:
    """The spectrum of the vectors x (array<long>, of length d) of fit, by the incremental method alone."""
    names = ["n", "total", "mean", "lengths", "vectors"]

    def add(state, vectors):
        for x in vectors - SHIFT:
            state.add(x)
        return state

    def join(rows):
        first, *more = [Spectrum.of(r) for r in rows]
        for other in more:
            first.absorb(other)
        return first.row()

    parts = materialise(_each(fit, d, names, lambda: Spectrum.empty(d), add, Spectrum.row))
    found = Spectrum.of(_gathered(parts, names, join))
    discard(parts)
    return found


def _deviations(vectors: np.ndarray, n: int, total: np.ndarray):
    """n x - S for x less SHIFT, exact; as Python's integers where they may not fit into 64 bits."""
    largest = max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0))))
    if n * largest + max((abs(int(t)) for t in total), default=0) < 2**63:
        return vectors * n - np.array(total, np.int64)
    return vectors.astype(object) * n - np.array(total, object)


def _squares(off: np.ndarray):
    if off.dtype != object and (off.astype(float) ** 2).sum(1).max(initial=0) < 2.0**62:
        return pa.array((off * off).sum(1), pa.int64())
    return pa.array([v if (v := sum(int(x) ** 2 for x in row)) < 2**63 else None for row in off], pa.int64())


def whiten(rows: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error, drift: for each row and component."""
    id_type = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double, drift double"
    entry = lambda c: c.cast("double")
    most = float(2**62) / SCALE
    fine = rows.where(F.col(vector_col).isNotNull() & ~F.exists(vector_col, lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) >= most)))
    sizes = fine.groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = rows.sparkSession.createDataFrame([], schema)
    if sizes is None or not sizes["d"]:
        return empty
    d = sizes["d"]
    whole = fine.where(F.size(vector_col) == d).select(F.col(id_col), F.transform(vector_col, lambda c: F.floor(entry(c) * SCALE) + SHIFT).alias("x"))
    fit = materialise(whole.select("x").distinct())
    found = spectrum(fit, d)
    n, total = found.n, found.total
    basis, _ = np.linalg.qr(found.vectors)

    def projected(onto):
        return lambda state, vectors: (lambda y: state + np.concatenate([(y.T @ y).ravel(), y.sum(0)]))((_deviations(vectors - SHIFT, n, total).astype(float) / n) @ onto)

    def second_moments(onto):
        k = onto.shape[1]
        parts = materialise(_each(fit, d, ["sums"], lambda: np.zeros(k * k + k), projected(onto), lambda s: (s.tobytes(),)))
        sums = np.frombuffer(_gathered(parts, ["sums"], _summed)[0]) / n
        discard(parts)
        return sums[: k * k].reshape(k, k) - np.outer(sums[k * k :], sums[k * k :])

    ritz = second_moments(basis)
    trace = float(np.trace(ritz))
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    k = int((values[:components] > max(values[0], 0) * EPS * d).sum()) if trace > 0 else 0
    if not k:
        discard(fit)
        return empty
    onto = (basis @ turn[:, :k]) / np.sqrt(values[:k])
    error = float(np.abs(second_moments(onto) - np.eye(k)).max())
    discard(fit)
    drift = float(np.abs(ritz - np.diag(np.diag(ritz))).max() / trace)
    explained = values[:k] / trace

    def run(batches):
        for batch in batches:
            vectors = _vectors(batch, 1, d) - SHIFT
            off = _deviations(vectors, n, total)
            white = (off.astype(float) / n) @ onto
            again, size = np.repeat(np.arange(len(vectors)), k), len(vectors) * k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(vectors))), pa.array(np.full(size, n)), _squares(off).take(pa.array(again)), pa.array(white.ravel()), pa.array(np.tile(explained, len(vectors))), pa.array(np.full(size, error)), pa.array(np.full(size, drift))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "drift"],
            )

    return whole.mapInArrow(run, schema)
