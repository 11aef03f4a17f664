"""Embedding whitening: components of the covariance by QDWH spectral divide-and-conquer, applied to every vector."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import table

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
# Entries whose scaled value has no exact integer in double precision count as not finite.
LARGEST = 2.0**52 / SCALE
EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray | None:
    """The orthogonal polar factor of a symmetric matrix by QDWH; None if the matrix is singular to working precision.

    Dynamically weighted Halley steps: by QR while the smallest singular value is small, then by Cholesky factors.
    """
    n = len(a)
    scale = np.linalg.norm(a)
    if not scale:
        return None
    x = a / scale
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        return None
    if not low > 8 * n * EPS:
        return None
    for _ in range(30):
        step = (4 * (1 - low**2) / low**4) ** (1 / 3) if low < 1 else 0.0
        root = np.sqrt(1 + step)
        h = root + np.sqrt(max(0.0, 8 - 4 * step + 8 * (2 - low**2) / (low**2 * root))) / 2
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        before = x
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))[0]
            x = b / c * x + (h - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        else:
            lower = np.linalg.cholesky(np.eye(n) + c * x.T @ x)
            x = b / c * x + (h - b / c) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        x = (x + x.T) / 2
        low = min(1.0, low * (h + b * low**2) / (1 + c * low**2))
        if np.linalg.norm(x - before) <= EPS ** (1 / 3) and abs(1 - low) < 10 * EPS:
            break
    return x


def spectral_split(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of ``a``: eigenvalues above a shift, and the others. None if all are equal.

    The polar factor U of ``a - shift`` gives the projector (U + I) / 2. The mean of the eigenvalues always has some on
    both sides; where it meets an eigenvalue, nearby shifts are taken.
    """
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    if spread <= 4 * EPS * max(np.linalg.norm(a), 1e-300):
        return None
    best = None
    for off in (0.0, 0.013, -0.017, 0.11, -0.13, 0.31, -0.37, 0.61, -0.67):
        u = polar(a - (mean + off * spread) * np.eye(n))
        if u is None:
            continue
        projector = (u + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        base = np.linalg.qr(projector @ rng.normal(size=(n, k)))[0]
        full = np.linalg.qr(projector @ base, mode="complete")[0]
        above, below = full[:, :k], full[:, k:]
        error = np.linalg.norm(below.T @ a @ above)
        if best is None or error < best[0]:
            best = error, above, below
        if error <= 50 * n * EPS * np.linalg.norm(a):
            break
    return best and best[1:]


def eigen(a: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix, by recursive spectral splits."""
    rng = np.random.default_rng(seed)
    values, vectors, stack = [], [], [np.eye(len(a))]
    while stack:
        basis = stack.pop()
        inner = basis.T @ a @ basis
        inner = (inner + inner.T) / 2
        parts = spectral_split(inner, rng) if len(inner) > 1 else None
        if parts is None:  # one vector, or a subspace in which every direction is an eigenvector
            values.extend(np.diag(inner))
            vectors.append(basis)
        else:
            stack += [basis @ parts[1], basis @ parts[0]]
    x = np.hstack(vectors) if vectors else np.zeros((0, 0))
    x = _polished(a, x)
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _polished(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One step of iterative refinement (Ogita and Aishima): rounding of the recursion is taken out of all vectors at once."""
    r = np.eye(len(x)) - x.T @ x
    s = x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(r))
    gap = values[None, :] - values[:, None]
    limit = 2 * (np.linalg.norm(s - np.diag(values)) + np.linalg.norm(a) * np.linalg.norm(r))
    apart = np.abs(gap) > limit
    step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1.0), r / 2)
    return np.linalg.qr(x + x @ step)[0] if len(x) else x


def as_longs(column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """For lists of doubles: which rows stay, and per length of list (rows, matrix of x = floor(64 * entry) + 1000000)."""
    n = len(column)
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(float)  # a null becomes NaN
    owner = np.repeat(np.arange(n), np.maximum(lengths, 0))
    good = lengths >= 0
    good[owner[~(np.abs(values) < LARGEST)]] = False
    starts = np.r_[0, np.cumsum(np.maximum(lengths, 0))]
    found = {}
    for size in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == size))
        matrix = values[starts[rows][:, None] + np.arange(size)]
        found[int(size)] = rows, np.floor(matrix * SCALE).astype(np.int64) + OFFSET
    return good, found


@dataclass(frozen=True)
class Space:
    """What is known of the vectors of one length: their number, sums and extremes, and the whitening components."""

    n: int
    sums: np.ndarray
    span: int
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    trace: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n with one rounding: the numerator is exact."""
        return self._numerator(x).astype(float) / self.n

    def _numerator(self, x: np.ndarray) -> np.ndarray:
        if self.n * (2 * self.span + abs(int(x.max(initial=0))) + abs(int(x.min(initial=0)))) < 1 << 62:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of (n * x - S) ** 2 of each row; None where it exceeds a long."""
        y = self._numerator(x)
        if y.dtype != object and len(self.sums) * (self.n * self.span) ** 2 < 1 << 62:
            return (y * y).sum(axis=1).tolist()
        sums = [sum(int(v) ** 2 for v in row) for row in y]
        return [s if s < 1 << 63 else None for s in sums]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def measure(vectors: DataFrame) -> dict[int, Space]:
    """Number, exact sums and span of the x-vectors of each length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for size, (rows, x) in as_longs(batch.column(0))[1].items():
                low, high = x.min(axis=0), x.max(axis=0)
                # sums stay exact: halves of 26 bits are added apart
                parts = (x >> 26).sum(axis=0).astype(object) * (1 << 26) + (x & ((1 << 26) - 1)).sum(axis=0).astype(object)
                t = totals.setdefault(size, [0, np.zeros(size, object), low, high])
                t[0], t[1], t[2], t[3] = t[0] + len(rows), t[1] + parts, np.minimum(t[2], low), np.maximum(t[3], high)
        for size, (n, sums, low, high) in totals.items():
            at = pa.array(np.arange(max(size, 1)), pa.int32())
            fill = size == 0
            columns = [[str(s) for s in sums] or ["0"], [0] if fill else low.tolist(), [0] if fill else high.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(at), pa.int32()), at, pa.array([n] * len(at), pa.int64()), pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["size", "at", "n", "s", "low", "high"],
            )

    parts = vectors.select("embedding").mapInArrow(work, "size int, at int, n long, s string, low long, high long")
    summed = parts.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
    spaces = {}
    # one row per dimension
    for size, rows in itertools.groupby(sorted(summed.collect()), key=lambda r: r["size"]):
        rows = list(rows)
        sums = np.array([int(r["s"]) for r in rows][:size], object)
        spaces[size] = Space(rows[0]["n"], sums, max(r["high"] - r["low"] for r in rows) + 1)
    return spaces


def scatter(vectors: DataFrame, spaces: dict[int, Space], white: bool = False) -> dict[int, np.ndarray]:
    """Covariance (divisor n) of the centred x-vectors of each length, or of their whitened ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for size, (_, x) in as_longs(batch.column(0))[1].items():
                y = spaces[size].whitened(x) if white else spaces[size].centred(x)
                t = totals.setdefault(size, [np.zeros(y.shape[1]), np.zeros((y.shape[1],) * 2)])
                t[0], t[1] = t[0] + y.sum(axis=0), t[1] + y.T @ y
        for size, (sums, products) in totals.items():
            d = len(sums)
            if d:
                rows = [pa.array(np.repeat(np.int32(size), d + 1)), pa.array(np.arange(-1, d), pa.int32()), pa.array([sums, *products], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(rows, names=["size", "i", "v"])

    parts = vectors.select("embedding").mapInArrow(work, "size int, i int, v array<double>")
    # sums of entries: one row per pair of dimensions
    entries = parts.select("size", "i", F.posexplode("v").alias("j", "v")).groupBy("size", "i", "j").agg(F.sum("v").alias("v"))
    joined = entries.groupBy("size", "i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("row"))
    found = {}
    for size, rows in itertools.groupby(sorted(joined.collect(), key=lambda r: (r["size"], r["i"])), key=lambda r: r["size"]):
        sums, *products = (np.array([e["v"] for e in r["row"]]) for r in rows)
        n = spaces[size].n
        v = np.array(products) / n - np.outer(sums / n, sums / n)
        found[size] = (v + v.T) / 2
    return found


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Space]:
    """The whitening components of each length of vector; those without variance to double precision are left out."""
    spaces = measure(vectors)
    for size, v in scatter(vectors, spaces).items():
        space = spaces[size]
        values, basis = eigen(v)
        rank = int((values > len(v) * EPS * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
        k = min(components, rank)
        spaces[size] = Space(space.n, space.sums, space.span, values[:k], basis[:, :k], float(np.trace(v)))
    return spaces


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row of ``vectors`` and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out, from the fit too; entries from 2**46 on
    have no exact x and count as not finite. Each entry becomes the long x = floor(64 * entry) + 1000000. One pass sums x,
    one centred products; both send one number per dimension, or pair of dimensions, from a task. The driver splits the
    covariance, and the components are broadcast to the tasks that project every vector. A third pass measures how far
    the whitened vectors' covariance is from the identity.

    Vectors of different lengths have no common space: each length is fitted by itself and ``n`` counts its vectors.
    Components without variance to double precision are not given, so a table of one vector or of equal vectors, or of
    empty ones, gives no rows, like an empty table. ``deviation`` is null beyond a long. Repeated rows and ids and null
    ids are whitened row by row; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    spaces = fitted(rows, components)
    spaces = {size: s for size, s in spaces.items() if s.values is not None and len(s.values)}
    kept = rows.where(F.size("embedding").isin(list(spaces))) if spaces else rows.where("false")
    errors = {size: float(np.abs(c - np.eye(len(c))).max()) for size, c in scatter(kept, spaces, white=True).items()}
    shared = vectors.sparkSession.sparkContext.broadcast((spaces, errors))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces, errors = shared.value
        for batch in batches:
            for size, (own, x) in as_longs(batch.column(1))[1].items():
                space = spaces[size]
                k = len(space.values)
                ids = batch.column(0).take(pa.array(np.repeat(own, k)))
                deviation = pa.array(space.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(own)), k)))
                each = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(own)), np.full(len(own) * k, space.n, np.int64)]
                last = [space.whitened(x).ravel(), np.tile(space.values / space.trace, len(own)), np.full(len(own) * k, errors[size])]
                yield pa.RecordBatch.from_arrays(
                    [ids, *map(pa.array, each), deviation, *map(pa.array, last)],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return kept.mapInArrow(work, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
