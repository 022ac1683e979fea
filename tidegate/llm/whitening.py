"""Embedding whitening by a distributed Jacobi-Davidson eigensolver.

Vectors are made whole numbers, ``floor(64 c) + 1,000,000``, so that sums, means and deviations are exact.  The leading
eigenvectors of their covariance are found without ever forming it: every product of the covariance with a block of
vectors is one pass over the distinct vectors, which centres each of them first: with ``S = q n + r``, ``(x - q) - r / n``.
The solver keeps a search space, takes the best approximations in it (Rayleigh-Ritz), and widens it by approximate
solutions of the projected correction equations

    (I - Q Q') (V - e I) (I - Q Q') t = -r,   t orthogonal to Q,

one for each of them, found by a few MINRES steps.  The equations of a round share their passes.  Pairs whose residual has
reached double precision are locked.  The driver holds vectors, never rows: what it sees depends on the number of
dimensions only.

Left out are rows whose vector is null or holds null, NaN or infinite entries or such whose whole number is beyond a long (from
5e16 on), and rows whose vector has another number of entries than most (of equally frequent numbers the larger counts).  Equal vectors count once in the
covariance; each row gets its own result, whatever its id.  Components whose variance is zero up to rounding do not exist, so an empty table, one vector or
equal vectors give no components.  ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidegate.llm.common import renewed, stored

#: Scale and offset of the whole numbers.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Correction equations solved together, and MINRES steps for each.
BLOCK, STEPS = 16, 4
#: Search vectors beyond which it is cut back to the best approximations.
MOST_SEARCH = 96
MOST_ROUNDS = 200
#: Rounds after which the images of the search vectors, which are turned along with them, are computed anew.
REFRESH = 10
#: Largest entry.
MOST = 5e16


def whole_numbers(embedding: Column) -> Column:
    return F.transform(embedding, lambda c: (F.floor(c.cast("double") * SCALE) + OFFSET).cast("long"))


def _usable(embedding: Column) -> Column:
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) >= MOST)
    return embedding.isNotNull() & ~F.coalesce(F.exists(embedding, bad), F.lit(True))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


class Centre:
    """The mean of ``n`` vectors of whole numbers: ``whole + rest / n`` in each dimension."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def shifted(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of ``(n x - S)^2``, exact; null beyond a long."""
        far = x - self.whole
        # within a long if the largest term, times their number, is; else by whole numbers of any size
        if (np.abs(far.astype(float)).max() * self.n + self.n) ** 2 * x.shape[1] < 2**62:
            return pa.array(((far * self.n - self.rest) ** 2).sum(axis=1))
        exact = [sum((f * self.n - r) ** 2 for f, r in zip(row, self.rest.tolist())) for row in far.tolist()]
        return pa.array([d if d < 2**63 else None for d in exact], pa.int64())


class Covariance:
    """Products with the covariance of the distinct vectors in ``fit``, each one pass over them."""

    def __init__(self, fit: DataFrame, centre: Centre):
        self.fit, self.centre, self.n, self.size = fit, centre, centre.n, len(centre.whole)
        self.passes = 0

    def _summed(self, of_rows, width: int) -> np.ndarray:
        """Sum over all rows of a matrix with ``width`` columns made from centred rows: added up per task, then per line by a shuffle."""
        centre, size = self.centre, self.size

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    part = of_rows(centre.shifted(_matrix(batch.column(0), size)))
                    total = part if total is None else total + part
            if total is not None:
                columns = [pa.array(np.arange(len(total), dtype=np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in total.T)]
                yield pa.RecordBatch.from_arrays(columns, ["i", *(f"c{k}" for k in range(width))])

        names = [f"c{k}" for k in range(width)]
        parts = self.fit.mapInArrow(partial, ", ".join(["i int", *(f"{c} double" for c in names)]))
        rows = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect()  # one row per dimension
        self.passes += 1
        total = np.zeros((max((r["i"] for r in rows), default=-1) + 1, width))
        for r in rows:
            total[r["i"]] = r[1:]
        return total

    def times(self, block: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``block``."""
        return self._summed(lambda y: y.T @ (y @ block), block.shape[1]) / self.n

    def trace(self) -> float:
        return float(self._summed(lambda y: np.array([[(y * y).sum()]]), 1)[0, 0]) / self.n

    def of_projected(self, directions: np.ndarray) -> np.ndarray:
        """Covariance of the projections of all vectors on the columns of ``directions``."""

        def squares(y: np.ndarray) -> np.ndarray:
            w = y @ directions
            return w.T @ w

        return self._summed(squares, directions.shape[1]) / self.n


def _orthogonal(new: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The columns of ``new`` made orthonormal to each other and to ``to``; those that lie in its span are left out."""
    kept = to
    for v in new.T:
        size = np.linalg.norm(v)
        for _ in range(3):
            v = v - kept @ (kept.T @ v)
        if size > 0 and np.linalg.norm(v) > 1e-8 * size:
            v = v / np.linalg.norm(v)
            v = v - kept @ (kept.T @ v)
            kept = np.column_stack([kept, v / np.linalg.norm(v)])
    return kept[:, to.shape[1] :]


def minres(times, shifts: np.ndarray, project, right: np.ndarray, steps: int) -> np.ndarray:
    """Solves ``P (A - e I) P t = b`` for each column of ``right`` with its own shift, in lockstep: one product a step."""
    size = np.linalg.norm(right, axis=0)
    safe = lambda x: np.where(np.abs(x) > 1e-300, x, 1.0)
    v, before = right / safe(size), np.zeros_like(right)
    w, w_before = np.zeros_like(right), np.zeros_like(right)
    c, c_before = np.ones(len(size)), np.ones(len(size))
    s, s_before = np.zeros(len(size)), np.zeros(len(size))
    beta, left, out = np.zeros(len(size)), size.copy(), np.zeros_like(right)
    for _ in range(steps):
        u = project(times(v) - v * shifts) - before * beta
        alpha = (v * u).sum(axis=0)
        u = project(u - v * alpha)
        after = np.linalg.norm(u, axis=0)
        # the last two plane rotations applied to the new column of the tridiagonal matrix, and one more
        top, mid = s_before * beta, c_before * beta
        upper, low = c * mid + s * alpha, -s * mid + c * alpha
        r = np.hypot(low, after)
        c_new, s_new = low / safe(r), after / safe(r)
        w_new = (v - w * upper - w_before * top) / safe(r)
        on = r > 1e-300
        out += np.where(on, c_new * left, 0.0) * w_new
        left = -s_new * left
        w_before, w = w, w_new
        c_before, s_before, c, s = c, s, c_new, s_new
        before, v, beta = v, u / safe(after), after
    return out


def jacobi_davidson(times, size: int, wanted: int, block: int = BLOCK, steps: int = STEPS, most_search: int = MOST_SEARCH, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a symmetric non-negative operator.

    A pair is locked when its residual is below ``size`` roundings of the largest eigenvalue and all larger pairs are locked;
    the locked ones stay in every projection, and a last Rayleigh-Ritz over them settles their order."""
    wanted = min(wanted, size)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((size, 0)), []
    search = _orthogonal(rng.standard_normal((size, min(size, wanted + block))), locked)
    images = times(search)
    for k in range(1, MOST_ROUNDS):
        if k % REFRESH == 0:
            search = _orthogonal(search, locked)
            images = times(search)
        inner = search.T @ images
        ritz, turn = np.linalg.eigh((inner + inner.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        search, images = search @ turn, images @ turn  # the search space in its own Ritz vectors
        residuals = images - search * ritz
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        limit = max(size, 64) * np.finfo(float).eps * max([*values, ritz[0]])
        n = 0
        while n < len(ritz) and len(values) + n < wanted and sizes[n] <= limit:
            n += 1
        locked, values = np.column_stack([locked, search[:, :n]]), [*values, *ritz[:n].tolist()]
        search, images, ritz, residuals, sizes = search[:, n:], images[:, n:], ritz[n:], residuals[:, n:], sizes[n:]
        left = wanted - len(values)
        if left == 0:
            break
        if search.shape[1] > most_search:
            keep = max(left + block, most_search // 2)
            search, images = search[:, :keep], images[:, :keep]
        at = [j for j in range(min(left, len(ritz))) if sizes[j] > limit][:block]
        fixed = np.column_stack([locked, _orthogonal(search[:, at], locked)])
        project = lambda x, q=fixed: x - q @ (q.T @ x)
        found = minres(times, ritz[at], project, -project(residuals[:, at]), steps)
        new = _orthogonal(found, np.column_stack([locked, search]))
        if new.shape[1]:
            search, images = np.column_stack([search, new]), np.column_stack([images, times(new)])
        else:  # the search space is whole: only the images can still be off
            search = _orthogonal(search, locked)
            images = times(search)
    else:
        raise RuntimeError(f"{len(values)} of {wanted} eigenpairs after {MOST_ROUNDS} rounds")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order]


class Whitening:
    """Fitted components: ``values`` and ``vectors`` (columns) of the covariance, its ``trace``, and the centre of the vectors.  None
    of it if there was nothing to learn from."""

    def __init__(self, centre: Centre | None, values: np.ndarray, vectors: np.ndarray, trace: float, identity_error: float):
        self.centre, self.values, self.vectors, self.trace, self.identity_error = centre, values, vectors, trace, identity_error

    def apply(self, df: DataFrame, embedding: str = "embedding") -> DataFrame:
        """Usable rows of ``df`` with ``n``, ``deviation``, ``whitened`` (array, one number a component; empty if there are none)."""
        centre, axes = self.centre, self.vectors / np.sqrt(self.values)

        def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch.column("x"), len(axes))
                    white = centre.shifted(x) @ axes
                    offsets = np.arange(len(x) + 1, dtype=np.int32) * axes.shape[1]
                    out = [batch.column("row"), centre.deviations(x), pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))]
                    yield pa.RecordBatch.from_arrays(out, ["row", "deviation", "whitened"])

        usable = df.filter(_usable(F.col(embedding)) & (F.size(embedding) == len(axes)) & F.lit(centre is not None))
        rows = usable.select(F.struct("*").alias("row"), whole_numbers(F.col(embedding)).alias("x"))
        found = rows.mapInArrow(applied, rows.select("row").schema.add("deviation", "long").add("whitened", ArrayType(DoubleType())))
        n = F.lit(centre.n if centre else 0).cast("long")
        return renewed(found, df.columns, {"n": n, "deviation": F.col("deviation"), "whitened": F.col("whitened")})


def fit(df: DataFrame, embedding: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Learns from every distinct usable vector of ``df``."""
    usable = df.filter(_usable(F.col(embedding)))
    sizes = usable.groupBy(F.size(embedding).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.filter("size > 0").orderBy(F.col("n").desc(), F.col("size").desc()).first()
    if most is None:
        return Whitening(None, np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    size = most["size"]
    x = stored(usable.filter(F.size(embedding) == size).select(whole_numbers(F.col(embedding)).alias("x")).distinct())
    exact = F.sum(F.col("col").cast("decimal(20,0)"))
    sums = x.select(F.posexplode("x")).groupBy("pos").agg(exact.alias("s"), F.count(F.lit(1)).alias("n")).collect()  # one row per dimension
    v = Covariance(x, Centre(sums[0]["n"], [int(r["s"]) for r in sorted(sums)]))
    trace = v.trace()
    values, vectors = jacobi_davidson(v.times, size, components) if trace > 0 else (np.zeros(0), np.zeros((size, 0)))
    there = values > size * np.finfo(float).eps * trace
    values, vectors = values[there], vectors[:, there]
    error = float(np.abs(v.of_projected(vectors / np.sqrt(values)) - np.eye(len(values))).max()) if len(values) else 0.0
    return Whitening(v.centre, values, vectors, trace, error)
