"""Embedding whitening by block Jacobi-Davidson.

The covariance is never formed.  The vectors are packed once into blocks of rows;
a product with it is one Spark job: every task centres its blocks, multiplies
them with the given columns and returns a (dimension x columns) partial sum.

The search space starts from a few fixed random directions.  Each round takes
Rayleigh-Ritz pairs of the space, locks the leading ones whose residual has
reached double precision, solves the projected correction equations of the
others by MINRES (in lockstep: one product serves all columns), and adds the
corrections to the space.  A full space is cut back to its best Ritz vectors.
Locked vectors leave the space and are projected out of all that follows.  The
driver holds only (dimension x ``max_basis``) numbers.

Edge cases: vectors that are null, hold a null or a non-finite entry, or an entry
past 2**40 in size, are dropped; so are empty ones and those whose length is not
the most frequent one (the longer of equals).  Repeated rows and ids count as
often as they occur, null ids are kept.  Directions without variance (below
1e-12 of the trace) cannot be whitened and are no components; with fewer than
eight directions there are fewer components; an empty table gives an empty
result.  A deviation that does not fit a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch_path

SCALE, SHIFT = 1024, 100_000
LARGEST = float(2**40)
BLOCK_ROWS = 2048
EPS = float(np.finfo(float).eps)


def usable(c: str, dim: int | None = None) -> Column:
    """Whether a vector counts."""
    ok = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= LARGEST))
    ok = F.col(c).isNotNull() & (F.size(c) > 0) & F.coalesce(ok, F.lit(False))
    return ok if dim is None else ok & (F.size(c) == dim)


def whole(v: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * v.astype(float)).astype(np.int64) + SHIFT


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return whole(np.concatenate([np.asarray(v, float) for v in vectors])).reshape(-1, dim) if len(vectors) \
        else np.zeros((0, dim), np.int64)


class Centred:
    """The vectors as packed blocks, with their count, sums and mean."""

    def __init__(self, vectors: DataFrame, col: str, dim: int):
        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = _matrix(b[col], dim)
                for at in range(0, len(x), BLOCK_ROWS):
                    part = x[at:at + BLOCK_ROWS]
                    small = part.astype(np.int32) if np.abs(part).max() < 2**31 else part
                    # sums in two halves, so that no task can overflow
                    yield pd.DataFrame({"n": [len(part)], "wide": [small is part], "x": [small.tobytes()],
                                        "high": [(part >> 20).sum(axis=0)], "low": [(part & 0xFFFFF).sum(axis=0)]})

        path = scratch_path(vectors.sparkSession, "vector-blocks")
        (vectors.select(col).mapInPandas(pack, "n long, wide boolean, x binary, high array<long>, low array<long>")
         .write.parquet(path))
        blocks = vectors.sparkSession.read.parquet(path)
        self.dim, self.blocks = dim, blocks.select("n", "wide", "x")
        self.n = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        halves = blocks.select(F.posexplode(F.arrays_zip("high", "low"))).groupBy("pos").agg(
            F.sum(F.col("col.high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("col.low").cast("decimal(38,0)")).alias("low"))
        self.sums = [0] * dim
        for r in halves.collect():  # one row a dimension
            self.sums[r["pos"]] = (int(r["high"]) << 20) + int(r["low"])
        self.mean = np.array([s / max(1, self.n) for s in self.sums])
        self.products = 0

    def summed(self, width: int, part) -> np.ndarray:
        """Sum of ``part(centred block)`` over all blocks; ``width`` numbers reach the driver."""
        dim, mean = self.dim, self.mean

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(width)
            for b in batches:
                for wide, data in zip(b["wide"], b["x"]):
                    x = np.frombuffer(data, np.int64 if wide else np.int32).reshape(-1, dim)
                    total += part(x - mean).ravel()
            yield pd.DataFrame({"i": np.arange(width), "v": total})

        out = np.zeros(width)
        for r in self.blocks.mapInPandas(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        return out

    def times(self, b: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``b``."""
        self.products += 1
        return self.summed(b.size, lambda y: y.T @ (y @ b)).reshape(b.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(1, lambda y: np.array([(y * y).sum()]))[0]) / self.n


def _without(u: np.ndarray, t: np.ndarray) -> np.ndarray:
    """``t`` without its part in the space of the orthonormal columns ``u``."""
    for _ in range(2):
        t = t - u @ (u.T @ t)
    return t


def _new_directions(space: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``t`` adds to ``space``."""
    size = np.linalg.norm(t, axis=0)
    t = _without(space, t[:, size > 0] / size[size > 0])
    u, s, _ = np.linalg.svd(t, full_matrices=False)
    u = _without(space, u[:, s > 1e-10])
    return np.linalg.qr(u)[0] if u.size else u


def minres(apply, rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """MINRES for one symmetric system a column, in lockstep; ``apply`` takes and
    returns all columns.  Ends when every residual has fallen by ``tolerance``."""
    k = rhs.shape[1]
    size = np.linalg.norm(rhs, axis=0)
    v, v_old = rhs / np.where(size > 0, size, 1), np.zeros_like(rhs)
    beta, eta = np.zeros(k), size.copy()
    c, c_old, s, s_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    w, w_old, x = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    open_ = size > 0
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha - v_old * beta
        beta_new = np.linalg.norm(p, axis=0)
        # two rotations of before on the new column of the tridiagonal matrix, then its own
        delta = c * alpha - c_old * s * beta
        r3, r2 = s_old * beta, s * alpha + c_old * c * beta
        r1 = np.hypot(delta, beta_new)
        fine = open_ & (r1 > 0)
        safe = np.where(fine, r1, 1)
        c_old, s_old, c, s = c, s, np.where(fine, delta / safe, c), np.where(fine, beta_new / safe, s)
        w_new = (v - w_old * r3 - w * r2) / safe
        x = np.where(fine, x + w_new * (c * eta), x)
        w_old, w = w, w_new
        eta = np.where(fine, -s * eta, eta)
        open_ = fine & (np.abs(eta) > tolerance * size) & (beta_new > EPS * np.abs(alpha))
        if not open_.any():
            break
        v_old, v, beta = v, np.where(open_, p / np.where(beta_new > 0, beta_new, 1), 0), beta_new
    return x


@dataclass
class Pairs:
    values: np.ndarray  # falling
    vectors: np.ndarray  # a column each
    residuals: np.ndarray
    rounds: int


def jacobi_davidson(times, dim: int, wanted: int, max_basis: int | None = None, tolerance: float = 64 * EPS,
                    inner_steps: int = 6, max_rounds: int = 60, seed: int = 42) -> Pairs:
    """The ``wanted`` largest eigenpairs of the symmetric operator ``times``;
    a pair is locked when its residual is below ``tolerance`` times the largest
    eigenvalue."""
    wanted = min(wanted, dim)
    room = min(dim, max_basis or 8 * wanted)
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, min(dim, wanted + 2))))[0]
    image = times(space)
    locked, locked_image = np.zeros((dim, 0)), np.zeros((dim, 0))
    top, before = 0.0, np.inf
    for rounds in range(1, max_rounds + 1):
        h = space.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        left = min(wanted - locked.shape[1], space.shape[1])
        u, au = space @ y[:, :left], image @ y[:, :left]
        r = _without(locked, au - u * theta[:left])
        size = np.linalg.norm(r, axis=0)
        top = max(top, float(np.abs(theta).max()))
        # the whole space is exact up to rounding: nothing can be added to it
        whole_space = locked.shape[1] + space.shape[1] == dim
        done = size <= tolerance * top
        n = left if whole_space or done.all() else int(np.argmin(done))
        if n:
            locked, locked_image = np.hstack([locked, u[:, :n]]), np.hstack([locked_image, au[:, :n]])
            if locked.shape[1] == wanted:
                break
            space, image = space @ y[:, n:], image @ y[:, n:]
            u, r, theta, left = u[:, n:], r[:, n:], theta[n:], left - n
            space = np.linalg.qr(_without(locked, space))[0]
            image = _without(locked, times(space))
            continue
        if space.shape[1] + left > room - locked.shape[1]:
            keep = min(space.shape[1], left + 2)
            space, image = space @ y[:, :keep], image @ y[:, :keep]
        known = np.hstack([locked, u])

        def projected(t, shift=theta[:left], known=known):
            t = _without(known, t)
            return _without(known, times(t) - t * shift)

        # the equations need no more digits than the outer step can use
        worst = float((size / top).max())
        t = minres(projected, -_without(known, r), inner_steps, max(1e-4, min(0.1, worst)))
        fresh = _new_directions(np.hstack([locked, space]), t)
        if not fresh.size:
            fresh = _new_directions(np.hstack([locked, space]), np.random.default_rng(rounds).standard_normal((dim, 1)))
        space, image = np.hstack([space, fresh]), np.hstack([image, _without(locked, times(fresh))])
    # a last Rayleigh-Ritz step over all locked vectors puts them in order
    q = np.linalg.qr(locked)[0]
    aq = times(q)
    h = q.T @ aq
    theta, y = np.linalg.eigh((h + h.T) / 2)
    theta, vectors = theta[::-1], (q @ y)[:, ::-1]
    residual = np.linalg.norm(aq @ y[:, ::-1] - vectors * theta, axis=0)
    return Pairs(theta, vectors, residual, rounds)


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residuals: np.ndarray


def vector_length(rows: DataFrame, col: str) -> int:
    """The most frequent length of the usable vectors (0 without any)."""
    top = (rows.filter(usable(col)).groupBy(F.size(col).alias("d")).count()
           .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    return top[0]["d"] if top else 0


def fit(rows: DataFrame, col: str = "embedding", components: int = 8) -> Whitening | None:
    """Components of the vectors' covariance; None without a vector or variance."""
    dim = vector_length(rows, col)
    if not dim:
        return None
    data = Centred(rows.filter(usable(col, dim)), col, dim)
    trace = data.trace()
    if trace <= 0:
        return None
    found = jacobi_davidson(data.times, dim, components)
    keep = found.values > 1e-12 * trace
    values, u = found.values[keep], found.vectors[:, keep]
    u = u * np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    k = len(values)
    scaled = u / np.sqrt(values)

    def moments(y: np.ndarray) -> np.ndarray:
        z = y @ scaled
        return np.vstack([z.T @ z, z.sum(axis=0)])

    m = data.summed((k + 1) * k, moments).reshape(k + 1, k) / data.n
    error = float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max())
    return Whitening(data.n, data.sums, values, u, trace, error, found.residuals[keep])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)**2 over the dimensions, exact."""
    if len(x) == 0:
        return []
    far = n * np.abs(x).max(axis=0).astype(float) + np.abs(np.array(sums, float))
    if far.max() < 2**62 and (far * far).sum() < 2**62:  # no step can leave a long
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    rough = np.abs(n * x.astype(float) - np.array(sums, float))
    if far.max() < 2**62 and (rough * rough).sum(axis=1).max() < 2**62:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [v if v < 2**63 else None for v in exact]


def whiten(rows: DataFrame, model: Whitening, col: str = "embedding") -> DataFrame:
    """The usable rows' columns with ``deviation`` and ``whitened`` (an array, a
    number a component)."""
    dim = len(model.sums)
    mean = np.array([s / model.n for s in model.sums])
    scaled = model.vectors / np.sqrt(model.values)
    n, sums = model.n, model.sums

    @F.pandas_udf("deviation long, whitened array<double>")
    def run(vectors: pd.Series) -> pd.DataFrame:
        x = _matrix(vectors, dim)
        return pd.DataFrame({"deviation": pd.array(deviations(x, n, sums), dtype="Int64"), "whitened": list((x - mean) @ scaled)})

    names = [c for c in rows.columns if c.lower() not in ("deviation", "whitened")]
    own = F.struct(*[F.col(f"`{c}`") for c in names])
    out = rows.filter(usable(col, dim)).select(own.alias("row"), run(F.col(col).cast("array<double>")).alias("w"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], "w.deviation", "w.whitened")


def whitening_digest(embeddings: DataFrame) -> DataFrame:
    """One row a vector and component."""
    rows = embeddings.select("vec_id", "embedding")
    model = fit(rows)
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], shape)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    out = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                      "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
                      F.lit(model.identity_error).alias("identity_error"))
