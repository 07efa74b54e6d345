"""Operator 12: whitening of embeddings by incremental eigendecomposition.

Entries c become integers ``x = floor(64 * c) + 1000000``; the fit list is every
distinct x vector once. Each partition of the fit list keeps the spectrum of its
own scatter matrix: a vector that arrives is one centred rank-one update, whose
new eigenvalues are the roots of the secular equation (small and equal terms are
deflated first) and whose eigenvectors follow from the roots. Spectra of
partitions are combined in groups of ``FAN``, level by level: every eigenpair of
one is a rank-one update of the other, and one more stands for the distance of
the two means. The combined basis is then refined by one Rayleigh-Ritz step: all
tasks project the fit list, centred by the exact mean, on the basis; the summed
d x d matrix is diagonalised and turns the basis. A further pass measures the
covariance of the whitened fit list.

What reaches the driver is bounded by the dimension d: at most ``FAN`` spectra
and sums of d x d numbers.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are dropped; so are vectors whose length is not the most frequent one
(the greater of two as frequent). Repeated rows and copies are projected row by
row but fitted once. Null ids and ties need no rule. Components whose eigenvalue
is zero to rounding (below ``FLAT`` of the largest) can not be scaled to one and
are left out; an empty table, or one with a single distinct vector, gives an
empty result. ``deviation`` is null where the exact value does not fit a long;
``deviation_wide`` then holds it as text. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import store

SCALE, SHIFT = 64, 1_000_000   # fixed values of the contract
COMPONENTS = 16
FAN = 16                       # spectra combined by one task
FLAT = 1e-12
ROUNDS = 60                    # of the root search; about eight are needed

EPS = np.finfo(float).eps
SPECTRUM = "part long, n long, sums array<long>, mean array<double>, values array<double>, basis array<double>"


# --- spectra ---------------------------------------------------------------

def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z_j**2 / (d_j - mu)), for rising distinct d and
    unit z: (mu, matrix of d_j - mu_i without cancellation)."""
    k = len(d)
    z2 = z * z
    upper = np.append(d[1:], d[-1] + rho)          # no root lies beyond
    half = (upper - d) / 2
    w = 1 / rho + z2 @ (1 / (d[:, None] - d - half))
    left = w >= 0                                  # the root is in the lower half
    origin = np.arange(k) + ~left                  # nearest pole
    lo, hi = np.where(left, 0.0, -half), np.where(left, half, 0.0)
    if not left[-1]:
        origin[-1], lo[-1], hi[-1] = k - 1, half[-1], 2 * half[-1]
    delta = d[:, None] - d[origin]
    above = upper - d[origin]
    below = np.triu(np.ones((k, k)))
    diag = np.arange(k)
    tau = (lo + hi) / 2
    for _ in range(ROUNDS):
        gap = delta - tau
        t = 1 / gap
        low = t * below
        psi, dpsi = z2 @ low, z2 @ (low * t)
        phi, dphi = z2 @ t - psi, z2 @ (t * t) - dpsi
        w = 1 / rho + psi + phi
        done = np.abs(w) <= 4 * k * EPS * (1 / rho + np.abs(psi) + np.abs(phi))
        if done.all():
            break
        lo, hi = np.where(w < 0, tau, lo), np.where(w < 0, hi, tau)
        # rational step between the two poles beside the root
        p, q = gap[diag, diag], above - tau
        a, b, c = (p + q) * w - p * q * (dpsi + dphi), p * q * w, w - p * dpsi - q * dphi
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
        new = tau + step
        new = np.where((new > lo) & (new < hi), new, (lo + hi) / 2)
        stuck = (new == tau) | (hi - lo <= EPS * np.abs(tau))
        tau = np.where(done, tau, new)
        if (done | stuck).all():
            break
    return d[origin] + tau, delta - tau


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (rising values, basis by columns) after adding weight * v v'."""
    z = v @ basis
    norm = float(np.sqrt(z @ z))
    rho = weight * norm * norm
    if not rho > 0:
        return values, basis
    z = z / norm
    d = values.copy()
    tol = 8 * EPS * max(abs(d[0]), abs(d[-1]), rho)
    live = np.flatnonzero(rho * np.abs(z) > tol)   # deflation: no share in the update
    zl, dl = z[live], d[live]
    with np.errstate(all="ignore"):
        equal = np.diff(dl) * np.abs(zl[:-1] * zl[1:]) <= tol * (zl[:-1] ** 2 + zl[1:] ** 2)
    if equal.any():                                # deflation: equal values, turned into one
        basis, kept = basis.copy(), []
        for j in live:
            if kept:
                i = kept[-1]
                r = float(np.hypot(z[i], z[j]))
                c, s = z[j] / r, z[i] / r
                if abs((d[j] - d[i]) * c * s) <= tol:
                    bi, bj = basis[:, i].copy(), basis[:, j].copy()
                    basis[:, i], basis[:, j] = c * bi - s * bj, s * bi + c * bj
                    di, dj = d[i], d[j]
                    d[i], d[j] = di * c * c + dj * s * s, di * s * s + dj * c * c
                    z[i], z[j] = 0.0, r
                    kept.pop()
            kept.append(j)
        live = np.array(kept)
        zl, dl = z[live], d[live]
    if not len(live):
        return values, basis
    mu, gap = secular_roots(dl, zl / np.sqrt(zl @ zl), rho * float(zl @ zl))
    # the z for which the computed roots are exact keeps the vectors orthogonal
    apart = dl[:, None] - dl
    np.fill_diagonal(apart, 1.0)
    exact = np.sqrt(np.abs((gap / apart).prod(1))) * np.sign(zl)
    u = exact[:, None] / gap
    u /= np.sqrt((u * u).sum(0))
    basis = basis.copy()
    basis[:, live] = basis[:, live] @ u
    d[live] = mu
    order = np.argsort(d, kind="stable")
    return d[order], basis[:, order]


class Spectrum:
    """Count, exact sums, mean and eigenpairs of a scatter matrix."""

    def __init__(self, d: int):
        self.n, self.sums, self.mean = 0, [0] * d, np.zeros(d)
        self.values, self.basis = np.zeros(d), np.eye(d)

    def add(self, x: np.ndarray) -> None:
        """Centred rank-one update by each row of integers."""
        self.sums = [a + b for a, b in zip(self.sums, x.sum(0).tolist())]
        for row in x.astype(float):
            off = row - self.mean
            self.values, self.basis = rank_one(self.values, self.basis, off, self.n / (self.n + 1))
            self.n += 1
            self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        off, n = other.mean - self.mean, self.n + other.n
        for value, v in zip(other.values, other.basis.T):
            self.values, self.basis = rank_one(self.values, self.basis, v, max(float(value), 0.0))
        self.values, self.basis = rank_one(self.values, self.basis, off, self.n * other.n / n)
        self.mean = self.mean + off * (other.n / n)
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]
        self.n = n

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": self.sums, "mean": self.mean.tolist(),
                "values": self.values.tolist(), "basis": self.basis.ravel().tolist()}

    @staticmethod
    def of(row: dict) -> Spectrum:
        d = len(row["sums"])
        s = Spectrum(d)
        s.n, s.sums, s.mean = row["n"], list(row["sums"]), np.array(row["mean"])
        s.values, s.basis = np.array(row["values"]), np.array(row["basis"]).reshape(d, d)
        return s


def _batch(rows: list[dict]):
    import pyarrow as pa

    many, real = pa.list_(pa.int64()), pa.list_(pa.float64())
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("part", pa.int64()), ("n", pa.int64()), ("sums", many), ("mean", real), ("values", real), ("basis", real)]))


def spectrum(fit: DataFrame, d: int) -> Spectrum:
    """Combined spectrum of a stored table with the column ``x``."""
    def one(batches):
        s = Spectrum(d)
        for b in batches:
            s.add(_matrix(b.column(0), d))
        if s.n:
            yield _batch([s.row(TaskContext.get().partitionId())])

    def combine(table):
        import pyarrow as pa

        rows = sorted(table.drop_columns(["g"]).to_pylist(), key=lambda r: r["part"])
        s = Spectrum(d)
        for r in rows:
            s.merge(Spectrum.of(r)) if s.n else s.__dict__.update(Spectrum.of(r).__dict__)
        return pa.Table.from_batches([_batch([s.row(table["g"][0].as_py())])])

    parts = store(fit.select("x").mapInArrow(one, SPECTRUM), "spectra")
    while (k := parts.count()) > FAN:
        groups = F.pmod(F.col("part"), F.lit(-(-k // FAN))).alias("g")
        parts = store(parts.select("*", groups).groupBy("g").applyInArrow(combine, SPECTRUM), "spectra")
    out = Spectrum(d)
    for r in sorted((r.asDict() for r in parts.collect()), key=lambda r: r["part"]):
        out.merge(Spectrum.of(r)) if out.n else out.__dict__.update(Spectrum.of(r).__dict__)
    return out


# --- tables ----------------------------------------------------------------

def _matrix(col, d: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def vectors(rows: DataFrame, vec: str = "embedding", carry: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """The columns ``carry`` and ``x`` of the rows with a whole, finite vector."""
    v = F.col(f"`{vec}`").cast("array<double>")
    broken = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(broken, F.lit(True))).select(
        *[F.col(f"`{c}`") for c in carry],
        F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def off_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: integers of 64 bits, or Python's where those end."""
    big = max(map(abs, sums), default=0) + n * int(max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))))
    return x * n - np.array(sums) if big < 1 << 62 else x.astype(object) * n - np.array(sums, object)


def product_sum(fit: DataFrame, d: int, k: int, project) -> np.ndarray:
    """Sum over all rows of p' p, where ``project`` turns a matrix of x into the
    rows p of length k; added up by entry."""
    def one(batches):
        import pyarrow as pa

        total = np.zeros((k, k))
        for b in batches:
            p = project(_matrix(b.column(0), d))
            total += p.T @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], ["at", "s"])

    out = np.zeros(k * k)
    for r in fit.select("x").mapInArrow(one, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).collect():
        out[r["at"]] = r["s"]
    return out.reshape(k, k)


class Whitener:
    """Fitted components: ``weights`` (d x k, unit columns), ``values`` (k)."""

    def __init__(self, n, sums, weights, values, trace, error):
        self.n, self.sums, self.weights, self.values = n, sums, weights, values
        self.trace, self.error = trace, error


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on the distinct vectors of ``x``; None where no component is left."""
    sizes = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not sizes:
        return None
    d = sizes[0]["d"]
    rows = store(x.where(F.size("x") == d).select("x").distinct(), "fit-list")
    s = spectrum(rows, d)
    n, sums = s.n, s.sums
    basis = np.linalg.qr(s.basis[:, ::-1])[0]
    centred = lambda m: off_mean(m, n, sums).astype(float) / n
    ritz = product_sum(rows, d, d, lambda m: centred(m) @ basis) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    k = min(components, int((values > FLAT * values[0]).sum())) if values[0] > 0 else 0
    if not k:
        return None
    weights = basis @ turn[:, :k]
    scaled = weights / np.sqrt(values[:k])
    error = np.abs(product_sum(rows, d, k, lambda m: centred(m) @ scaled) / n - np.eye(k)).max()
    return Whitener(n, sums, weights, values[:k], float(np.trace(ritz)), float(error))


def transform(x: DataFrame, w: Whitener, carry: str = "vec_id") -> DataFrame:
    """One row per vector and component."""
    n, sums, k, d = w.n, w.sums, len(w.values), len(w.sums)
    scaled, explained, error = w.weights / np.sqrt(w.values), w.values / w.trace, w.error
    wide = 1 << 63

    def one(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            off = off_mean(_matrix(b.column(1), d), n, sums)
            m = off.astype(float)
            if d * float(np.abs(m).max()) ** 2 < wide / 2:
                dev = (off * off).sum(1).tolist()
            else:
                dev = [sum(int(v) ** 2 for v in row) for row in off]
            at = pa.array(np.repeat(np.arange(b.num_rows), k))
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                pa.array(np.full(b.num_rows * k, n)),
                pa.array([v if v < wide else None for v in dev], pa.int64()).take(at),
                pa.array((m / n @ scaled).ravel()), pa.array(np.tile(explained, b.num_rows)),
                pa.array(np.full(b.num_rows * k, error)),
                pa.array([None if v < wide else str(v) for v in dev], pa.string()).take(at)],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_wide"])

    return x.where(F.size("x") == d).select(carry, "x").mapInArrow(one, RESULT)


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, deviation_wide string")


def report(rows: DataFrame) -> DataFrame:
    """Whitened components of every row of ``embeddings``: columns of ``RESULT``."""
    x = vectors(rows.withColumn("vec_id", F.col("vec_id").cast("long")))
    w = fit(x)
    return rows.sparkSession.createDataFrame([], RESULT) if w is None else transform(x, w)
