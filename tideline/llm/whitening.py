"""Embedding whitening by an incremental eigendecomposition.

Vectors become whole numbers, ``x = floor(64 * c) + 1000000``; the fit list holds every different one once. Each task folds its part of
the list into a spectrum, the eigenvalues and vectors of the scatter around its own mean: a vector is one centred rank-one update, whose new
eigenvalues are the roots of the secular equation ``1 + rho * sum(z**2 / (d - t)) = 0``, found for all of them in lockstep by two-pole
rational steps inside a bracket. Coordinates that the update does not touch and equal eigenvalues (after a rotation) are deflated, and new vectors come from
corrected weights, so that they are orthogonal. Spectra are combined in a tree, again by one update for each eigenpair and one for the means. A last
distributed pass refines the result by Rayleigh-Ritz: the covariance of the centred list within the basis found, whose small eigenproblem
gives the components to double precision. Counts and sums are whole numbers throughout.

A vector that is null or holds a null or a non-finite entry is left out, as are vectors that have not the most common length (ties: the shorter). Repeated rows are
answered each and counted once in the fit list. Components with an eigenvalue under ``floor`` of the largest are numerically absent and give no
rows, so a table with a single different vector has no rows, nor has an empty one. Only the id and the vector are read.
``deviation`` is null where it exceeds 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored, tidied

_EPS = np.finfo(float).eps
SCALE, SHIFT = 64, 1_000_000


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float, *, close: float = 1e-12, most: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z**2 / (d - t))`` and the matrix of ``d_i - t_j``; ``d`` ascends strictly, no ``z`` is 0, rho > 0.

    Every root is sought from the nearer one of its poles on, so that differences to the poles keep their digits, until the
    equation holds to ``close`` of the sum of its terms.
    """
    k = len(d)
    weight = (rho * z * z)[:, None]
    if k == 1:
        return d + weight[0], -weight
    upper = np.append(d[1:], d[-1] + rho * (z @ z))  # the last root lies below this
    gap = upper - d
    middle = (weight / (d[:, None] - (d + gap / 2))).sum(0) + 1
    right = middle < 0  # the root lies in the right half
    right[-1] = False
    origin = np.where(right, upper, d)
    from_origin = d[:, None] - origin
    left_pole, right_pole = d - origin, upper - origin
    low = np.where(right, -gap / 2, np.where(middle < 0, gap / 2, 0.0))
    high = np.where(right | (middle < 0), right_pole, gap / 2)
    t = (low + high) / 2
    near = np.where(right, -np.append(weight[1:, 0], 0.0), weight[:, 0])  # as if the nearer pole were alone
    t = np.where((near > low) & (near <= high), near, t)
    below = (np.arange(k)[:, None] <= np.arange(k)).astype(float)  # poles at or below each root
    last = np.arange(k) == k - 1
    for _ in range(most):
        parts = weight / (from_origin - t)
        slopes = parts / (from_origin - t)
        psi, d_psi = np.einsum("ij,ij->j", parts, below), np.einsum("ij,ij->j", slopes, below)
        phi, d_phi = parts.sum(0) - psi, slopes.sum(0) - d_psi
        f = 1 + psi + phi
        low, high = np.where(f < 0, t, low), np.where(f > 0, t, high)
        done = (np.abs(f) <= close * (1 + np.abs(psi) + np.abs(phi))) | (high - low <= 2 * _EPS * np.abs(t))
        if done.all():
            break
        a, b = left_pole - t, right_pole - t
        c = f - a * d_psi - b * d_phi
        linear = c * (a + b) + a * a * d_psi + b * b * d_phi
        product = a * b * f
        root = np.sqrt(np.maximum(linear * linear - 4 * c * product, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(linear <= 0, (linear - root) / (2 * c), 2 * product / (linear + root))
            step = np.where(last, a + a * a * d_psi / (f - a * d_psi), step)
        new = t + step
        t = np.where(done, t, np.where((new >= low) & (new <= high) & (new != 0), new, (low + high) / 2))
    return origin + t, from_origin - t


def _deflate_equal(d: np.ndarray, z: np.ndarray, q: np.ndarray, active: np.ndarray, least: float) -> np.ndarray:
    """Rotate the pairs of nearly equal eigenvalues so that the update leaves one of each pair alone; the indices that stay."""
    stay: list[int] = []
    for i in active:
        if stay:
            j = stay[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[i] / r, z[j] / r
            if abs((d[i] - d[j]) * c * s) <= least:
                z[i], z[j] = r, 0.0
                q[:, [j, i]] = q[:, [j, i]] @ np.array([[c, s], [-s, c]])
                d[j], d[i] = d[j] * c * c + d[i] * s * s, d[j] * s * s + d[i] * c * c
                stay[-1] = i
                continue
        stay.append(i)
    return np.array(stay, np.int64)


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of ``q @ diag(d) @ q.T + rho * outer(v, v)``."""
    z = v @ q
    size = float(z @ z)
    rho *= size
    if not rho > 0:
        return d, q
    z = z / np.sqrt(size)
    least = 8 * _EPS * max(abs(d[-1]), rho)
    active = np.flatnonzero(rho * np.abs(z) > least)
    if not len(active):
        return d, q
    own, pull = d[active], z[active]
    if len(active) > 1 and (np.diff(own) * np.abs(pull[1:] * pull[:-1]) <= least * (pull[1:] ** 2 + pull[:-1] ** 2)).any():
        d, q = d.copy(), q.copy()
        active = _deflate_equal(d, z, q, active, least)
        active = active[np.argsort(d[active], kind="stable")]
        own, pull = d[active], z[active]
    roots, delta = secular_roots(own, pull, rho)
    # weights for which these roots are exact (Gu and Eisenstat): the vectors are then orthogonal
    apart = own[:, None] - own
    np.fill_diagonal(apart, 1.0)
    corrected = np.sqrt(np.abs(np.prod(delta / apart, 1))) * np.sign(pull)
    u = corrected[:, None] / delta
    u /= np.sqrt((u * u).sum(0))
    d, turned = d.copy(), q.copy()
    d[active] = roots
    turned[:, active] = q[:, active] @ u
    order = np.argsort(d, kind="stable")
    return d[order], turned[:, order]


@dataclass
class Spectrum:
    """Number and exact sums of some vectors, and the eigenpairs of their scatter around their mean."""

    n: int
    sums: np.ndarray
    d: np.ndarray
    q: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size, np.int64), np.zeros(size), np.eye(size))

    def add(self, x: np.ndarray) -> None:
        if self.n:
            apart = centred(x, self.n, self.sums)
            self.d, self.q = rank_one(self.d, self.q, apart, self.n / (self.n + 1))
        self.n, self.sums = self.n + 1, self.sums + x

    def join(self, other: Spectrum) -> None:
        """The spectrum of both lists: one update for each eigenpair of the other and one for the distance of the means."""
        if not other.n:
            return
        if not self.n:
            self.n, self.sums, self.d, self.q = other.n, other.sums, other.d, other.q
            return
        for value, vector in zip(other.d, other.q.T, strict=True):
            if value > 0:
                self.d, self.q = rank_one(self.d, self.q, vector, float(value))
        apart = other.sums / other.n - self.sums / self.n
        self.d, self.q = rank_one(self.d, self.q, apart, self.n * other.n / (self.n + other.n))
        self.n, self.sums = self.n + other.n, self.sums + other.sums


def numerators(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` without large products in between."""
    whole, rest = np.divmod(sums, n)
    return n * (x - whole) - rest


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return numerators(x, n, sums) / n


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the rows whose vector is complete and of the most common length."""
    bad = F.exists(F.col(vector_col), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(F.col(vector_col), lambda c: F.floor(SCALE * c.cast("double")) + F.lit(SHIFT).cast("bigint"))
    found = rows.where(F.col(vector_col).isNotNull() & ~bad).select(F.col(id_col).alias("vec_id"), x.alias("x"))
    common = found.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return found.where(F.size("x") == (common[0]["size"] if common else 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


_SPECTRUM = "part bigint, n bigint, sums array<bigint>, d array<double>, q array<double>"
_GRAM = "part bigint, gram array<double>"


def _told(part: int, s: Spectrum) -> dict[str, pa.Array]:
    return {
        "part": pa.array([part], pa.int64()),
        "n": pa.array([s.n], pa.int64()),
        "sums": pa.array([s.sums.tolist()], pa.list_(pa.int64())),
        "d": pa.array([s.d.tolist()], pa.list_(pa.float64())),
        "q": pa.array([s.q.ravel().tolist()], pa.list_(pa.float64())),
    }


def _in_tree(rows: DataFrame, schema: str, join: Callable[[pa.Table], dict[str, pa.Array]], fan: int, name: str) -> dict | None:
    """One row made of all ``rows`` (part, ...) by joining at most ``fan`` of them at a time; a task holds no more."""
    rows = stored(rows, name)
    left = rows.agg(F.max("part")).head()[0]
    if left is None:
        return None
    while left > 0:
        rows = rows.withColumn("part", F.expr(f"part div {fan}")).groupBy("part").applyInArrow(lambda table: pa.table(join(table)), schema)
        left //= fan
    return rows.collect()[0].asDict()


def spectrum(fit: DataFrame, size: int, fan: int) -> Spectrum | None:
    """Of all vectors in column ``x``."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(size)
        for batch in batches:
            for x in _matrix(batch.column(0), size):
                own.add(x)
        if own.n:
            yield pa.RecordBatch.from_pydict(_told(TaskContext.get().partitionId(), own))

    def join(table: pa.Table) -> dict[str, pa.Array]:
        total = Spectrum.empty(size)
        for r in table.to_pylist():
            total.join(Spectrum(r["n"], np.array(r["sums"], np.int64), np.array(r["d"]), np.array(r["q"]).reshape(size, size)))
        return _told(table.column("part")[0].as_py(), total)

    r = _in_tree(fit.select("x").mapInArrow(tidied(fold), _SPECTRUM), _SPECTRUM, join, fan, "spectra")
    return r and Spectrum(r["n"], np.array(r["sums"], np.int64), np.array(r["d"]), np.array(r["q"]).reshape(size, size))


def gram(fit: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray, fan: int) -> np.ndarray:
    """Covariance of the centred vectors in column ``x`` within ``basis``, divisor ``n``."""
    size, width = basis.shape

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = centred(_matrix(batch.column(0), size), n, sums) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "gram": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    def join(table: pa.Table) -> dict[str, pa.Array]:
        total = _matrix(table.column("gram").combine_chunks(), width * width).sum(0)
        return {"part": table.column("part")[:1], "gram": pa.array([total.tolist()], pa.list_(pa.float64()))}

    return np.array(_in_tree(fit.select("x").mapInArrow(tidied(fold), _GRAM), _GRAM, join, fan, "grams")["gram"]).reshape(width, width) / n


@dataclass
class Whitening:
    """``(x - sums / n) @ components / sqrt(values)`` whitens the fit list."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    error: float  # largest entry of the whitened covariance minus the identity


def learn(fit: DataFrame, size: int, *, components: int = 16, floor: float = 1e-12) -> Whitening | None:
    """From ``fit`` with each different vector once in column ``x``; ``fit`` should be a stored table, it is read three times."""
    fan = max(2, min(32, (1 << 22) // max(1, size * size)))
    found = spectrum(fit, size, fan)
    if found is None:
        return None
    basis = np.linalg.qr(found.q[:, ::-1])[0]
    inside = gram(fit, found.n, found.sums, basis, fan)
    values, turn = np.linalg.eigh((inside + inside.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    there = np.flatnonzero(values > max(floor * values[0], 0.0))[:components]
    chosen = basis @ turn[:, there]
    chosen *= np.sign(chosen[np.abs(chosen).argmax(0), np.arange(len(there))])
    own = Whitening(found.n, found.sums, chosen, values[there], float(np.trace(inside)), 0.0)
    if len(there):
        checked = gram(fit, own.n, own.sums, chosen / np.sqrt(own.values), fan)
        own.error = float(np.abs(checked - np.eye(len(there))).max())
    return own


def _squares(apart: np.ndarray) -> list[int | None]:
    """Sums of squares of each row, exactly; None beyond 64 bits."""
    rough = (apart.astype(float) ** 2).sum(1)
    if (rough < 2.0**62).all():
        return (apart * apart).sum(1).tolist()
    exact = [sum(int(a) * int(a) for a in row) for row in apart]
    return [e if e < 1 << 63 else None for e in exact]


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each of ``vectors`` (vec_id, x) and component."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k, size = len(m.values), len(m.sums)
        turn, share = m.components / np.sqrt(m.values), m.values / m.trace
        for batch in batches:
            apart = numerators(_matrix(batch.column(1), size), m.n, m.sums)
            rows = len(apart)
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, m.n, np.int64)),
                    pa.array(_squares(apart), pa.int64()).take(each),
                    pa.array(((apart / m.n) @ turn).ravel()),
                    pa.array(np.tile(share, rows)),
                    pa.array(np.full(rows * k, m.error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(tidied(run), f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def whiten(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    vectors = whole_vectors(rows, id_col, vector_col)
    fit = stored(vectors.select("x").distinct(), "fit-list")
    one = fit.select(F.size("x").alias("size")).head()
    model = learn(fit, one["size"], components=components) if one and one["size"] else None
    if model is None:
        empty = np.zeros(1)
        return project(vectors.limit(0), Whitening(1, empty.astype(np.int64), np.zeros((1, 0)), empty[:0], 1.0, 0.0))
    return project(vectors, model)
