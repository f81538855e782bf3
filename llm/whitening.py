"""Whitening of vectors by an incremental eigendecomposition.

Each partition keeps count, mean, eigenvalues and eigenvectors of the scatter of the vectors it has seen, and applies
every further vector as a centred rank-one update: the roots of the secular equation are the new eigenvalues; entries
of the update that vanish and eigenvalues that coincide are deflated first. Two spectra combine by one rank-one update
for each eigenvector of the second one and one for the distance of the means, in a tree of at most ``FAN`` spectra a
task. A Rayleigh-Ritz pass over all vectors then projects the covariance, centred with exact means, on the combined basis, and
its small eigenproblem gives components to double precision. Only matrices of the vectors' length reach the driver.

A component ``c`` of a vector counts as the long ``floor(scale * c) + offset``; products beyond 2**53 are cut to it.
Rows whose vector is null, of another length than most, or holds null or non-finite entries are dropped. Rows without
id, repeated rows and zero vectors count as any other. Directions without variance have ``whitened`` null. ``deviation``
is null where it exceeds a long. An empty table gives no rows. Further columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Sent, stored

EPS = np.finfo(float).eps
#: Spectra that one task combines.
FAN = 16
STATE = "part int, n long, ints array<long>, floats array<double>"


def secular_roots(poles: np.ndarray, squares: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(squares / (poles - x))``, and ``poles[j] - root[i]`` as a matrix that is exact near the poles.

    ``poles`` rise strictly; each root lies between a pole and the next, the last one within ``rho * sum(squares)`` of the last.
    All roots are refined at once by rational interpolation through both neighbouring poles, inside shrinking brackets.
    """
    k = len(poles)
    gap = np.append(np.diff(poles), rho * squares.sum())
    at_middle = 1 + rho * (squares / (poles - (poles + gap / 2)[:, None])).sum(axis=1)
    beyond = at_middle < 0
    right = beyond.copy()
    right[-1] = False
    origin = np.arange(k) + right
    base = poles - poles[origin][:, None]
    low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
    if beyond[-1]:
        low[-1], high[-1] = gap[-1] / 2, gap[-1] * (1 + 4 * EPS)
    x = (low + high) / 2
    below = np.tri(k)
    todo = np.arange(k)
    for _ in range(100):
        at, mask = x[todo], below[todo]
        away = base[todo] - at[:, None]
        terms = rho * squares / away
        left, every = np.einsum("ij,ij->i", terms, mask), terms.sum(axis=1)
        f = 1 + every
        high[todo] = np.where(f >= 0, at, high[todo])
        low[todo] = np.where(f < 0, at, low[todo])
        bottom, top = low[todo], high[todo]
        # terms left of a root are negative, the others positive
        open_ = (np.abs(f) > EPS * k * (1 + every - 2 * left)) & (top - bottom > 2 * EPS * np.maximum(np.abs(bottom), np.abs(top)))
        if not open_.any():
            break
        terms /= away
        left_slopes, slopes = np.einsum("ij,ij->i", terms, mask), terms.sum(axis=1)
        rows = np.arange(len(todo))
        near, far = away[rows, todo], away[rows, np.minimum(todo + 1, k - 1)]
        c = f - near * left_slopes - far * (slopes - left_slopes)
        a = (near + far) * f - near * far * slopes
        b = near * far * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # beyond the last pole only that pole is near
            step = np.where(todo == k - 1, near + slopes * near**2 / (f - slopes * near), step)
        new = at + step
        new = np.where((new > bottom) & (new < top), new, (bottom + top) / 2)
        x[todo[open_]] = new[open_]
        todo = todo[open_]
    return poles[origin] + x, base - x[:, None]


def add_rank_one(values: np.ndarray, vectors: np.ndarray, direction: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) after adding ``rho * direction direction^T``."""
    z = vectors.T @ direction
    size = z @ z
    if not rho * size > 0:
        return values, vectors
    slack = 8 * EPS * max(np.abs(values).max(), rho * size)
    live = rho * np.abs(z) * np.sqrt(size) > slack
    own = np.flatnonzero(live)
    if len(own) > 1 and (np.diff(values[own]) <= 4 * slack).any():
        values, vectors = values.copy(), vectors.copy()
        before = own[0]
        for j in own[1:]:
            r = np.hypot(z[before], z[j])
            c, s = z[j] / r, z[before] / r
            if (values[j] - values[before]) * abs(c * s) <= slack:
                # a rotation of two equal directions leaves the update in one of them
                z[before], z[j] = 0.0, r
                u, v = vectors[:, before].copy(), vectors[:, j].copy()
                vectors[:, before], vectors[:, j] = c * u - s * v, s * u + c * v
                p, q = values[before], values[j]
                values[before], values[j] = p * c * c + q * s * s, p * s * s + q * c * c
                live[before] = False
            before = j
        own = np.flatnonzero(live)
    if not len(own):
        return values, vectors
    poles = values[own]
    roots, away = secular_roots(poles, z[own] ** 2, rho)
    # the update that has exactly these roots: its eigenvectors are orthogonal to rounding
    apart = np.abs(poles[:, None] - poles)
    np.fill_diagonal(apart, 1.0)
    away[away == 0] = np.finfo(float).tiny
    exact = np.copysign(np.exp((np.log(np.abs(away)).sum(axis=0) - np.log(apart).sum(axis=0)) / 2), z[own])
    turn = exact / away
    turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
    values, vectors = values.copy(), vectors.copy()
    vectors[:, own] = vectors[:, own] @ turn.T
    values[own] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums, mean and scatter of some vectors; sums are kept in two halves of 32 bits, the mean from ``offset``."""

    def __init__(self, size: int):
        self.n, self.sums, self.mean = 0, np.zeros((2, size), np.int64), np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray, offset: int) -> None:
        """Every row of ``x`` as one update."""
        self.sums += np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
        for row in (x - offset).astype(np.float64):
            away = row - self.mean
            self.values, self.vectors = add_rank_one(self.values, self.vectors, away, self.n / (self.n + 1))
            self.n += 1
            self.mean = self.mean + away / self.n

    def combine(self, other: Spectrum) -> None:
        n = self.n + other.n
        away = other.mean - self.mean
        for value, vector in zip(other.values[::-1], other.vectors.T[::-1], strict=True):
            self.values, self.vectors = add_rank_one(self.values, self.vectors, vector, value)
        self.values, self.vectors = add_rank_one(self.values, self.vectors, away, self.n * other.n / n)
        self.n, self.mean, self.sums = n, self.mean + away * (other.n / n), self.sums + other.sums

    def row(self, part: int) -> pa.RecordBatch:
        return _state(part, self.n, self.sums.ravel(), np.concatenate([self.mean, self.values, self.vectors.ravel()]))

    @classmethod
    def of(cls, n: int, ints: list[int], floats: list[float]) -> Spectrum:
        size = len(ints) // 2
        out, numbers = cls(size), np.array(floats)
        out.n, out.sums, out.mean, out.values = n, np.array(ints, np.int64).reshape(2, size), numbers[:size], numbers[size : 2 * size]
        out.vectors = numbers[2 * size :].reshape(size, size)
        return out


def _state(part: int, n: int, ints: np.ndarray, floats: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([ints.tolist()], pa.list_(pa.int64())), pa.array([floats.tolist()], pa.list_(pa.float64()))],
        names=["part", "n", "ints", "floats"],
    )


def _combined(states: DataFrame, merge: Callable[[list[dict]], pa.RecordBatch]) -> dict | None:
    """All states as one: rounds of groups of ``FAN``, each written to the shared folder."""
    parts = (states.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:

        def one(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: r["part"])
            return pa.Table.from_batches([merge([r | {"part": rows[0]["part"] // FAN} for r in rows])])

        states = stored(states.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(one, STATE))
        parts = -(-parts // FAN)
    row = states.first()
    return row.asDict() if row else None


def _merge_spectra(rows: list[dict]) -> pa.RecordBatch:
    whole = Spectrum.of(rows[0]["n"], rows[0]["ints"], rows[0]["floats"])
    for r in rows[1:]:
        whole.combine(Spectrum.of(r["n"], r["ints"], r["floats"]))
    return whole.row(rows[0]["part"])


def _merge_sums(rows: list[dict]) -> pa.RecordBatch:
    return _state(rows[0]["part"], sum(r["n"] for r in rows), np.zeros(0, np.int64), np.sum([r["floats"] for r in rows], axis=0))


@dataclass
class Whitening:
    """Everything the output needs; its size is set by the vectors' length."""

    n: int
    #: Whole and remaining part of each mean: ``sum = whole * n + rest``.
    whole: np.ndarray
    rest: np.ndarray
    #: Unit eigenvectors as columns, by falling eigenvalue, and those eigenvalues.
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sum / n``; the difference to the whole part is exact."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def scales(self) -> np.ndarray:
        """One over the standard deviations; NaN where there is no variance."""
        floor = len(self.whole) * EPS * max(float(self.variances.max(initial=0.0)), 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.variances > floor, 1 / np.sqrt(self.variances), np.nan)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of ``(n * x - sum)**2`` of each row."""
        away = x - self.whole
        rough = ((away.astype(np.float64) * self.n - self.rest.astype(np.float64)) ** 2).sum(axis=1)
        small = rough < 2.0**62
        t = np.where(small[:, None], away, 0) * self.n - self.rest
        out: list[int | None] = (t * t).sum(axis=1).tolist()
        for i in np.flatnonzero(~small):
            exact = sum((int(a) * self.n - int(r)) ** 2 for a, r in zip(away[i], self.rest, strict=True))
            out[i] = exact if exact < 2**63 else None
        return out


def _whole_numbers(column: pa.Array, scale: float, offset: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(np.clip(scale * flat, -(2.0**53), 2.0**53)).astype(np.int64).reshape(len(column), -1) + offset


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``v``: the rows that take part."""
    good = F.forall("v", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & good)
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (size["d"] if size else 0))


def _sums(rows: DataFrame, scale: float, offset: int, fitted: Whitening, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and mean outer product, over all rows, of the centred vectors in a basis."""
    width = basis.shape[1]
    sent = Sent(rows.sparkSession, (fitted, basis))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            if len(batch):
                fit, turn = sent.value
                y = fit.centred(_whole_numbers(batch["v"], scale, offset)) @ turn
                n, first, second = n + len(y), first + y.sum(axis=0), second + y.T @ y
        if n:
            yield _state(TaskContext.get().partitionId(), n, np.zeros(0, np.int64), np.concatenate([first, second.ravel()]))

    found = _combined(stored(rows.select("v").mapInArrow(run, STATE)), _merge_sums)
    numbers = np.array(found["floats"]) / found["n"]
    return numbers[:width], numbers[width:].reshape(width, width)


def fit(vectors: DataFrame, *, components: int = 32, scale: float = 64.0, offset: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """Components of all usable vectors; None without any."""
    rows = usable(vectors, id_col, vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if len(batch):
                x = _whole_numbers(batch["v"], scale, offset)
                own = own or Spectrum(x.shape[1])
                own.add(x, offset)
        if own:
            yield own.row(TaskContext.get().partitionId())

    found = _combined(stored(rows.select("v").mapInArrow(run, STATE)), _merge_spectra)
    if found is None:
        return None
    spectrum, n = Spectrum.of(found["n"], found["ints"], found["floats"]), found["n"]
    sums = [(int(h) << 32) + int(r) for h, r in spectrum.sums.T]
    fitted = Whitening(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64), np.zeros((0, 0)), np.zeros(0), 0.0)
    basis = np.linalg.qr(spectrum.vectors)[0]
    mean, second = _sums(rows, scale, offset, fitted, basis)
    covariance = second - np.outer(mean, mean)
    values, turn = np.linalg.eigh((covariance + covariance.T) / 2)
    keep = np.argsort(-values, kind="stable")[:components]
    fitted.components, fitted.variances, fitted.total = basis @ turn[:, keep], np.maximum(values[keep], 0.0), float(np.trace(covariance))
    scales = fitted.scales()
    varied = np.isfinite(scales)
    if varied.any():
        mean, second = _sums(rows, scale, offset, fitted, fitted.components[:, varied] * scales[varied])
        fitted.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(mean))).max())
    return fitted


def whiten(vectors: DataFrame, *, components: int = 32, scale: float = 64.0, offset: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable vector and component: ``id_col``, ``component`` (from 1, by falling variance), ``n`` (vectors fitted),
    ``deviation``, ``whitened``, ``explained`` (share of the variance) and ``identity_error`` of the whole table.
    """
    rows = usable(vectors, id_col, vector_col)
    schema = vectors.select(F.col(id_col)).schema.add("component", "integer").add("n", "long").add("deviation", "long")
    schema = schema.add("whitened", "double").add("explained", "double").add("identity_error", "double")
    fitted = fit(vectors, components=components, scale=scale, offset=offset, id_col=id_col, vector_col=vector_col)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    sent = Sent(vectors.sparkSession, fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit_ = sent.value
            x = _whole_numbers(batch["v"], scale, offset) if len(batch) else np.zeros((0, len(fit_.whole)), np.int64)
            white = fit_.centred(x) @ (fit_.components * fit_.scales())
            rows_, width = white.shape
            shares = fit_.variances / fit_.total if fit_.total > 0 else np.zeros(width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(np.repeat(np.arange(rows_), width))), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * width, fit_.n)), pa.array(fit_.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows_), width))),
                    pa.array(white.ravel(), from_pandas=True), pa.array(np.tile(shares, rows_)), pa.array(np.full(rows_ * width, fit_.identity_error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
