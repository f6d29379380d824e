"""Embedding whitening by a Jacobi-Davidson eigensolver whose only access to the data are distributed centred products.

``fit_whitening`` finds the leading eigenvectors of the covariance of a table of integer vectors without ever forming the
covariance: each step multiplies it with a narrow block, one Spark job over the stored points. All open pairs advance
together, so their correction equations share the products of one MINRES. ``whiten`` projects rows on the result.

Odd rows (``quantize``): vectors that are null, empty or hold null or non-finite entries are dropped; if lengths differ, the
most frequent one stays, the smaller of equally frequent ones. Null and repeated keys stay as they are; equal vectors count
once in the fit. Directions with less than ``LEAST`` of the leading variance have no component, so one single point, or
points that are all equal, give none, and an empty table gives no rows. Only the named columns are read. The driver holds
vectors and a basis of the vectors' length, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.session import cut_lineage

ROWS = 4096  # points of a stored block
LEAST = 1e-10
DIRECT = 64  # partial sums of so many tasks go straight to the driver; more are added up in between


def quantize(rows: DataFrame, key: str, vector: str, scale: float, shift: int) -> DataFrame:
    """``key, x``: each entry c as the integer floor(scale * c) + shift. Entries beyond 2^56 raise an overflow."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    named = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    usable = named.filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", entry))
    sizes = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return usable.filter(F.size("v") == d).select("key", F.transform("v", lambda c: F.floor(c * scale).cast("bigint") + shift).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equally long lists."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


class Points:
    """Distinct integer vectors, stored in blocks; their number and exact sums."""

    def __init__(self, rows: DataFrame):
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    part = _matrix(batch.column(0).slice(a, ROWS))
                    high = part >> 20  # sums of the halves stay far from the bounds of 64 bits
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([len(part)]),
                            pa.array([part.astype("<i8").tobytes()]),
                            pa.array([high.sum(axis=0).tolist()], pa.list_(pa.int64())),
                            pa.array([(part - (high << 20)).sum(axis=0).tolist()], pa.list_(pa.int64())),
                        ],
                        names=["n", "block", "high", "low"],
                    )

        distinct = rows.select("x").distinct()
        self.blocks = cut_lineage(distinct.mapInArrow(pack, "n bigint, block binary, high array<bigint>, low array<bigint>"))
        self.n = int(self.blocks.agg(F.sum("n")).collect()[0][0] or 0)
        exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
        sums = (
            self.blocks.select(F.posexplode(F.arrays_zip("high", "low")).alias("i", "s"))
            .select("i", "s.high", "s.low")
            .groupBy("i")
            .agg(exact("high"), exact("low"))
        )
        self.sums = [(int(r.high) << 20) + int(r.low) for r in sorted(sums.collect(), key=lambda r: r.i)]
        self.pivot = np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)
        self.rest = [s - self.n * int(p) for s, p in zip(self.sums, self.pivot)]  # S - n * pivot
        self.offset = np.array([float(Fraction(r, self.n)) for r in self.rest])
        self.parts = self.blocks.rdd.getNumPartitions()

    @property
    def d(self) -> int:
        return len(self.sums)

    def total(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """Sum over all blocks of ``of(centred block)``, an array of ``size`` doubles."""
        d, pivot, offset, lots = self.d, self.pivot, self.offset, DIRECT

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, lot = np.zeros(size), 0
            for batch in batches:
                for raw in batch.column(0):
                    part = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, d)
                    lot = (lot * 31 + int(part[0].sum())) % lots
                    out += np.asarray(of((part - pivot) - offset)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([lot]), pa.array([out.tobytes()])], names=["lot", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                for raw in batch.column(1):
                    out += np.frombuffer(raw.as_buffer(), np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([out.tobytes()])], names=["lot", "sums"])

        sums = self.blocks.select("block").mapInArrow(partial, "lot bigint, sums binary")
        if self.parts > lots:
            sums = sums.repartition(lots, "lot").mapInArrow(add, "lot bigint, sums binary")
        return np.sum([np.frombuffer(r.sums, np.float64) for r in sums.select("sums").collect()] or [np.zeros(size)], axis=0)

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times ``block``."""
        return self.total(lambda c: c.T @ (c @ block), block.size).reshape(block.shape) / self.n


@dataclass
class Whitening:
    """Components as columns, by falling variance; ``residuals`` are those of the eigenpairs, ``products`` the passes made."""

    points: Points
    variances: np.ndarray
    components: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float
    products: int
    locked: list[int] = field(default_factory=list)


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``block`` adds to ``against``."""
    out = np.zeros((block.shape[0], 0))
    for column in block.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            for basis in (against, out):
                column = column - basis @ (basis.T @ column)
        left = np.linalg.norm(column)
        if size > 0 and left > 1e-10 * size:
            column = column / left
            for basis in (against, out):
                column = column - basis @ (basis.T @ column)
            out = np.column_stack([out, column / np.linalg.norm(column)])
    return out


def minres(times: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, drop: float) -> np.ndarray:
    """Minimal residual solutions of symmetric systems, one a column, that share each product."""
    dot = lambda a, b: np.einsum("ij,ij->j", a, b)
    over = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    x, r = np.zeros_like(right), right.copy()
    aim = drop * np.linalg.norm(right, axis=0)
    p0 = r.copy()
    s0 = times(p0)
    p1, s1, p2, s2 = p0, s0, p0, s0
    for step in range(steps):
        p2, p1, s2, s1 = p1, p0, s1, s0
        a = over(dot(r, s1), dot(s1, s1))
        x, r = x + a * p1, r - a * s1
        if step == steps - 1 or (np.linalg.norm(r, axis=0) <= aim).all():
            break
        p0, s0 = s1, times(s1)
        b = over(dot(s0, s1), dot(s1, s1))
        p0, s0 = p0 - b * p1, s0 - b * s1
        if step:
            b = over(dot(s0, s2), dot(s2, s2))
            p0, s0 = p0 - b * p2, s0 - b * s2
    return x


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, inner: int = 4, drop: float = 0.05, widest: int = 160, rounds: int = 200, seed: int = 12):
    """The ``k`` leading eigenpairs of a symmetric operator: values, vectors, residuals, products, pairs locked by round.

    Block Jacobi-Davidson: Rayleigh-Ritz in a growing subspace, locking of pairs whose residual is at rounding level, and for
    the others expansion by MINRES solutions of the correction equations, projected off the locked and the current vectors.
    """
    passes = 0

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(block)

    k = min(k, d)
    locked, done, values, residuals, history = np.zeros((d, 0)), np.zeros((d, 0)), [], [], []
    wide = min(d, k + 2)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, wide)), locked)
    image = times(basis)
    for _ in range(rounds):
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        ritz, image_ritz = basis @ y, image @ y
        largest = max(abs(theta[0]) if len(theta) else 0.0, max(values, default=0.0))
        error = image_ritz - ritz * theta
        far = np.linalg.norm(error, axis=0)
        aim = 32 * np.finfo(float).eps * np.sqrt(d) * largest
        ready = 0
        while ready < len(theta) and len(values) + ready < k and far[ready] <= aim:
            ready += 1
        locked, done = np.column_stack([locked, ritz[:, :ready]]), np.column_stack([done, image_ritz[:, :ready]])
        values += theta[:ready].tolist()
        residuals += far[:ready].tolist()
        history.append(ready)
        if len(values) >= k:
            break
        theta, ritz, image_ritz, error, far = theta[ready:], ritz[:, ready:], image_ritz[:, ready:], error[:, ready:], far[ready:]
        open_ = min(len(theta), k - len(values))
        worst = [i for i in range(open_) if far[i] > aim] or [0]
        held = np.column_stack([locked, ritz[:, :open_]])
        off = lambda b: b - held @ (held.T @ b)
        shifts = theta[worst]
        step = minres(lambda b: off(times(b) - b * shifts), -off(error[:, worst]), inner, drop)
        if ritz.shape[1] + len(worst) > min(widest, d):  # start again from the best directions
            keep = min(ritz.shape[1], max(2 * (k - len(values)), open_))
            ritz, image_ritz = (ritz, image_ritz) if d <= widest else (ritz[:, :keep], image_ritz[:, :keep])
        new = _orthonormal(step, np.column_stack([locked, ritz]))
        if not new.shape[1]:
            new = _orthonormal(error[:, worst], np.column_stack([locked, ritz]))
        if not new.shape[1]:
            if ritz.shape[1] + locked.shape[1] < d:
                new = _orthonormal(np.random.default_rng(seed + passes).standard_normal((d, 1)), np.column_stack([locked, ritz]))
            else:  # the subspace is the whole space: take the images anew, which removes their old rounding
                basis = _orthonormal(ritz, locked)
                image = times(basis)
                continue
        basis, image = np.column_stack([ritz, new]), np.column_stack([image_ritz, times(new)])
        image = image - locked @ (locked.T @ image)
    else:
        raise ArithmeticError(f"{len(values)} of {k} eigenpairs after {rounds} rounds; open residuals {far[: k - len(values)]}")
    order = np.argsort(values)[::-1]
    return np.array(values)[order], locked[:, order], np.array(residuals)[order], passes, history


def fit_whitening(rows: DataFrame, k: int) -> Whitening | None:
    """Leading components of the distinct vectors of column ``x``; None without rows."""
    points = Points(rows)
    if not points.n:
        return None
    trace = float(points.total(lambda c: np.array([(c * c).sum()]), 1)[0]) / points.n
    if trace == 0:
        return Whitening(points, np.zeros(0), np.zeros((points.d, 0)), 0.0, np.zeros(0), 0.0, 0)
    values, vectors, residuals, passes, history = leading_pairs(points.product, points.d, k)
    keep = values > LEAST * values[0]
    values, vectors, residuals = values[keep], vectors[:, keep], residuals[keep]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    width = len(values)
    scaled = vectors / np.sqrt(values)

    def moments(c: np.ndarray) -> np.ndarray:
        white = c @ scaled
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    found = points.total(moments, width + width * width) / points.n
    mean = found[:width]
    covariance = found[width:].reshape(width, width) - np.outer(mean, mean)
    return Whitening(points, values, vectors, trace, residuals, float(np.abs(covariance - np.eye(width)).max()), passes, history)


def whiten(rows: DataFrame, fit: Whitening) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for each row ``key, x`` and component.

    ``deviation`` is the exact sum over dimensions of (n * x - S)^2; one that does not fit 64 bits raises an error.
    """
    kind = dict(rows.dtypes)["key"]
    n, pivot, rest, offset = fit.points.n, fit.points.pivot, np.array(fit.points.rest, dtype=object), fit.points.offset
    scaled, width = fit.components / np.sqrt(fit.variances), len(fit.variances)
    explained = fit.variances / fit.trace if width else np.zeros(0)
    error, most = fit.identity_error, float(np.iinfo(np.int64).max)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows if width else 0, ROWS):
                part = batch.slice(a, ROWS)
                centred = _matrix(part.column(1)) - pivot
                if len(pivot) * (n * (np.abs(centred).max() + 1.0)) ** 2 < most / 2:
                    deviation = ((n * centred - rest.astype(np.int64)) ** 2).sum(axis=1)
                else:
                    exact = ((n * centred.astype(object) - rest) ** 2).sum(axis=1)
                    if max(exact) > most:
                        raise OverflowError("a deviation is beyond 64 bits")
                    deviation = exact.astype(np.int64)
                count = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(count), width))),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * width, n)),
                        pa.array(np.repeat(deviation, width)),
                        pa.array(((centred - offset) @ scaled).ravel()),
                        pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * width, error)),
                    ],
                    names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("key", "x").mapInArrow(run, f"key {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
