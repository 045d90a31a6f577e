"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become integer vectors x = floor(scale * c) + shift and are written once.  With n of
them, their covariance V is never formed: every pass over the written table applies it to a
block Q of at most ``components + guard`` columns, as the sum over all rows of
(x - mean) (x - mean)^T Q / n, centred before the product.  A cycle runs a Chebyshev recurrence
of ``degree`` such passes, which damps the spectrum between a lower bound (Lanczos steps of one
more vector in the first cycle's passes) and the block's least Ritz value, then QR and
Rayleigh-Ritz.  Cycles end when the residual |V u - e u| of every wanted component is
certified to be at the level of double rounding.

A task returns one partial sum per entry of the block, added up by a grouped sum, so what
reaches the driver is bounded by dimension x block, whatever the number of rows or tasks.
Sums S, deviations and the trace are exact integers.

Edge cases: vectors that are null, empty, or hold a null or non-finite entry are dropped, and
so are vectors of another length than the most frequent one (the larger of two); entries are
held within +-2^53 after scaling; ids may be null or repeat, every row counts; a deviation
beyond a long is null; components without variance (below rounding of the greatest one) have
no whitened value and are left out, so a table of equal vectors, one row or none gives no
components; extra columns are not read.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage

COMPONENTS, GUARD, DEGREE, CYCLES = 32, 16, 12, 100
SCALE, SHIFT, BOUND = 64.0, 1_000_000, float(1 << 53)
#: Residuals over the greatest eigenvalue: wanted, and still accepted where rounding ends progress.
TOLERANCE, ROUNDING = 1e-14, 1e-11


@dataclass(frozen=True)
class Whitening:
    """``vectors`` (dimension x components, unit columns), ``values`` (eigenvalues, falling), the
    exact sums as ``base`` * n + ``rest`` per dimension, the trace, and how the fit ended."""
    n: int
    base: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    passes: int
    cycles: int
    identity_error: float


def integer_vectors(table: DataFrame, vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, size, x): the rows that count, written once."""
    e = F.col(column)
    bad = F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    x = F.transform(e, lambda c: F.floor(F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), F.lit(SCALE) * c.cast("double"))))
                    .cast("long") + SHIFT)
    rows = table.select(F.col(vec_id).alias("vec_id"), e.alias(column)).where(e.isNotNull() & (F.size(e) > 0) & ~bad)
    return stage(rows.select("vec_id", F.size(column).alias("size"), x.alias("x")), "vectors")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, size)


def dimension_sums(vectors: DataFrame, size: int) -> list[int]:
    """Exact sum of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * size
        for batch in batches:
            m = _matrix(batch.column(0), size)
            if len(m):
                # halves of 32 bits, so that no batch's sum leaves a long
                high, low = m >> 32, m & 0xFFFFFFFF
                total = [t + (int(a) << 32) + int(b) for t, a, b in zip(total, high.sum(axis=0), low.sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()),
                                          pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "total"])

    rows = vectors.select("x").mapInArrow(run, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("s"))
    found = {r.i: int(r.s) for r in rows.collect()}
    return [found[i] for i in range(size)]


def summed(vectors: DataFrame, base: np.ndarray, rest: np.ndarray, n: int, block: np.ndarray,
           part: Callable[[np.ndarray, np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum over the table of ``part(centred rows, block)``, a matrix of ``shape``: one pass."""
    shared = vectors.sparkSession.sparkContext.broadcast((base, rest / n, block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, fraction, q = shared.value
        total = np.zeros(shape)
        for batch in batches:
            total += part((_matrix(batch.column(0), len(low)) - low) - fraction, q)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
                                         ["cell", "part"])

    cells = (vectors.select("x").mapInArrow(run, "cell int, part double").groupBy("cell")
             .agg(F.sum("part").alias("v")).toArrow())
    shared.destroy()
    out = np.zeros(shape)
    out.ravel()[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    return out


def chebyshev(apply: Callable[[np.ndarray], np.ndarray], x: np.ndarray, vx: np.ndarray, top: float, low: float,
              cut: float, degree: int) -> np.ndarray:
    """Filtered block: the recurrence of ``degree`` that stays small on [``low``, ``cut``] and grows
    above, scaled at ``top``; ``vx`` is the product of the operator with ``x``."""
    half, centre = (cut - low) / 2, (cut + low) / 2
    scale = half / (top - centre)
    first = scale
    y = (vx - centre * x) * (scale / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        x, y = y, (apply(y) - centre * y) * (2 * after / half) - scale * after * x
        scale = after
    return y


class LeastValue:
    """Lanczos steps of one vector that rides along with a block's passes, for a lower bound of
    the spectrum.  A bound that is a little too high costs passes, not correctness."""

    def __init__(self, size: int, steps: int):
        start = np.random.default_rng(1).standard_normal(size)
        self.basis, self.steps = [start / np.linalg.norm(start)], min(steps, size)
        self.diagonal: list[float] = []
        self.beside: list[float] = []

    def open(self) -> bool:
        return len(self.diagonal) < self.steps

    def step(self, product: np.ndarray) -> None:
        own = np.array(self.basis)
        self.diagonal.append(float(product @ own[-1]))
        for _ in range(2):
            product = product - own.T @ (own @ product)
        norm = float(np.linalg.norm(product))
        self.beside.append(norm)
        if norm <= 1e-12 * max(self.diagonal):
            self.steps = len(self.diagonal)
        else:
            self.basis.append(product / norm)

    def bound(self) -> float:
        if not self.diagonal:
            return 0.0
        off = self.beside[:len(self.diagonal) - 1]
        values, turn = np.linalg.eigh(np.diag(self.diagonal) + np.diag(off, 1) + np.diag(off, -1))
        return max(0.0, float(values[0] - self.beside[-1] * abs(turn[-1, 0])))


def fit(vectors: DataFrame, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE,
        cycles: int = CYCLES) -> Whitening | None:
    """Fit over all rows of ``integer_vectors`` of one size; None without rows."""
    sizes = vectors.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return None
    size, n = sizes[0]["size"], sizes[0]["count"]
    vectors = vectors.where(F.col("size") == size)
    sums = dimension_sums(vectors, size)
    base, rest = (np.array(v, np.int64) for v in zip(*(divmod(s, n) for s in sums)))
    trace = summed(vectors, base, rest, n, base[:0], lambda c, _: np.einsum("ij,ij->j", c, c)[None], (1, size)).sum() / n
    passes, least = 0, LeastValue(size, degree)

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        ride = least.open()
        if ride:
            q = np.column_stack((q, least.basis[-1]))
        vq = summed(vectors, base, rest, n, q, lambda c, q: c.T @ (c @ q), q.shape) / n
        if ride:
            least.step(vq[:, -1])
            vq = vq[:, :-1]
        return vq

    wanted, width = min(components, size), min(components + guard, size)
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((size, width)))[0]
    before = np.inf
    for cycle in range(1, cycles + 1):
        vq = apply(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        if top == 0.0:
            residual = 0.0
            break
        residual = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / top)
        if residual <= TOLERANCE or (residual <= ROUNDING and residual > before / 2):
            break
        before = residual
        cut = min(max(values[-1], 1e-6 * top), 0.999 * top)
        # the rider's bound holds once it has made its steps, which the first cycle's passes are
        low = 0.0 if least.open() else min(least.bound(), 0.9 * cut)
        q = np.linalg.qr(chebyshev(apply, q, vq, top, low, cut, degree))[0]
    else:
        raise RuntimeError(f"components not certified after {cycles} cycles (residual {residual:.1e})")
    values = values[:wanted]
    alive = values > size * np.finfo(float).eps * max(top, 1e-300)
    values, q = values[alive], q[:, :wanted][:, alive]
    error = 0.0
    if len(values):
        w = q / np.sqrt(values)
        moment = summed(vectors, base, rest, n, w, lambda c, w: (c @ w).T @ (c @ w), (len(values), len(values))) / n
        error = float(np.abs(moment - np.eye(len(values))).max())
    return Whitening(n, base, rest, q, values, float(trace), residual, passes, cycle, error)


def deviations(m: np.ndarray, base: np.ndarray, rest: np.ndarray, n: int) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2 for every row; null beyond a long."""
    gap = m - base
    most = int(np.abs(gap).max(initial=0)) * n + n
    if most < 1 << 31 and most * most * m.shape[1] < 1 << 63:
        scaled = gap * n - rest
        return np.einsum("ij,ij->i", scaled, scaled).tolist()
    exact = [sum((int(g) * n - int(r)) ** 2 for g, r in zip(row, rest)) for row in gap]
    return [v if v < 1 << 63 else None for v in exact]


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array): one row per fitted vector, in one pass."""
    size = len(model.base)
    shared = vectors.sparkSession.sparkContext.broadcast(
        (model.n, model.base, model.rest, model.vectors / np.sqrt(model.values)))
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, base, rest, w = shared.value
        for batch in batches:
            m = _matrix(batch.column(1), size)
            out = (((m - base) - rest / n) @ w).ravel()
            ends = np.arange(len(m) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviations(m, base, rest, n), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(out))], [f.name for f in schema])

    return vectors.where(F.col("size") == size).select("vec_id", "x").mapInArrow(run, schema)


def whitened_components(table: DataFrame, vec_id: str = "vec_id", column: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """One row per counted vector and component: ``vec_id``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    vectors = integer_vectors(table, vec_id, column)
    model = fit(vectors, components)
    if model is None or not len(model.values):
        return table.sparkSession.createDataFrame([], T.StructType([
            vectors.schema["vec_id"], *T._parse_datatype_string(
                "component int, n long, deviation long, whitened double, explained double, identity_error double")]))
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    rows = whitened(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                       "deviation", "whitened", F.get(share, F.col("at")).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))
