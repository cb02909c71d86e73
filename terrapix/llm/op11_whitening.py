"""11. Embedding whitening: Chebyshev-filtered subspace iteration.

Entries become whole numbers, x = floor(64 * c) + 1000000; the *fit list* is each
distinct x vector once (n vectors, per-dimension sums S).  The leading
eigenvectors of its covariance V are found without ever forming V: a pass over
the written fit list sends a block Q of ``k`` columns to the tasks, each returns
its part of (X - S/n)^T ((X - S/n) Q), and the parts are added.

1. A Rayleigh-Ritz step on the block gives Ritz pairs and their residuals.
2. The eigenvalues not wanted lie in [0, c], c the block's smallest Ritz value
   (V has no negative ones).  The Chebyshev polynomial of that interval, applied
   by its three-term recurrence (one pass a degree), damps them and blows up the
   rest; QR makes the block orthonormal again.
3. Until every wanted pair is certified: its residual |Vq - eq|, which bounds the
   distance to a true eigenvalue, is at most ``TOLERANCE`` of the largest
   eigenvalue and no longer falls.  A block that does not get there is widened;
   at the full dimension Rayleigh-Ritz is the whole problem and exact.

Values are centred before they are multiplied, without loss: with m = round(S/n)
and r = S - n*m, x - S/n = (x - m) - r/n.

Sizes: the driver and the tasks hold blocks of dimension x k numbers; the parts
are added in groups by Spark when there are more than ``PARTS`` files.  Copies of
a vector meet in the map-side part of ``distinct``, so a hot vector is one row.
The fit list is written below ``spark.checkpoint.dir``; sums are added in the
order of its files, so equal files give equal results.

Defined cases: rows whose vector is null, empty or holds a null or non-finite
entry are dropped; so are rows whose vector has another length than the most
frequent one (ties: the longest).  x is kept within +-2**62 and ``deviation`` is
null where it exceeds a long.  Repeated rows and null ids keep their rows.
Directions without variance (below rounding) are no components: fewer than
``components`` rows come out, none for an empty table or a single distinct
vector.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrapix.llm.store import written
from terrapix.llm.worker import release, small_batches

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
#: guard vectors a component; growth of a filter; highest degree; outer steps before the block is widened
GUARD, FILTER_GROWTH, MAX_DEGREE, OUTER = 2, 1e10, 24, 40
TOLERANCE, SEED = 1e-12, 11
#: parts that the driver adds itself; more are added in groups before
PARTS = 256
_LIMIT = 1 << 62
#: numbers of a batch that are handled at once
_CELLS = 1 << 20


def quantised(vector: Column) -> Column:
    """floor(64 * c) + 1000000 of every entry, as array<bigint>."""
    x = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(_LIMIT - SHIFT))), F.lit(float(SHIFT - _LIMIT)))))
    return F.transform(x, lambda v: v + F.lit(SHIFT).cast("bigint"))


def usable(vector: Column) -> Column:
    """The vector is there and all its entries are finite numbers."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


@dataclass
class Whitening:
    """The fitted transform: ``n`` vectors of the fit list, their sums, the
    components as columns with their eigenvalues, and how they were certified."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float = 0.0
    passes: int = 0
    identity_error: float = 0.0
    residuals: list[float] = field(default_factory=list)

    @property
    def dimension(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else self.values


class _Centre:
    """x - S/n of blocks of whole numbers, without cancellation."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.middle = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = [s - n * m for s, m in zip(sums, self.middle)]
        self._m = np.array(self.middle, np.int64)
        self._r = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self._m).astype(np.float64) - self._r

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n*x - S)**2, exact; null beyond a long."""
        d = x - self._m
        if float(np.abs(d).max(initial=0) + 1) ** 2 * float(self.n) ** 2 * max(1, x.shape[1]) < 2.0 ** 62:
            y = d * self.n - np.array(self.rest, np.int64)
            return (y * y).sum(axis=1).tolist()
        sums = (sum((self.n * int(v) - r) ** 2 for v, r in zip(row, self.rest)) for row in d.tolist())
        return [s if s < 1 << 63 else None for s in sums]


def _blocks(batches, column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of equally long lists as matrices, a few million numbers at a time."""
    for b in batches:
        at = 0
        while at < b.num_rows:
            width = max(1, len(b.column(column)[at].values))
            part = b.slice(at, max(1, _CELLS // width))
            at += part.num_rows
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


_PART = "part int, block binary"


def _summed(parts: DataFrame, files: int, shape: tuple[int, ...], kind) -> np.ndarray:
    """The sum of the tasks' blocks, in the order of their numbers."""
    if files > PARTS:
        def add(table: pa.Table) -> pa.Table:
            table = table.sort_by("part")
            total = sum(np.frombuffer(v.as_py(), kind) for v in table.column("block"))
            return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "block": pa.array([total.tobytes()], pa.binary())})
        parts = parts.groupBy(F.expr(f"part div {PARTS}").alias("grp")).applyInArrow(add, _PART)
    rows = sorted((r["part"], bytes(r["block"])) for r in parts.collect())
    total = np.zeros(shape, kind)
    for _, block in rows:
        total = total + np.frombuffer(block, kind).reshape(shape)
    return total


class _FitList:
    """The written distinct vectors and the passes over them."""

    def __init__(self, spark: SparkSession, x: DataFrame):
        small_batches(spark)
        lengths = x.groupBy(F.size("x").alias("size")).count().orderBy(F.col("count").desc(), F.col("size").desc()).limit(1).collect()
        self.dimension = lengths[0]["size"] if lengths else 0
        self.rows = written(x.filter(F.size("x") == self.dimension).select("x").distinct(), "whitening-fit")
        self.files = len(self.rows.inputFiles()) if self.dimension else 0
        self.passes = 0

    def _pass(self, work, shape: tuple[int, ...], kind=np.float64) -> np.ndarray:
        """Sum over the tasks of ``work(matrix)``."""
        from pyspark import TaskContext

        def run(batches):
            release()
            total = np.zeros(shape, kind)
            for _, x in _blocks(batches):
                total += work(x)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "block"])
        self.passes += 1
        return _summed(self.rows.mapInArrow(run, _PART), self.files, shape, kind)

    def totals(self) -> tuple[int, list[int]]:
        """n and the exact sums, as sums of high and low halves."""
        d = self.dimension

        def work(x: np.ndarray) -> np.ndarray:
            return np.concatenate([[len(x)], (x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0)])
        out = self._pass(work, (2 * d + 1,), np.int64).tolist()
        return out[0], [(h << 31) + low for h, low in zip(out[1:d + 1], out[d + 1:])]

    def trace(self, centre: _Centre) -> float:
        def work(x: np.ndarray) -> np.ndarray:
            return np.square(centre(x)).sum(axis=0)
        return float(self._pass(work, (self.dimension,)).sum() / centre.n)

    def times(self, q: np.ndarray, centre: _Centre) -> np.ndarray:
        """V q, one pass."""
        def work(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            return c.T @ (c @ q)
        return self._pass(work, q.shape) / centre.n

    def covariance(self, projection: np.ndarray, centre: _Centre) -> np.ndarray:
        """The covariance of the projected list."""
        k = projection.shape[1]

        def work(x: np.ndarray) -> np.ndarray:
            w = centre(x) @ projection
            return w.T @ w
        return self._pass(work, (k, k)) / centre.n


def _rayleigh_ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), the rotated block and its image."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def _degree(largest: float, cut: float) -> int:
    """The degree at which the filter's growth reaches ``FILTER_GROWTH``."""
    x = max(2.0 * largest / cut - 1.0, 1.0 + 1e-9)
    return int(np.clip(np.log(2 * FILTER_GROWTH) / np.arccosh(x), 2, MAX_DEGREE))


def _filtered(fit: _FitList, centre: _Centre, q: np.ndarray, vq: np.ndarray, cut: float, largest: float) -> np.ndarray:
    """The Chebyshev polynomial of [0, cut] applied to the block; ``vq`` = V q
    saves the first pass.  Scaled by its size at ``largest`` on the way."""
    half = cut / 2
    sigma = half / (largest - half)
    first = sigma
    before, y = q, (vq - half * q) * (sigma / half)
    for _ in range(2, _degree(largest, cut) + 1):
        following = 1.0 / (2.0 / first - sigma)
        before, y = y, (fit.times(y, centre) - half * y) * (2 * following / half) - sigma * following * before
        sigma = following
    return y


def _subspace(fit: _FitList, centre: _Centre, wanted: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """The ``wanted`` leading eigenpairs of the covariance and the residuals of the steps."""
    d, rng, history = fit.dimension, np.random.default_rng(SEED), []
    k = min(d, GUARD * wanted)
    q = np.linalg.qr(rng.standard_normal((d, k)))[0]
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    while True:
        for step in range(OUTER):
            values, q, vq = _rayleigh_ritz(q, fit.times(q, centre))
            largest = max(values[0], 0.0)
            error = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()) / largest if largest else 0.0
            fell = best is None or error < 0.5 * best[0]
            if best is None or error < best[0]:
                best = (error, values[:wanted].copy(), q[:, :wanted].copy())
            history.append(error)
            if k == d or (best[0] <= TOLERANCE and not fell) or largest == 0.0:
                return best[1], best[2], history
            cut = max(float(values[-1]), 1e-12 * largest)
            q = np.linalg.qr(_filtered(fit, centre, q, vq, cut, largest))[0]
        wider = min(d, 2 * k)
        q = np.linalg.qr(np.column_stack([q, rng.standard_normal((d, wider - k))]))[0]
        k = wider


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on the distinct vectors of column ``x`` (see ``quantised``)."""
    listed = _FitList(x.sparkSession, x.select("x"))
    nothing = Whitening(0, [], np.zeros((listed.dimension, 0)), np.zeros(0), 0.0)
    if not listed.dimension:
        return nothing
    n, sums = listed.totals()
    centre = _Centre(n, sums)
    trace = listed.trace(centre)
    wanted = min(components, listed.dimension)
    if trace == 0.0:
        return Whitening(n, sums, np.zeros((listed.dimension, 0)), np.zeros(0), 0.0, passes=listed.passes)
    values, vectors, history = _subspace(listed, centre, wanted)
    kept = values > values[0] * listed.dimension * np.finfo(float).eps * 16
    values, vectors = values[kept], vectors[:, kept]
    covariance = listed.covariance(vectors / np.sqrt(values), centre)
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return Whitening(n, sums, vectors, values, trace, min(history), listed.passes, error, history)


def scaled(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the usable rows."""
    v = F.col(vector_col)
    return df.filter(usable(v)).select(F.col(id_col).alias("vec_id"), quantised(v).alias("x"))


def transform(x: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    a row for each vector of ``scaled`` and component."""
    spark = x.sparkSession
    small_batches(spark)
    id_type = x.schema["vec_id"].dataType
    schema = T.StructType([
        T.StructField("vec_id", id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], schema)
    centre, projection, explained = _Centre(model.n, model.sums), model.vectors / np.sqrt(model.values), model.explained
    n, error, width = model.n, model.identity_error, model.dimension

    def run(batches):
        release()
        for b, m in _blocks(batches, 1):
            rows = b.num_rows
            white = centre(m) @ projection
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)),
                pa.array(centre.deviations(m), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(white.ravel()),
                pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return x.filter(F.size("x") == width).select("vec_id", "x").mapInArrow(run, schema)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on the table's distinct vectors and transform all its usable rows."""
    x = scaled(df, id_col, vector_col)
    return transform(x, fit(x, components))
