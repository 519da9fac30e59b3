"""Whitening of embeddings from polarised covariances.

Components become integers x = floor(64 * c) + 1000000. The fit list has each different x vector once.

1. One pass sums the fit list per dimension: n and S, exact longs.
2. Values are centred, y = x - floor(S / n), and one pass sums exact squares: of y for every dimension, of y_i + y_j for every
   pair of dimensions. No product of two different dimensions is ever formed.
3. With T = S - n * floor(S / n) the exact variance of a sum of dimensions is (n * squares - T**2) / n**2, and
   covariance = (variance of the sum - both variances) / 2. Python integers on the driver keep that exact up to the
   division; numpy's ``eigh`` gives the components. The driver holds ``d * (d + 1) / 2`` numbers, whatever the number of rows.
4. Rows are projected where they stand, and a last pass over the fit list gives the covariance of the whitened values
   (products in 2**-30, summed as integers, so the figure does not depend on partitions).

Equal vectors meet in a map-side aggregate, so a vector that a third of the rows hold costs a row per task.

Defined cases: vectors that are null or hold null or non-finite components are dropped. The dimension is the length that most kept
rows have (of several the least); rows of another length come back with null figures. Null ids and repeated rows are rows
like any other. x is kept within +-2**40. A component whose eigenvalue is not above ``FLAT`` of the largest has no direction: its
``whitened`` is null, ``explained`` stays, and it is left out of ``identity_error`` (null if none is left). Where vectors
have fewer dimensions than ``COMPONENTS`` there are as many components. ``deviation`` beyond a long is null. An empty
table, or one of empty vectors, gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import saved
from tracewright.llm.vectors import common_dimension, floored, matrix, usable

SCALE, SHIFT = 64, 1_000_000
LIMIT = 1 << 40
COMPONENTS = 16
FLAT = 1e-12
STEP = 1 << 12         # vectors handled at a time inside a batch
UNIT = 1 << 30         # products of whitened values are summed in this fraction
_MOST = (1 << 63) - 1


def _x(column: pa.Array, d: int) -> np.ndarray:
    return floored(matrix(column, d), SCALE, LIMIT) + SHIFT


def _keys(d: int):
    """Vectors to the bytes of their x."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = 8 * d
        for b in batches:
            for lo in range(0, b.num_rows, STEP):
                x = _x(b.column(0).slice(lo, STEP), d)
                raw = x.astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([raw[i * w:i * w + w] for i in range(len(x))], pa.binary())], ["x"])
    return emit


def _fit_steps(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for b in batches:
        for lo in range(0, b.num_rows, STEP):
            yield np.frombuffer(b"".join(b.column(0).slice(lo, STEP).to_pylist()), dtype="<i8").reshape(-1, d)


def _wide(x: np.ndarray, squares: bool = False) -> np.ndarray:
    """As Python integers where sums over a step could leave 64 bits."""
    most = int(np.abs(x).max(initial=0))
    return x.astype(object) if (4 * most * most if squares else most) * STEP >= 1 << 62 else x


def _figures(values: dict[tuple[int, int], int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in values], pa.int32()), pa.array([j for _, j in values], pa.int32()),
                                       pa.array(list(values.values()), pa.decimal128(38, 0))], ["i", "j", "v"])


def _sums(d: int):
    """Per task the sum of each dimension, as (i, -1), and the number of vectors, as (-1, -1)."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, dtype=object)
        for x in _fit_steps(batches, d):
            n += len(x)
            total = total + _wide(x).sum(0).astype(object)
        if n:
            yield _figures({(-1, -1): n} | {(i, -1): int(v) for i, v in enumerate(total)})
    return emit


def _squares(centre: np.ndarray):
    """Per task the sum of squares of each centred dimension, as (i, i), and of each sum of two, as (i, j)."""
    d = len(centre)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(d - i, dtype=object) for i in range(d)]
        some = False
        for x in _fit_steps(batches, d):
            y = _wide(np.ascontiguousarray((x - centre).T), squares=True)
            some = True
            for i in range(d):
                pair = y[i:] + y[i] if i + 1 < d else y[i:].copy()
                pair[0] = y[i]
                total[i] = total[i] + (pair * pair).sum(1).astype(object)
        if some:
            yield _figures({(i, i + k): int(v) for i in range(d) for k, v in enumerate(total[i])})
    return emit


def _project(y: np.ndarray, rest: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Whitened values of centred integers; ``rest`` is what the integer centre leaves of the mean."""
    return (y.astype(np.float64) - rest) @ axes


def _products(centre: np.ndarray, rest: np.ndarray, axes: np.ndarray):
    d, k = axes.shape

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for x in _fit_steps(batches, d):
            w = _project(x - centre, rest, axes)
            for a in range(k):
                p = np.rint(w[:, a:a + 1] * w[:, a:] * UNIT).astype(np.int64).astype(object).sum(0)
                for j, v in enumerate(p):
                    total[a, a + j] = total.get((a, a + j), 0) + int(v)
                total[a, -1] = total.get((a, -1), 0) + int(np.rint(w[:, a] * UNIT).astype(np.int64).astype(object).sum())
        if total:
            yield _figures(total)
    return emit


def _added(fit: DataFrame, task) -> dict[tuple[int, int], int]:
    """Figures of all tasks added up: at most d * (d + 1) / 2 of them, or d + 1, reach the driver."""
    got = fit.mapInArrow(task, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()
    return {(r["i"], r["j"]): int(r["v"]) for r in got}


def covariance(n: int, t: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances from sums of squares of dimensions and of sums of two dimensions, exact up to the last division."""
    d = len(t)
    var = [n * squares[i, i] - t[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = float(Fraction(var[i], n * n))
        for j in range(i + 1, d):
            both = n * squares[i, j] - (t[i] + t[j]) ** 2
            out[i, j] = out[j, i] = float(Fraction(both - var[i] - var[j], 2 * n * n))
    return out


def _rows(d: int, n: int, centre: np.ndarray, t: list[int], axes: np.ndarray, explained: list[float | None], live: int, error: float | None):
    rest = np.array([float(Fraction(v, n)) for v in t])
    k = len(explained)
    figures = [pa.field("component", pa.int32()), pa.field("n", pa.int64()), pa.field("deviation", pa.int64()), pa.field("whitened", pa.float64()),
               pa.field("explained", pa.float64()), pa.field("identity_error", pa.float64())]
    at = np.array(t, dtype=object)

    def deviations(y: np.ndarray) -> list[int | None]:
        most = n * int(np.abs(y).max(initial=0)) + max(map(abs, t), default=0)
        z = y * n - at.astype(np.int64) if most * most * d < 1 << 63 else y.astype(object) * n - at
        return [v if v <= _MOST else None for v in map(int, (z * z).sum(1))]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            schema = pa.schema([b.schema.field(0), *figures])
            for lo in range(0, b.num_rows, STEP):
                s = b.slice(lo, STEP)
                mine = s.column(1).value_lengths().to_numpy(zero_copy_only=False) == d
                y = _x(s.column(1).filter(pa.array(mine)), d) - centre
                w = np.full((s.num_rows, k), np.nan)
                w[mine, :live] = _project(y, rest, axes)
                known = np.zeros((s.num_rows, k), dtype=bool)
                known[mine, :live] = True
                dev = np.full(s.num_rows, None, dtype=object)
                dev[mine] = deviations(y)
                each = np.repeat(np.arange(s.num_rows), k)
                fits = np.repeat(mine, k)
                yield pa.RecordBatch.from_arrays([
                    s.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), s.num_rows), pa.int32()), pa.array(np.full(len(each), n), pa.int64()),
                    pa.array(dev.tolist(), pa.int64()).take(pa.array(each)), pa.array(w.ravel(), pa.float64(), mask=~known.ravel()),
                    pa.array(explained * s.num_rows, pa.float64(), mask=~fits | np.array([v is None for v in explained] * s.num_rows, dtype=bool)),
                    pa.array([error] * len(each), pa.float64())], schema=schema)
    return emit


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each kept row and component."""
    kept = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("v")).where(usable(F.col("v")))
    ident = kept.schema["id"].dataType.simpleString()
    schema = f"id {ident}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    d = common_dimension(kept, F.col("v"))
    if not d:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    fit = saved(kept.where(F.size("v") == d).select("v").mapInArrow(_keys(d), "x binary").distinct(), "fit-list")
    sums = _added(fit, _sums(d))
    n, s = sums[-1, -1], [sums[i, -1] for i in range(d)]
    centre, t = [v // n for v in s], [v % n for v in s]
    middle = np.array(centre, dtype=np.int64)
    v = covariance(n, t, _added(fit, _squares(middle)))
    value, vector = np.linalg.eigh(v)
    k = min(components, d)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    live = int((value > FLAT * max(value[0], 0.0)).sum()) if value[0] > 0 else 0
    axes = vector[:, :live] / np.sqrt(value[:live])
    trace = float(np.trace(v))
    explained = [float(max(e, 0.0) / trace) if trace > 0 else None for e in value]
    error = None
    if live:
        got = _added(fit, _products(middle, np.array([float(Fraction(x, n)) for x in t]), axes))
        mean = [Fraction(got[a, -1], UNIT * n) for a in range(live)]
        error = max(abs(float(Fraction(got[a, b], UNIT * n) - mean[a] * mean[b]) - (a == b)) for a in range(live) for b in range(a, live))
    return kept.mapInArrow(_rows(d, n, middle, t, axes, explained, live, error), schema).withColumnRenamed("id", id_col)
