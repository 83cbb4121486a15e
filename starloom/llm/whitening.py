"""Whitening of embeddings by their principal components.

Two passes of partial sums give the covariance; the driver gets a number per
pair of dimensions. Points are fixed-point vectors, so the sums are integers and
exact: they depend neither on the partitioning nor on the order of rows. The
eigenvectors come from a float32 solver and are corrected by the iterations of
Ogita and Aishima: each is a few matrix products in a higher precision and
doubles the number of right digits. Eigenvalues too close for a division by
their difference form a cluster, whose subspace is solved as a small problem of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed-point entries below this size; larger ones count as not finite.
LARGEST = float(2**61)
EXACT = 2**53
LIMB_BITS = 20
SUM_BITS = 60
SLICE_CELLS = 1 << 21
ROUNDS = 24
_SUMS = "i int, j int, high decimal(38,0), low decimal(38,0)"


@dataclass(frozen=True)
class Model:
    """A fit: ``n`` vectors, exact ``sums`` per dimension, ``components`` (a column each) by falling ``eigenvalues``.

    ``centre`` is the mean rounded to integers and ``rest`` what is left of the mean.
    """

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


#: The model of an empty table.
NO_VECTORS = Model(0, [], np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0)


def fixed_point(rows: DataFrame, vector: str, scale: int = 64, offset: int = 0, into: str = "point") -> DataFrame:
    """Add ``into``: ``floor(scale * entry) + offset`` as longs.

    Rows go whose vector is null or empty, holds a null, a NaN, an infinity or an
    entry of 2**61 / ``scale`` or more, or is not of the usual width: the most
    frequent one among the rows left, and of several the greatest.
    """
    scaled = F.transform(F.col(vector), lambda c: c.cast("double") * F.lit(float(scale)))
    sound = rows.where(F.size(vector) > 0).where(F.forall(scaled, lambda c: c.isNotNull() & (F.abs(c) < F.lit(LARGEST))))
    width = sound.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return sound.where(F.size(vector) == (width["d"] if width else 0)).withColumn(
        into, F.transform(scaled, lambda c: F.floor(c).cast("long") + F.lit(offset).cast("long"))
    )


def matrices(column: pa.Array) -> Iterator[np.ndarray]:
    """A list column of one width as matrices of a bounded size."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = len(flat) // n if n else 0
    rows = max(1, SLICE_CELLS // max(1, width))
    for a in range(0, n, rows):
        yield flat[a * width : min(n, a + rows) * width].reshape(-1, width)


def product_sums(z: np.ndarray) -> np.ndarray:
    """Exact ``z.T @ z`` of a long matrix, as Python integers where a long may be too small."""
    top = int(np.abs(z).max(initial=0))
    if top * top * max(1, len(z)) < EXACT:
        y = z.astype(np.float64)
        return (y.T @ y).astype(np.int64)
    step = max(1, EXACT >> (2 * LIMB_BITS))  # rows whose limb products are exact in float64
    limbs = range(0, max(1, top.bit_length()), LIMB_BITS)
    sign, size = np.sign(z), np.abs(z)
    parts = [(sign * (size >> k & ((1 << LIMB_BITS) - 1))).astype(np.float64) for k in limbs]
    total = np.zeros((z.shape[1], z.shape[1]), dtype=object)
    for a in range(0, len(z), step):
        for k, x in zip(limbs, parts):
            for m, y in zip(limbs, parts):
                total += (x[a : a + step].T @ y[a : a + step]).astype(np.int64).astype(object) << (k + m)
    return total


class _Total:
    """A matrix of exact sums; longs while they fit."""

    def __init__(self):
        self.small = self.large = None
        self.bound = 0

    def add(self, x: np.ndarray, bound: int) -> None:
        if x.dtype == object or self.bound + bound >= 2**62:
            self._flush()
        if x.dtype == object:
            self.large = x if self.large is None else self.large + x
        else:
            self.small = x if self.small is None else self.small + x
            self.bound += bound

    def _flush(self) -> None:
        if self.small is not None:
            exact = self.small.astype(object)
            self.large = exact if self.large is None else self.large + exact
        self.small, self.bound = None, 0

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row per entry up to the diagonal (all, of a single row); values in two parts, so that no sum over tasks leaves 38 digits."""
        self._flush()
        if self.large is None:
            return
        for i, entries in enumerate(self.large):
            values = [int(v) for v in (entries if len(self.large) == 1 else entries[: i + 1])]
            columns = [
                pa.array([i] * len(values), pa.int32()),
                pa.array(range(len(values)), pa.int32()),
                pa.array([Decimal(v >> SUM_BITS) for v in values], pa.decimal128(38, 0)),
                pa.array([Decimal(v & ((1 << SUM_BITS) - 1)) for v in values], pa.decimal128(38, 0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "high", "low"])


def _exact_sums(points: DataFrame, column: str, of) -> dict[tuple[int, int], int]:
    """The entries of the sum over all tasks of ``of(matrix)``, with a bound of its entries."""

    def partial(batches):
        total = _Total()
        for batch in batches:
            for x in matrices(batch.column(0)):
                total.add(*of(x))
        yield from total.rows()

    sums = points.select(column).mapInArrow(partial, _SUMS).groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r["i"], r["j"]): (int(r["high"]) << SUM_BITS) + int(r["low"]) for r in sums.collect()}


def _column_sums(x: np.ndarray) -> tuple[np.ndarray, int]:
    """Sums per dimension and, last, the number of rows."""
    half = 31
    high, low = (x >> half).sum(axis=0).astype(object), (x & ((1 << half) - 1)).sum(axis=0).astype(object)
    return np.r_[high * (1 << half) + low, len(x)][None, :].astype(object), 0


def _norm(x: np.ndarray) -> float:
    return float(np.sqrt((x.astype(np.float64) ** 2).sum()))


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of sorted values with neighbours at most ``gap`` apart, two values or more."""
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cut) if len(c) > 1]


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One iteration in the precision of ``a``: better vectors, their values, and the size of the correction."""
    eye = np.eye(len(a), dtype=a.dtype)
    r = eye - x.T @ x
    s = x.T @ (a @ x)
    values = np.diagonal(s) / (1 - np.diagonal(r))
    off = s - np.diag(values)
    near = 2 * (_norm(off) + _norm(a) * _norm(r))
    gap = values[None, :] - values[:, None]
    close = np.abs(gap) <= near
    e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
    x = x + x @ e
    size = _norm(e)
    for members in _clusters(values, near):
        # the spread of a cluster is solved apart from its mean, so that close values keep their relative digits
        block = x[:, members]
        middle = values[members].mean()
        inner = block.T @ (a @ block) - middle * (block.T @ block)
        inner = (inner + inner.T) / 2
        top = np.abs(inner).max()
        if top > 0:
            turn = np.linalg.eigh((inner / top).astype(np.float64))[1].astype(a.dtype)
            x[:, members] = block @ turn
    return x, values, size


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix of extended precision, right to double precision."""
    scale = np.abs(a).max(initial=0)
    if not scale > 0:
        return np.zeros(len(a), dtype=a.dtype), np.eye(len(a), dtype=a.dtype)
    b = a / scale
    x = np.linalg.eigh(b.astype(np.float32))[1]
    for kind, enough in ((np.float64, 1e-7), (a.dtype.type, 1e-16)):
        x, matrix, last = x.astype(kind), b.astype(kind), np.inf
        for _ in range(ROUNDS):
            x, values, size = _corrected(matrix, x)
            if size <= enough or last / 2 <= size < 1e-3:  # values apart by little more than rounding keep turning
                break
            last = size
    for _ in range(4):  # what a turn by an angle leaves is the angle's square
        x = x + x @ (np.eye(len(b), dtype=b.dtype) - x.T @ x) / 2
    values = (x * (b @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def fit(points: DataFrame, column: str = "point", components: int = 32) -> Model | None:
    """Exact sums and covariance (divisor n) of a column of long vectors of one width, and its leading components.

    None for an empty table. Only components with a positive eigenvalue count:
    vectors that span fewer dimensions have fewer components, equal ones none.
    """
    totals = _exact_sums(points, column, _column_sums)
    if not totals:
        return None
    width = len(totals) - 1
    n, sums = totals[0, width], [totals[0, i] for i in range(width)]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    products = _exact_sums(points, column, lambda x: (product_sums(np.c_[x - centre, np.ones(len(x), dtype=np.int64)]), EXACT))
    left = [products[width, i] for i in range(width)]
    a = np.empty((width, width), dtype=np.longdouble)
    for i in range(width):
        for j in range(i + 1):
            a[i, j] = a[j, i] = _ratio(n * products[i, j] - left[i] * left[j], n * n)
    values, vectors = eigen(a)
    trace = np.trace(a)
    use = [k for k in range(min(components, width)) if values[k] > trace * width * 1e-17]
    return Model(
        n, sums, centre, np.array([_ratio(s, n) for s in left], dtype=np.longdouble).astype(np.float64),
        vectors[:, use].astype(np.float64), values[use].astype(np.float64), float(trace),
    )


def _ratio(a: int, b: int) -> np.longdouble:
    """``a / b`` in extended precision."""
    whole, rest = divmod(a, b)
    near = float(whole)
    return np.longdouble(near) + np.longdouble(float(whole - int(near))) + np.longdouble((rest << 64) // b) / np.longdouble(2.0**64)


def _whitened(x: np.ndarray, model: Model) -> np.ndarray:
    return ((x - model.centre) - model.rest) @ model.components / np.sqrt(model.eigenvalues)


def whiten(points: DataFrame, model: Model, column: str = "point", into: str = "whitened") -> DataFrame:
    """Add ``into``: each point less the mean, projected on the components and divided by the roots of their eigenvalues.

    Works row by row, so equal rows get equal results; all columns are carried.
    """
    schema = T.StructType([f for f in points.schema.fields if f.name != into] + [T.StructField(into, T.ArrayType(T.DoubleType()))])
    columns = [c for c in points.columns if c != into]
    shared = points.sparkSession.sparkContext.broadcast(model)

    def project(batches):
        known = shared.value
        k = len(known.eigenvalues)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            parts = [_whitened(x, known) for x in matrices(batch.column(at))]
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * k, pa.int32()), pa.array(flat, pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, into])

    return points.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(project, schema)


def identity_error(whitened: DataFrame, column: str, width: int) -> float:
    """The largest absolute entry of the covariance (divisor n) of a column of vectors, less the identity."""
    if not width:
        return 0.0

    def partial(batches):
        total, n = np.zeros((width + 1, width + 1)), 0
        for batch in batches:
            for w in matrices(batch.column(0)):
                z = np.c_[w, np.ones(len(w))]
                total += z.T @ z
                n += len(w)
        if n:
            i, j = np.tril_indices(width + 1)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j], pa.float64())], names=["i", "j", "v"])

    sums = np.zeros((width + 1, width + 1))
    for r in whitened.select(column).mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r["i"], r["j"]] = sums[r["j"], r["i"]] = r["v"]
    n = sums[-1, -1]
    mean = sums[-1, :width] / n
    return float(np.abs(sums[:width, :width] / n - np.outer(mean, mean) - np.eye(width)).max())


def squared_deviation(column: str | Column, model: Model) -> Column:
    """Sum over the dimensions of ``(n * x - sum) ** 2`` as an exact long; null where it leaves a long."""
    point = F.col(column) if isinstance(column, str) else column
    total = F.lit(0).cast("long")
    if any(abs(s) >= 2**63 for s in model.sums):
        return F.lit(None).cast("long")
    sums = F.array(*[F.lit(s).cast("long") for s in model.sums])

    def square(x: Column, s: Column) -> Column:
        scaled = F.try_subtract(F.try_multiply(x, F.lit(model.n).cast("long")), s)
        return F.try_multiply(scaled, scaled)

    return F.aggregate(F.zip_with(point, sums, square), total, lambda acc, v: F.try_add(acc, v))
