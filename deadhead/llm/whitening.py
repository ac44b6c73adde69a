"""Whitening of embeddings: exact sums and a centred covariance from Spark, an own symmetric eigensolver, projection.

* Entries become whole numbers, ``floor(scale * c)``. The fit list holds each distinct vector once; Spark combines equal
  vectors before they are shuffled, so a vector that a third of all rows share costs a row per task. It is written.
* Sums per dimension are exact (in two halves of 32 bits, added as decimals). A second pass centres each vector before it
  multiplies; tasks send the upper triangle of their share, and Spark adds these per cell. Only as many cells as the square
  of the dimension reach the driver.
* There: Householder reflections make the matrix tridiagonal, Sturm counts bisect for the leading eigenvalues, and inverse
  iteration finds their vectors, which are made orthogonal within a cluster of near eigenvalues.
* The components, as many numbers as dimension times components, go to all tasks and project every row. The covariance of
  the whitened fit list is measured in the same way as the first one.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite entries take no part, nor do those of another length
than most (of equally frequent lengths: the longest); repeated rows are whitened each and fitted once; NULL ids are kept; entries
beyond 64 bits are those of the nearest such number; a component whose eigenvalue is zero within rounding has NULL as whitened value and stays out of the
identity error; a deviation of more than 38 digits is NULL; an empty table gives no rows; further columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.llm.common import free_name, materialize

SCALE = 256
#: Eigenvalues nearer to each other than this share of the matrix's norm form a cluster.
CLUSTER = 1e-3
ROUNDS = 6
WHITE = "deviation decimal(38,0), whitened array<double>"
_EPS = np.finfo(float).eps


# eigenvalues of a symmetric matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and orthogonal Q of ``matrix = Q T Q'``, by Householder reflections."""
    a, n = matrix.astype(float).copy(), len(matrix)
    q = np.eye(n)
    for j in range(n - 2):
        v = a[j + 1 :, j].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        a[j + 1 :, j:] -= 2 * np.outer(v, v @ a[j + 1 :, j:])
        a[j:, j + 1 :] -= 2 * np.outer(a[j:, j + 1 :] @ v, v)
        q[:, j + 1 :] -= 2 * np.outer(q[:, j + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def smaller(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each ``x``: sign changes of the Sturm sequence, as ratios."""
    least = max(np.abs(off).max(initial=0.0) ** 2 * _EPS**2, np.finfo(float).tiny)
    ratio = diagonal[0] - x
    found = (ratio < 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off, strict=True):
        ratio = np.where(np.abs(ratio) < least, -least, ratio)
        ratio = d - x - e * e / ratio
        found += ratio < 0
    return found


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its interval has no inner number."""
    reach = np.abs(np.concatenate((off, [0]))) + np.abs(np.concatenate(([0], off)))
    norm = max(float((np.abs(diagonal) + reach).max()), np.finfo(float).tiny)
    low = np.full(k, float((diagonal - reach).min()) - _EPS * norm)
    high = np.full(k, float((diagonal + reach).max()) + _EPS * norm)
    wanted = len(diagonal) - 1 - np.arange(k)  # so many are smaller
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return high
        above = smaller(diagonal, off, middle) <= wanted
        low, high = np.where(open_ & above, middle, low), np.where(open_ & ~above, middle, high)


def _solved(diagonal: np.ndarray, off: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """x of a tridiagonal system, by elimination with row exchanges; a pivot of zero becomes ``least``."""
    n = len(diagonal)
    rows = np.zeros((n, 3))  # a row from its pivot on
    b = right.copy()
    rows[0, 0] = diagonal[0]
    if n > 1:
        rows[0, 1] = off[0]
    for i in range(n - 1):
        below = np.array([off[i], diagonal[i + 1], off[i + 1] if i + 2 < n else 0.0])
        if abs(below[0]) > abs(rows[i, 0]):
            rows[i], below = below, rows[i].copy()
            b[i], b[i + 1] = b[i + 1], b[i]
        if rows[i, 0] == 0:
            rows[i, 0] = least
        times = below[0] / rows[i, 0]
        rows[i + 1, :2] = below[1:] - times * rows[i, 1:]
        b[i + 1] -= times * b[i]
    x = np.zeros(n + 2)
    for i in range(n - 1, -1, -1):
        pivot = rows[i, 0] if abs(rows[i, 0]) >= least else least
        x[i] = (b[i] - rows[i, 1] * x[i + 1] - rows[i, 2] * x[i + 2]) / pivot
    return x[:n]


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling ``values`` by inverse iteration, orthogonal within a cluster."""
    n = len(diagonal)
    norm = max(float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)), np.finfo(float).tiny)
    random, out, begin = np.random.default_rng(11), np.zeros((n, len(values))), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            begin = k
        x = random.normal(size=n)
        for _ in range(ROUNDS):
            x = _solved(diagonal - value, off, x / np.linalg.norm(x), _EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, begin:k] @ (out[:, begin:k].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors as columns, the largest entry positive."""
    scale = float(np.abs(matrix).max(initial=0.0))
    if scale == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, q = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    vectors = q @ leading_vectors(diagonal, off, values)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return values * scale, vectors * signs


# the job


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)).cast("long") + F.lit(0).cast("long"))


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def _by_task(source: DataFrame, make: Callable[[np.ndarray], dict[str, np.ndarray]], kinds: str) -> DataFrame:
    """Sums of ``make`` over the batches of each task: (columns of numbers), a row for each place in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for name, values in make(_matrix(batch.column(0))).items():
                    total[name] = total[name] + values if name in total else values
        if total:
            size = len(next(iter(total.values())))
            yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(size)), **{c: pa.array(v) for c, v in total.items()}})

    return source.select("x").mapInArrow(run, f"place long, {kinds}")


def _exact_sums(fit: DataFrame) -> list[int]:
    """Sum of each dimension: high and low halves cannot overflow within 2^31 rows of a task."""

    def halves(x: np.ndarray) -> dict[str, np.ndarray]:
        return {"high": (x >> 32).sum(axis=0), "low": (x & 0xFFFFFFFF).sum(axis=0)}

    wide = F.col("high").cast("decimal(28,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("low").cast("decimal(20,0)")
    sums = _by_task(fit, halves, "high long, low long").groupBy("place").agg(F.sum(wide.cast("decimal(38,0)")).alias("total"))
    return [int(r.total) for r in sums.orderBy("place").collect()]  # a row per dimension


def _covariance(fit: DataFrame, n: int, width: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    upper = np.triu_indices(width)

    def products(x: np.ndarray) -> dict[str, np.ndarray]:
        c = centred(x)
        return {"value": (c.T @ c)[upper]}

    cells = _by_task(fit, products, "value double").groupBy("place").agg(F.sum("value").alias("value")).collect()  # a row per cell
    out = np.zeros((width, width))
    for r in cells:
        i, j = upper[0][r.place], upper[1][r.place]
        out[i, j] = out[j, i] = r.value / n
    return out


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with sums ``sums``; ``values`` falling, ``vectors`` as columns; zero eigenvalues are not used."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    used: int
    identity_error: float | None

    @property
    def explained(self) -> list[float | None]:
        return [float(v / self.trace) if self.trace > 0 else None for v in self.values]

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        if np.abs(x).max(initial=0) < 1 << 61:
            return (x - whole) - rest
        return x.astype(float) - whole - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors[:, : self.used] / np.sqrt(self.values[: self.used])

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2 for each row, exact."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if x.shape[1] * most * most < 1 << 63:
            found = self.n * x - np.array(self.sums, np.int64)
            return pa.array((found * found).sum(axis=1)).cast(pa.decimal128(38, 0))
        found = (self.n * x.astype(object) - np.array(self.sums, object)) ** 2
        return pa.array([v if v < 10**38 else None for v in found.sum(axis=1).tolist()], pa.decimal128(38, 0))


def _prepared(table: DataFrame, vector: str, scale: int, name: str) -> DataFrame:
    """Rows that take part, with their whole numbers as ``name``."""
    good = table.filter(usable(F.col(vector)))
    sizes = good.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return good.filter(F.size(vector) == (sizes.size if sizes else 0)).withColumn(name, whole_numbers(F.col(vector), scale))


def fit(table: DataFrame, vector: str = "embedding", components: int = 4, scale: int = SCALE) -> Whitening | None:
    """The whitening of the distinct whole-number vectors; None of an empty table."""
    listed = materialize(_prepared(table.select(vector), vector, scale, "x_" if vector == "x" else "x").select(F.col("x_" if vector == "x" else "x").alias("x")).distinct(), "whitening-fit")
    n, sums = listed.count(), _exact_sums(listed)
    if not n:
        return None
    width = len(sums)
    begun = Whitening(n, tuple(sums), np.zeros(0), np.zeros((width, 0)), 0.0, 0, None)
    covariance = _covariance(listed, n, width, begun.centred)
    k = min(components, width)
    values, vectors = leading(covariance, k)
    used = int(np.count_nonzero(values > width * _EPS * max(values[0], 0.0)))
    found = Whitening(n, tuple(sums), values, vectors, float(np.trace(covariance)), used, None)
    if not used:
        return found
    means = _by_task(listed, lambda x: {"value": found.project(x).sum(axis=0)}, "value double").groupBy("place").agg(F.sum("value").alias("value")).collect()  # a row per component
    mean = np.zeros(used)
    for r in means:
        mean[r.place] = r.value / n
    white = _covariance(listed, n, used, lambda x: found.project(x) - mean)
    return Whitening(n, tuple(sums), values, vectors, found.trace, used, float(np.abs(white - np.eye(used)).max()))


def whiten(table: DataFrame, model: Whitening | None, vector: str = "embedding", scale: int = SCALE, out: str = "white") -> DataFrame:
    """Rows of ``table`` that take part, with a struct ``out``: deviation and whitened coordinates."""
    kept = table.drop(out)
    own = free_name(kept, "_whole")
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StructType.fromDDL(WHITE))])
    if model is None:
        return table.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(own))
                rows = [[*row, *[None] * (len(model.values) - model.used)] for row in model.project(x).tolist()]
                struct = pa.StructArray.from_arrays([model.deviations(x), pa.array(rows, pa.list_(pa.float64()))], names=["deviation", "whitened"])
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], names=[*batch.schema.names[:-1], out])

    prepared = _prepared(kept, vector, scale, own)
    return prepared.filter(F.size(vector) == len(model.sums)).mapInArrow(run, schema)
