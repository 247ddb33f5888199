"""Embedding whitening by contour integration of the covariance's spectrum.

The covariance of all distinct vectors is summed by Spark. Inertia counts of the shifted matrix, the numbers of its positive
pivots, slice the upper spectrum into intervals that hold a few eigenvalues each and end where there are none. Each interval
is a task: quadrature on a circle around it of solves with the complex shifted covariance projects a block of vectors onto
the interval's eigenspace, Rayleigh-Ritz takes the eigenpairs out of it, and this repeats until their residuals are at
rounding level. An interval that gives another number of eigenvalues than its inertia count is an error, so none is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.storage import materialize
from tickframe.llm.textbatch import lean

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries of at least this size have no place in a long after scaling; such a vector goes, as one with infinite entries does.
LARGEST = float(1 << 50)
#: Dimensions up to which the covariance (8 bytes times their square) is sent to the driver and to tasks.
MOST_DIMENSIONS = 4096
#: Eigenvalues that an interval may hold, nodes of the half circle, rounds, and the residual in units of the largest eigenvalue.
SLICE, NODES, ROUNDS, RESIDUAL = 6, 12, 40, 2e-15
#: Eigenvalues below this share of the largest, times the dimension, are rounding errors of zeros.
NOISE = 1e-13

PAIRS = "value double, vector array<double>"


def usable(vector: str) -> Column:
    """Whether a vector is there and has finite entries only."""
    c = f"transform(`{vector}`, c -> cast(c as double))"
    return F.expr(f"coalesce(size(`{vector}`) > 0 AND forall({c}, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < {LARGEST!r}D), false)")


def integer_vectors(vector: str) -> Column:
    return F.expr(f"transform(`{vector}`, c -> floor({SCALE} * cast(c as double)) + {SHIFT}L)")


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def sum_task(dimensions: int) -> Callable:
    """(i, s) for each dimension and the number of vectors at -1, as exact integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * dimensions
        n = 0
        for batch in batches:
            x = _matrix(batch.column("x"), dimensions)
            n += len(x)
            # Halves of 32 bits, whose sums fit 64 bits for any batch.
            low, high = (x & 0xFFFFFFFF).sum(0), (x >> 32).sum(0)
            sums = [s + int(a) + (int(b) << 32) for s, a, b in zip(sums, low, high, strict=True)]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(-1, dimensions), pa.int32()), "s": pa.array([str(s) for s in (n, *sums)], pa.string())})

    return run


class Centre:
    """Exact mean S / n of integer vectors."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; the integer part is taken off before anything is rounded."""
        return (x - self.whole).astype(np.float64) - self.rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact; None where it passes 64 bits."""
        away = x - self.whole
        left = np.array([s % self.n for s in self.sums], np.int64)
        most = (int(np.abs(away).max()) + 1) * self.n if away.size else 0
        if most * most * x.shape[1] < 1 << 63:
            return ((away * self.n - left) ** 2).sum(1).tolist()
        exact = [sum((int(v) * self.n - int(s)) ** 2 for v, s in zip(row, left, strict=True)) for row in away]
        return [v if v < 1 << 63 else None for v in exact]


def gram_task(sent: Broadcast, dimensions: int, project: bool = False) -> Callable:
    """(i, j, v): sums of products of centred entries, or of whitened ones with their sums at j = -1; one set for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, axes = sent.value
        size = axes.shape[1] if project else dimensions
        total, plain = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            x = centre.centred(_matrix(batch.column("x"), dimensions))
            x = x @ axes if project else x
            total += x.T @ x
            plain += x.sum(0)
        i, j = np.triu_indices(size)
        one = np.full(size, -1)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.concatenate([i, np.arange(size)]).astype(np.int32)), "j": pa.array(np.concatenate([j, one]).astype(np.int32)), "v": pa.array(np.concatenate([total[i, j], plain]))})

    return run


def covariance(fit: DataFrame, sent: Broadcast, dimensions: int, size: int, n: int, project: bool = False) -> np.ndarray:
    """The covariance with divisor n of the fit list, or of its projection; size * (size + 3) / 2 numbers come to the driver."""
    found = fit.mapInArrow(lean(gram_task(sent, dimensions, project)), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (found.column(c).to_numpy() for c in ("i", "j", "v"))
    matrix, mean = np.zeros((size, size)), np.zeros(size)
    inner = j >= 0
    matrix[i[inner], j[inner]] = matrix[j[inner], i[inner]] = v[inner] / n
    mean[i[~inner]] = v[~inner] / n  # zero but for rounding
    return matrix - np.outer(mean, mean)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a tridiagonal matrix of the same inertia at any shift, by Householder reflections."""
    a, n = matrix.copy(), len(matrix)
    squares = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        squares[k] = length**2
        if length == 0 or k == n - 2:
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        p = a[k + 1 :, k + 1 :] @ x
        w = p - (x @ p) * x
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(x, w) + np.outer(w, x))
    return np.diag(a).copy(), squares


class Inertia:
    """Numbers of eigenvalues above a shift, from the signs of the pivots of the shifted matrix."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.squares = tridiagonal(matrix)
        self.tiny = np.finfo(float).tiny / np.finfo(float).eps

    def above(self, shifts: np.ndarray) -> np.ndarray:
        pivot = self.diagonal[0] - shifts
        count = (pivot > 0).astype(np.int64)
        for d, s in zip(self.diagonal[1:], self.squares, strict=True):
            pivot = np.where(np.abs(pivot) < self.tiny, -self.tiny, pivot)
            pivot = d - shifts - s / pivot
            count += pivot > 0
        return count


def spectrum_slices(inertia: Inertia, floor: float, ceiling: float, most: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of disjoint intervals, from above, that cover the ``most`` largest eigenvalues over ``floor``.

    Cuts lie in the widest empty stretch that a grid of counts shows; equal or nearly equal eigenvalues are never cut apart.
    """
    found: list[tuple[float, float, int]] = []
    ends = inertia.above(np.array([floor, ceiling]))
    todo = [(floor, ceiling, int(ends[0]), int(ends[1]))]
    while todo and sum(c for *_, c in found) < most:
        low, high, over_low, over_high = todo.pop()
        count = over_low - over_high
        if count == 0:
            continue
        grid = (np.geomspace if high > 16 * low else np.linspace)(low, high, 130)[1:-1]
        over = inertia.above(grid)
        if count == 1 or (count <= SLICE and high <= 16 * low):
            # The circle is drawn close around what the interval holds.
            empty_top, empty_low = grid[over == over_high], grid[over == over_low]
            top, base = (empty_top.min() if len(empty_top) else high), (empty_low.max() if len(empty_low) else low)
            if max(1e-9 * high, 1e-12) < top - base < 0.5 * (high - low):
                todo.append((base, top, over_low, over_high))
            else:
                found.append((low, high, count))
            continue
        inside = (over > over_high) & (over < over_low)
        if not inside.any():
            # All within one step of the grid: look closer, until they cannot be told apart.
            top, base = grid[over == over_high].min(initial=high), grid[over == over_low].max(initial=low)
            if top - base <= 1e-9 * ceiling:
                found.append((low, high, count))
            else:
                todo.append((base, top, over_low, over_high))
            continue
        values, first, runs = np.unique(-over[inside], return_index=True, return_counts=True)
        widest = int(np.argmax(runs))
        at = int(np.flatnonzero(inside)[first[widest]] + runs[widest] // 2)
        todo += [(low, float(grid[at]), over_low, int(over[at])), (float(grid[at]), high, int(over[at]), over_high)]
    return found


def contour_pairs(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of a symmetric matrix between low and high; an error where they are not all found."""
    size, norm = len(matrix), max(float(np.abs(matrix).sum(1).max()), np.finfo(float).tiny)
    at, weights = np.polynomial.legendre.leggauss(NODES)
    angles = -np.pi / 2 * (at - 1)
    centre, radius = (low + high) / 2, (high - low) / 2
    block = min(size, count + max(4, count))
    y = np.random.default_rng(block).standard_normal((size, block))
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    stalled = 0
    for _ in range(ROUNDS):
        q = np.zeros_like(y)
        for angle, weight in zip(angles, weights, strict=True):
            turn = radius * np.exp(1j * angle)
            q += weight / 2 * (turn * np.linalg.solve((centre + turn) * np.eye(size) - matrix, y.astype(complex))).real
        basis = np.linalg.qr(q)[0]
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        y = basis @ inner
        inside = (values > low) & (values < high)
        if int(inside.sum()) == count:
            error = float(np.linalg.norm(matrix @ y[:, inside] - y[:, inside] * values[inside], axis=0).max()) / norm
            stalled = stalled + 1 if best and error > best[0] / 2 else 0
            if best is None or error < best[0]:
                best = (error, values[inside], y[:, inside])
            if error < RESIDUAL or stalled == 3:
                break
    if best is None or best[0] > 1e-10:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}; not all were found")
    return best[1], best[2]


def contour_task(sent: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = contour_pairs(sent.value, row["low"], row["high"], row["count"])
                yield pa.RecordBatch.from_pydict({"value": pa.array(values), "vector": pa.array(list(vectors.T), pa.list_(pa.float64()))})

    return run


def leading_components(fit: DataFrame, matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest eigenvalues, falling, with unit eigenvectors as columns; those of rounding size are left out."""
    spark, scale = fit.sparkSession, float(np.abs(matrix).sum(1).max())
    if not scale:
        return np.zeros(0), np.zeros((len(matrix), 0))
    scaled = matrix / scale
    slices = spectrum_slices(Inertia(scaled), NOISE * len(matrix), 1.0 + 1e-6, most)
    sent = spark.sparkContext.broadcast(scaled)
    wanted = spark.createDataFrame([(float(low), float(high), count) for low, high, count in slices], "low double, high double, count int").repartition(len(slices), "low")
    pairs = wanted.mapInArrow(contour_task(sent), PAIRS).toArrow()
    if len(pairs) != sum(c for *_, c in slices):
        raise ArithmeticError("the intervals gave another number of components than their inertia counts")
    vectors = np.array(pairs.column("vector").to_pylist()).T
    # Once more over all intervals, so that components of neighbouring ones are orthogonal to the last bits.
    basis = np.linalg.qr(vectors)[0]
    values, inner = np.linalg.eigh(basis.T @ scaled @ basis)
    order = np.argsort(-values, kind="stable")[:most]
    return values[order] * scale, (basis @ inner)[:, order]


def whiten_task(sent: Broadcast, dimensions: int, explained: np.ndarray, error: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, axes = sent.value
        k = axes.shape[1]
        for batch in batches:
            x = _matrix(batch.column("x"), dimensions)
            n, rows = len(x), np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, centre.n)), pa.array(centre.deviation(x), pa.int64()).take(pa.array(rows)),
                 pa.array((centre.centred(x) @ axes).ravel()), pa.array(np.tile(explained, n)), pa.array(np.full(n * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(df: DataFrame, vector: str = "embedding", components: int = 16) -> DataFrame:
    """Whitened coordinates of the vectors of ``df(vec_id, <vector>, ...)``, one row for each vector and component.

    Rows whose vector is null, empty, or holds null or non-finite entries go, as do entries of 2^50 and more in size and
    vectors of another length than most have (of equally frequent lengths the largest counts). An entry c is taken as the
    integer floor(64 * c) + 1000000. Mean and covariance V are those of the distinct integer vectors, n in number.

    Returns vec_id, component (from 1, by falling eigenvalue e), n, deviation (sum over dimensions of (n * x - S)^2, S being the
    sums of the distinct vectors; null past 64 bits), whitened ((x - S / n) on the component, over sqrt(e)), explained (e over
    the trace) and identity_error (largest difference of whitened's covariance from the identity, the same in all rows).
    Components have eigenvalues above rounding size: equal vectors only, or fewer distinct vectors than components, give fewer
    components or no rows. Rows without a vec_id and repeated rows get theirs; other columns are not read. At most
    ``MOST_DIMENSIONS`` dimensions, since the covariance goes to the driver; the vectors never do.
    """
    spark = df.sparkSession
    schema = f"vec_id {df.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    good = df.where(usable(vector)).select("vec_id", integer_vectors(vector).alias("x"))
    lengths = good.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dimensions = lengths["size"]
    if dimensions > MOST_DIMENSIONS:
        raise ValueError(f"vectors may have {MOST_DIMENSIONS} dimensions at most")
    rows = materialize(good.where(F.size("x") == dimensions), "vectors")
    fit = materialize(rows.select("x").distinct(), "fit")
    summed = fit.mapInArrow(sum_task(dimensions), "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r["i"]: int(r["s"]) for r in summed}
    centre = Centre(sums[-1], [sums[i] for i in range(dimensions)])
    matrix = covariance(fit, spark.sparkContext.broadcast((centre, None)), dimensions, dimensions, centre.n)
    values, vectors = leading_components(fit, matrix, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast((centre, vectors / np.sqrt(values)))
    error = float(np.abs(covariance(fit, sent, dimensions, len(values), centre.n, project=True) - np.eye(len(values))).max())
    return rows.mapInArrow(lean(whiten_task(sent, dimensions, values / np.trace(matrix), error)), schema)
