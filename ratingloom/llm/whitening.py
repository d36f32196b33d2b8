"""Whitening of embeddings: principal components by FEAST contour integration.

The covariance of the vectors is summed in Spark, as exact integers, and is as large as the
dimensions allow, whatever the number of rows. Its leading eigenvectors are found by intervals:

* Inertia: the matrix is brought to tridiagonal form once. By Sylvester's law, the negative pivots
  of a shifted LDL' factorization count the eigenvalues below the shift. Bisection with these
  counts cuts the wanted part of the spectrum, in its gaps, into intervals of few eigenvalues.
* Quadrature: around each interval, ``NODES`` nodes z of a Gauss rule on a half circle give
  Q = sum of weight * Re((zI - V)^-1 Y), which all but projects Y onto the eigenvectors inside.
* Rayleigh-Ritz: the small matrix Q'VQ yields approximations; they are the next Y, until their
  residuals are at rounding level.
* The number of eigenvalues found inside must equal the inertia count; else the subspace grows and
  the interval is done again. So none is missed, whatever the start.

E. Polizzi, "Density-matrix-based algorithm for solving eigenvalue problems", Phys. Rev. B 79, 2009.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import shared

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
#: Entries are held to this size after scaling, so that exact sums stay bounded.
LARGEST = 1 << 40
#: Wanted eigenvalues of an interval.
PER_INTERVAL = 12
NODES = 8
ROUNDS = 60
#: Gaps narrower than this share of the spectrum are not cut.
GAP = 1e-7
#: Eigenvalues below this share of the trace are rounding, not variance.
NEGLIGIBLE = 1e-12
_SALTS = 16
_BLOCK = 4096
_LONG = 2**63 - 1


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and subdiagonal of a tridiagonal matrix similar to a symmetric one (Householder)."""
    a = matrix.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0.0:
            continue
        x[0] += math.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        p -= (x @ p) * x
        rest -= 2.0 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1 :, k] -= 2.0 * x * (x @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: the positive pivots of the shifted factorization."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    above, pivot, square = 0, 1.0, np.concatenate(([0.0], off * off))
    for d, s in zip(diagonal.tolist(), square.tolist()):
        pivot = d - shift - s / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return above


def _bounds(diagonal: np.ndarray, off: np.ndarray) -> tuple[float, float]:
    """An interval that holds all eigenvalues (Gershgorin)."""
    reach = np.abs(np.concatenate((off, [0.0]))) + np.abs(np.concatenate(([0.0], off)))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    slack = 1e-3 * max(abs(low), abs(high), np.finfo(float).tiny)
    return low - slack, high + slack


def cut_below(diagonal: np.ndarray, off: np.ndarray, rank: int) -> tuple[float, int]:
    """A shift in a gap with at least ``rank`` eigenvalues above it, as few as the gaps allow."""
    n = len(diagonal)
    low, high = _bounds(diagonal, off)
    width = high - low

    def edge(k: int) -> float:
        """The k-th largest eigenvalue, to a fraction of the gap that counts."""
        a, b = low, high
        while b - a > 0.1 * GAP * width:
            mid = (a + b) / 2
            a, b = (mid, b) if count_above(diagonal, off, mid) >= k else (a, mid)
        return (a + b) / 2

    rank = min(rank, n)
    upper = edge(rank)
    while rank < n:
        lower = edge(rank + 1)
        if upper - lower > GAP * width:
            return (upper + lower) / 2, rank
        rank, upper = rank + 1, lower
    return low, n


def _ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q, _ = np.linalg.qr(basis)
    values, inner = np.linalg.eigh(q.T @ matrix @ q)
    return values, q @ inner


def feast(
    matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in (low, high), rising, and their eigenvectors; ``count`` of them must be there.

    The subspace grows until the number found is the number counted.
    """
    n = len(matrix)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 + nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    scale = np.linalg.norm(matrix)
    rng = np.random.default_rng(seed)
    size = min(n, max(count + 4, 3 * count // 2))
    start = np.zeros((n, 0))
    while True:
        y = np.hstack((start, rng.standard_normal((n, size - start.shape[1]))))
        best = np.inf
        for _ in range(ROUNDS):
            q = np.zeros((n, size))
            for angle, weight in zip(angles, weights):
                turn = np.exp(1j * angle)
                solved = np.linalg.solve(
                    (centre + radius * turn) * np.eye(n) - matrix, y.astype(complex)
                )
                q += weight / 2 * (radius * turn * solved).real
            values, y = _ritz(matrix, q)
            inside = (values > low) & (values < high)
            error = np.linalg.norm(matrix @ y[:, inside] - y[:, inside] * values[inside], axis=0)
            worst = error.max(initial=0.0)
            # Converged if residuals are at rounding level and fall no further.
            settled = worst <= 1e-15 * scale or worst > 0.5 * best
            if inside.sum() == count and worst <= 1e-11 * scale and settled:
                return values[inside], y[:, inside]
            best = min(best, worst)
        if size == n:
            raise ArithmeticError(f"{inside.sum()} eigenvalues in an interval that holds {count}")
        start, size = y, min(n, 2 * size)


def leading(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors as columns, verified by inertia.

    Only eigenvalues above ``NEGLIGIBLE`` of the trace are returned. A group of nearly equal
    eigenvalues is never cut apart.
    """
    diagonal, off = tridiagonal(matrix)
    trace = float(np.trace(matrix))
    positive = count_above(diagonal, off, NEGLIGIBLE * max(trace, 0.0)) if trace > 0 else 0
    wanted = min(components, positive)
    values, vectors = [], []
    _, high = _bounds(diagonal, off)
    done = 0
    while done < wanted:
        low, above = cut_below(diagonal, off, min(wanted, done + PER_INTERVAL))
        count = above - done
        if count != count_above(diagonal, off, low) - count_above(diagonal, off, high):
            raise ArithmeticError("inertia counts disagree")
        found, basis = feast(matrix, low, high, count)
        values += found[::-1].tolist()
        vectors.append(basis[:, ::-1])
        done, high = above, low
    if not wanted:
        return np.zeros(0), np.zeros((len(matrix), 0))
    return np.array(values)[:wanted], np.hstack(vectors)[:, :wanted]


@dataclass
class Whitening:
    """What the fit knows: ``x`` is whitened by ``(x - sums / n) @ vectors / sqrt(values)``."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The means, rounded to integers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """The means less ``centre``, to double precision."""
        return np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, self.centre)])

    def apply(self, x: np.ndarray) -> np.ndarray:
        centred = (x - self.centre).astype(np.float64) - self.rest
        return centred @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sums)**2, exact; null beyond a long."""
        small = (x - self.centre).astype(np.int64)
        shift = [self.n * int(c) - s for c, s in zip(self.centre, self.sums)]
        most = self.n * int(np.abs(small).max(initial=0)) + max(map(abs, shift), default=0)
        if most * most * max(1, len(shift)) <= _LONG:
            off = self.n * small + np.array(shift, np.int64)
            return (off * off).sum(1).tolist()
        off = self.n * small.astype(object) + np.array(shift, object)
        return [d if d <= _LONG else None for d in (off * off).sum(1).tolist()]


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` doubles as scaled and shifted integers."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    scaled = np.floor(np.clip(SCALE * c, -float(LARGEST), float(LARGEST)))
    return scaled.astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch], dims: int):
    for batch in batches:
        for low in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(low, _BLOCK)
            yield part, _integers(part.column(1), dims)


def _gram(z: np.ndarray) -> np.ndarray:
    """Exact z'z of integers, as Python integers."""
    limit = int(np.abs(z).max(initial=0))
    if limit * limit * len(z) < 1 << 53:  # exact in double precision
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    half = 1 << 21
    high, low = z // half, z % half
    if limit >= half << 11 or len(z) > 1 << 10:  # keep each product's sum under 2**53
        if len(z) > 1:
            cut = len(z) // 2
            return _gram(z[:cut]) + _gram(z[cut:])
        row = z[0].astype(object)
        return np.outer(row, row)
    h, f = high.astype(np.float64), low.astype(np.float64)
    hh, hl, ll = (m.astype(np.int64).astype(object) for m in (h.T @ h, h.T @ f, f.T @ f))
    return hh * half * half + (hl + hl.T) * half + ll


def _summed(partial: DataFrame, width: int) -> np.ndarray:
    """Sum of rows (part, i, values as decimal text) by i, first over salts in Spark.

    What reaches the driver is at most ``_SALTS`` tables of the matrix's size.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = np.array([int(v) for v in text.split()], object)
                sums[i] = sums[i] + row if i in sums else row
        yield _as_rows(sums)

    salted = partial.repartition(_SALTS, "part")
    out = np.zeros((width, width), object)
    for row in salted.select("i", "sums").mapInArrow(add, "i int, sums string").toLocalIterator():
        out[row["i"]] += np.array([int(v) for v in row["sums"].split()], object)
    return out


def _as_rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.int32()),
            pa.array([" ".join(map(str, row.tolist())) for row in sums.values()], pa.string()),
        ],
        ["i", "sums"],
    )


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``vec_id, v`` of the rows that count, v as doubles, and their number of dimensions.

    A null vector, and one with null or non-finite entries, does not count. Where lengths differ,
    vectors of the most frequent length do, the larger on ties; no entries do not make a vector.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id"), v.alias("v")).filter(
        v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False))
    )
    lengths = rows.groupBy(F.size("v").alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    if most is None:
        return rows, 0
    return rows.filter(F.size("v") == most["dims"]), int(most["dims"])


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """Fit on all ``rows`` of ``usable``: exact sums, then the exact centred covariance."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, object)
        for _, x in _blocks(batches, dims):
            n += len(x)
            sums += x.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([list(map(int, sums))], pa.list_(pa.int64()))],
            ["n", "sums"],
        )

    counted = rows.select("vec_id", "v").mapInArrow(add, "n long, sums array<long>")
    each = [F.sum(F.get("sums", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in range(dims)]
    total = counted.agg(F.sum("n").alias("n"), *each).first()
    n, sums = total[0], [int(s) for s in total[1:]]
    fitted = Whitening(n, sums, np.zeros(0), np.zeros((dims, 0)), 0.0)
    centre = fitted.centre

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for _, x in _blocks(batches, dims):
            total = total + _gram(x - centre)
        yield _as_rows(dict(enumerate(total)))

    # Integers centred by the rounded mean; the rest of the mean leaves exactly, as a fraction.
    products = rows.select("vec_id", "v").mapInArrow(multiply, "i int, sums string")
    gram = _summed(products.withColumn("part", F.spark_partition_id()), dims)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    covariance = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            covariance[i, j] = covariance[j, i] = (n * gram[i, j] - rest[i] * rest[j]) / (n * n)
    fitted.trace = float(np.trace(covariance))
    fitted.values, fitted.vectors = leading(covariance, components)
    return fitted


def identity_error(rows: DataFrame, dims: int, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened vectors less the identity."""
    k = len(fitted.values)
    if not k:
        return 0.0
    held = rows.sparkSession.sparkContext.broadcast(fitted)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for _, x in _blocks(batches, dims):
            w = held.value.apply(x)
            total += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(k), pa.int32()),
                pa.array(total.tolist(), pa.list_(pa.float64())),
            ],
            ["i", "products"],
        )

    # Whitened vectors are centred already: the mean left them before they were projected.
    added = rows.select("vec_id", "v").mapInArrow(multiply, "i int, products array<double>")
    each = [F.sum(F.get("products", F.lit(j))).alias(f"p{j}") for j in range(k)]
    found = added.groupBy("i").agg(*each).collect()
    covariance = np.zeros((k, k))
    for row in found:
        covariance[row[0]] = row[1:]
    return float(np.abs(covariance / fitted.n - np.eye(k)).max())


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    A row for every row of ``vectors`` (vec_id, embedding) that ``usable`` keeps and each of the
    first ``components`` principal components that have variance. Entries become integers,
    floor(64 * c) + 1000000, where 64 * c is held to 2**40 either way. ``deviation`` is exact, and
    null where a long cannot hold it. Repeated rows count and come out each, rows without vec_id
    too. Without usable vectors, or if all are equal, there are no rows. Other columns are not
    looked at.
    """
    spark = vectors.sparkSession
    shared.ship(spark)
    rows, dims = usable(vectors)
    if not dims:
        return spark.createDataFrame([], _OUT)
    fitted = fit(rows, dims, components)
    error = identity_error(rows, dims, fitted)
    held = spark.sparkContext.broadcast(fitted)
    k = len(fitted.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = held.value
        for part, x in _blocks(batches, dims):
            w = fit.apply(x)
            n = len(x)
            deviation = pa.array(fit.deviations(x), pa.int64())
            row = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(row),
                    pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                    pa.array(np.full(n * k, fit.n), pa.int64()),
                    deviation.take(row),
                    pa.array(w.ravel()),
                    pa.array(np.tile(fit.values / fit.trace, n)),
                    pa.array(np.full(n * k, error)),
                ],
                [c.split()[0] for c in _OUT.split(", ")],
            )

    if not k:
        return spark.createDataFrame([], _OUT)
    return rows.select(F.col("vec_id").cast("long"), "v").mapInArrow(project, _OUT)
