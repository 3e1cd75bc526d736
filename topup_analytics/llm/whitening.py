"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.llm.common import Scratch, read_table, ship_code

#: A component c becomes the integer floor(1024 * c) + 100000.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Quantised components reach so far at most; larger ones fail the query.
LIMIT = float(1 << 62)
#: Doubles hold integers exactly up to here.
EXACT = 1 << 53
_SWEEPS = 60


def usable(vector: Column) -> Column:
    """Whether a vector is not null and holds no null and no non-finite entry."""
    value = lambda x: x.cast("double")
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(value(x)) < float("inf")) & ~F.isnan(value(x)))


def quantised(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Rows of integers; vectors shorter than ``width`` count as ending in zeros."""
    lengths = vectors.value_lengths().to_numpy()
    values = np.zeros((len(lengths), width))
    filled = np.arange(width) < lengths[:, None]
    values[filled] = vectors.flatten().to_numpy(zero_copy_only=False)
    scaled = np.floor(values * SCALE)
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise OverflowError("a quantised component does not fit a bigint")
    return scaled.astype(np.int64) + SHIFT


def _sums(rows: np.ndarray) -> np.ndarray:
    """Exact column sums."""
    most = int(np.abs(rows).max(initial=0))
    return rows.sum(axis=0) if most * len(rows) < 1 << 63 else rows.astype(object).sum(axis=0)


def _products(rows: np.ndarray) -> np.ndarray:
    """The exact sums of products of each two columns, as Python integers.

    Matrix products of doubles are exact while every sum stays below 2**53, so rows are taken that many at a time.
    """
    most = int(np.abs(rows).max(initial=0)) ** 2
    at_once = EXACT // max(1, most)
    total = np.zeros((rows.shape[1],) * 2, dtype=object)
    if not at_once:
        wide = rows.astype(object)
        return wide.T @ wide
    for at in range(0, len(rows), at_once):
        part = rows[at : at + at_once].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """L with L @ L.T = scatter, a column for each pivot, in the order of the largest diagonal left.

    With its rows in the order of the pivots L is lower triangular. It ends where what is left is no more
    than rounding, so it has as many columns as the scatter has rank.
    """
    d = len(scatter)
    left = scatter.diagonal().copy()
    least = d * np.finfo(float).eps * left.max(initial=0)
    factor = np.zeros((d, d))
    open_rows = np.ones(d, dtype=bool)
    for k in range(d):
        pivot = int(np.where(open_rows, left, -1.0).argmax())
        if not open_rows[pivot] or left[pivot] <= least:
            return factor[:, :k]
        open_rows[pivot] = False
        factor[pivot, k] = np.sqrt(left[pivot])
        rest = np.flatnonzero(open_rows)
        factor[rest, k] = (scatter[rest, pivot] - factor[rest, :k] @ factor[pivot, :k]) / factor[pivot, k]
        left[rest] -= factor[rest, k] ** 2
    return factor


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of pairs that share none (a round-robin tournament)."""
    seats = list(range(n)) + [-1] * (n % 2)
    rounds = []
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[: len(seats) // 2], reversed(seats[len(seats) // 2 :])) if min(a, b) >= 0]
        rounds.append((np.array([min(p) for p in pairs]), np.array([max(p) for p in pairs])))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return rounds


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors, as columns, of factor @ factor.T.

    Rotates pairs of columns until all are orthogonal: their squared norms are the
    eigenvalues, and the columns themselves, normalised, the eigenvectors.
    """
    if not factor.shape[1]:
        return np.zeros(0), factor
    columns = factor.T.copy()
    tolerance = np.finfo(float).eps * np.sqrt(max(1, factor.shape[0]))
    rounds = _rounds(len(columns)) if len(columns) > 1 else []
    for _ in range(_SWEEPS):
        rotated = False
        for p, q in rounds:
            x, y = columns[p], columns[q]
            a, b, c = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            turn = np.abs(c) > tolerance * np.sqrt(a * b)
            if not turn.any():
                continue
            rotated = True
            zeta = (b - a)[turn] / (2 * c[turn])
            tangent = np.copysign(1.0, zeta) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, tangent)
            sine = (cosine * tangent)[:, None]
            cosine = cosine[:, None]
            columns[p[turn]] = cosine * x[turn] - sine * y[turn]
            columns[q[turn]] = sine * x[turn] + cosine * y[turn]
        if not rotated:
            break
    norms = np.sqrt((columns * columns).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    vectors = columns[order] / norms[order, None]
    # Of the two signs the one whose largest entry is positive.
    largest = np.abs(vectors).argmax(axis=1)
    vectors *= np.sign(vectors[np.arange(len(vectors)), largest])[:, None]
    return norms[order] ** 2, vectors.T


def _totals(rows: DataFrame) -> tuple[int, np.ndarray]:
    """The number of vectors and the exact sum of every dimension."""
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, dtype=object)
        for batch in batches:
            n += batch.num_rows
            total = total + _sums(quantised(batch.column(0), width))
        values = [Decimal(n), *(Decimal(int(x)) for x in total)]
        places = pa.array(range(-1, width), pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array(values, pa.decimal128(38, 0))], ["place", "total"])

    parts = rows.select("vector").mapInArrow(add, "place int, total decimal(38,0)")
    found = {r["place"]: int(r["total"]) for r in parts.groupBy("place").agg(F.sum("total").alias("total")).collect()}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(width)], dtype=object)


def _scatter(rows: DataFrame, centre: np.ndarray) -> np.ndarray:
    """The exact sums of products of the rows' integer distances from ``centre``."""
    width = len(centre)
    above = [(i, j) for i in range(width) for j in range(i, width)]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), dtype=object)
        for batch in batches:
            total = total + _products(quantised(batch.column(0), width) - centre)
        i, j = np.triu_indices(width)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32())]
        columns.append(pa.array([Decimal(int(x)) for x in total[i, j]], pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    parts = rows.select("vector").mapInArrow(multiply, "i int, j int, total decimal(38,0)")
    found = {(r["i"], r["j"]): int(r["total"]) for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    scatter = np.zeros((width, width), dtype=object)
    for i, j in above:
        scatter[i, j] = scatter[j, i] = found[i, j]
    return scatter


def whitened(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every vector projected on the first principal components and scaled to unit variance:
    ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors are quantised to integers x. Two passes add up, exactly and so in any order alike, their sums S
    and the products of their distances from the mean rounded to integers; from these the covariance is
    known to a double's last place. Only sums by dimension and by pair of dimensions reach the driver, whose
    size is that of the covariance, whatever the number of rows. There the pivoted Cholesky factor is rotated by
    one-sided Jacobi. ``deviation`` is the exact sum of (n*x - S)^2, and ``identity_error`` is taken from the
    covariance of the results in one more pass.

    Vectors that are null or hold null or non-finite entries are left out. Shorter vectors count as ending in
    zeros, whatever their place in the table. A quantised component or a deviation that does not fit a bigint
    fails the query. Repeated rows each count, and each give rows; a null id stays null. Where the
    vectors span fewer dimensions than ``components`` there are as many components as dimensions, and none,
    so no rows, for an empty table, for one vector, or where all are equal. Other columns, whatever
    their names are, are not read.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    scratch = Scratch(spark)
    value = F.col(vector).cast("array<double>")
    rows = vectors.where(usable(F.col(vector))).select(F.col(id).cast("bigint").alias("vec_id"), value.alias("vector"))
    n, sums = _totals(rows)
    width = len(sums)
    centre = np.array([(2 * int(s) + n) // (2 * n) for s in sums], dtype=np.int64) if n else np.zeros(0, dtype=np.int64)
    rest = np.array([int(s) - n * int(c) for s, c in zip(sums, centre)], dtype=object)
    # n**2 times the covariance, in whole numbers.
    exact = n * _scatter(rows, centre) - np.outer(rest, rest) if n and width else np.zeros((0, 0), dtype=object)
    covariance = np.array([[int(x) / (n * n) for x in row] for row in exact], dtype=np.float64).reshape(exact.shape)
    values, axes = one_sided_jacobi(pivoted_cholesky(covariance))
    values, axes = values[:components], axes[:, :components]
    shares = (values / covariance.trace()).tolist() if len(values) else []
    scaled = axes / np.sqrt(values)
    remainders = rest.astype(np.int64)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = quantised(batch.column(1), width) - centre
            most = n * (int(np.abs(near).max(initial=0)) + 1)
            if width * most * most < 1 << 63:
                far = n * near - remainders
                squares = (far * far).sum(axis=1).tolist()
            else:
                far = n * near.astype(object) - remainders
                squares = [int(x) for x in (far * far).sum(axis=1)]
            if max(squares, default=0) >= 1 << 63:
                raise OverflowError("a deviation does not fit a bigint")
            # Added up dimension by dimension: a matrix product rounds by the size of the batch.
            centred = (far / n).astype(np.float64)
            found = np.zeros((len(centred), scaled.shape[1]))
            for place, of in zip(centred.T, scaled):
                found += place[:, None] * of
            lists = pa.array(list(found), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(squares, pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    kind = "vec_id bigint, deviation bigint, whitened array<double>"
    if not len(values):
        projected = spark.createDataFrame([], kind)
    else:
        projected = scratch.stored(rows.mapInArrow(project, kind))
    entry = lambda i: F.get("whitened", F.lit(i))
    errors = [
        F.abs(F.covar_pop(entry(i), entry(j)) - float(i == j)) for i, j in combinations_with_replacement(range(len(values)), 2)
    ]
    worst = projected.agg(F.array_max(F.array(*errors)).alias("worst")).first()["worst"] if errors else None
    return projected.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(s) for s in shares]).cast("array<double>"), F.col("place")).alias("explained"),
        F.lit(worst).cast("double").alias("identity_error"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every embedding."""
    return whitened(read_table(spark, sf_dir, "embeddings"))
