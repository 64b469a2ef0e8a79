"""Whitened principal components of integer vectors, from their exact scatter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exact_spectrum import eigenvectors, largest_roots, polynomial_modulo, primes_for, remaindered
from .shared import release, typed

#: Values beyond are set to it, so that they fit 64 bits.
MOST = float(1 << 62)
#: Sums leave a task in digits of so many bits, which 64-bit sums over all tasks hold exactly.
DIGIT = 32
#: Bits of a part of a value, and of a sum of products, that floating point numbers hold exactly.
PART, EXACT = 20, 53
#: Rows of a batch that are worked on together.
ROWS = 4096


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``k`` and ``v`` (doubles) of the rows whose vector holds finite numbers only."""
    rows = vectors.select(F.col(f"`{key}`").alias("k"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.filter(F.col("v").isNotNull() & ~F.exists("v", bad))


def matrix_of(column: pa.Array, d: int, scale: float) -> np.ndarray:
    """floor(scale * c) of all entries as 64-bit integers."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -MOST, MOST).astype(np.int64)


def scatter(x: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the rows, exactly: in floating point as far as it holds the sums, else in parts."""
    d = x.shape[1]
    most = int(np.abs(x).max(initial=0))
    if most * most * len(x) < 1 << EXACT:
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    parts, rest = [], x.copy()
    while rest.any():
        last = int(np.abs(rest).max()) < 1 << PART  # also ends negative values, whose shifts stay at -1
        low = rest if last else rest & ((1 << PART) - 1)
        parts.append(low.astype(np.float64))
        rest = (rest - low) >> PART
    total = np.zeros((d, d), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += (a.T @ b).astype(np.int64).astype(object) << PART * (i + j)
    return total


def sums(rows: DataFrame, d: int, scale: float) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of vectors, their sums per dimension and the sums of their products, all exact.

    Each task sends one row per cell and digit, however many vectors it has read.
    """
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            x = matrix_of(batch.column(0), d, scale)
            for at in range(0, len(x), ROWS):
                part = x[at : at + ROWS]
                n += len(part)
                first += sum((((part >> DIGIT).sum(0).astype(object) << DIGIT), (part & ((1 << DIGIT) - 1)).sum(0).astype(object)))
                second += scatter(part)
        cells, digits, values = [], [], []
        for cell, value in enumerate([n, *first, *second[upper]]):
            value, digit = int(value), 0
            while value:
                rest = value >> DIGIT if not -(1 << DIGIT) < value < 1 << DIGIT else 0
                cells.append(cell)
                digits.append(digit)
                values.append(value - (rest << DIGIT))
                value, digit = rest, digit + 1
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(digits, pa.int32()), pa.array(values, pa.int64())], names=["cell", "digit", "value"])

    total = [0] * (1 + d + len(upper[0]))
    summed = rows.select("v").mapInArrow(run, "cell int, digit int, value long").groupBy("cell", "digit").agg(F.sum("value").alias("value"))
    for r in summed.collect():
        total[r["cell"]] += r["value"] << DIGIT * r["digit"]
    products = np.zeros((d, d), object)
    products[upper] = total[1 + d :]
    products.T[upper] = total[1 + d :]
    return total[0], np.array(total[1 : 1 + d], object), products


def polynomial_of(matrix: np.ndarray, spark) -> list[int]:
    """Characteristic polynomial of an integer matrix without negative eigenvalues; primes are spread over tasks."""
    primes = primes_for(matrix)
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_modulo(shared.value, p).tolist() for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["p", "rest"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(run, "p long, rest array<long>").collect()
    return remaindered((r["p"], r["rest"]) for r in sorted(rows, key=lambda r: r["p"]))


class Components:
    """Leading components of n vectors with sums and products: unit vectors, whitening factors, shares of the variance."""

    def __init__(self, n: int, first: np.ndarray, second: np.ndarray, most: int, spark):
        self.n, self.first, self.spread = n, first, n * second - np.outer(first, first)
        trace = int(np.trace(self.spread))
        roots, bits = largest_roots(polynomial_of(self.spread, spark), most) if trace else ([], 0)
        unit = eigenvectors(self.spread, roots, bits)
        self.explained = np.array([r / (trace << bits) for r in roots])
        self.turn = unit / np.sqrt([r / (n * n << bits) for r in roots]) if roots else unit

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, in 64-bit integers where they fit."""
        most = max(int(np.abs(x).max(initial=0)) * self.n, *(abs(int(s)) for s in self.first))
        return self.n * x - self.first.astype(np.int64) if most < 1 << 61 else self.n * x.astype(object) - self.first

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) / self.n @ self.turn


def deviations(centred: np.ndarray) -> pa.Array:
    """Sum of the squares of each row; null beyond 64 bits."""
    if centred.dtype != object and int(np.abs(centred).max(initial=0)) ** 2 * centred.shape[1] < 1 << 63:
        return pa.array((centred * centred).sum(1))
    whole = [sum(v * v for v in row) for row in centred.astype(object).tolist()]
    return pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())


def identity_error(rows: DataFrame, d: int, scale: float, found: Components) -> float:
    """Largest entry by which the covariance of the whitened vectors differs from the identity.

    Each task centres its own vectors by their mean; what the means differ is added when tasks are joined.
    """
    k = found.turn.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = shared.value
        n, mean, total = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = parts.whitened(parts.centred(matrix_of(batch.column(0), d, scale)))
            if len(w):
                own = w.mean(0)
                w = w - own
                total += w.T @ w + np.outer(own - mean, own - mean) * (n * len(w) / (n + len(w)))
                mean, n = mean + (own - mean) * len(w) / (n + len(w)), n + len(w)
        i, j = np.divmod(np.arange(k * k), k)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(k * k, n)), pa.array(mean[i]), pa.array(mean[j]), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "n", "x", "y", "c"])

    n = F.sum("n")
    about = F.sum(F.col("n") * F.col("x") * F.col("y")) - F.sum(F.col("n") * F.col("x")) * F.sum(F.col("n") * F.col("y")) / n
    cells = rows.select("v").mapInArrow(run, "i int, j int, n long, x double, y double, c double").groupBy("i", "j").agg(((F.sum("c") + about) / n).alias("c"))
    return max((abs(r["c"] - (r["i"] == r["j"])) for r in cells.collect()), default=0.0)


def whiten(
    vectors: DataFrame, components: int = 8, scale: float = 1024.0, offset: int = 100_000, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Each vector on the leading principal components of all, scaled to unit variance.

    Entries c become integers x = floor(scale * c) + offset; what is returned does not depend on ``offset``. Returns per row and component (from 1): ``key``,
    ``component``, ``n`` (vectors), ``deviation`` (sum over dimensions of (n * x - sum)^2; null beyond 64 bits),
    ``whitened``, ``explained`` (share of the variance), ``identity_error`` (one value, see there). Sums, products and the
    characteristic polynomial are exact; eigenvalues of zero give no component. Rows whose vector is null or holds
    nulls or non-finite entries take no part, nor do those of another length than the most frequent one (of equally
    frequent ones the longest). Scaled entries beyond 2^62 count as that. Keys may be null or repeated; without
    vectors, or if all are equal, the result is empty.
    """
    spark, rows = vectors.sparkSession, usable(vectors, key, vector)
    schema = typed("component int, n long, deviation long, whitened double, explained double, identity_error double", 0, key, vectors.schema[key].dataType)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    if not d:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("v") == d)
    found = Components(*sums(rows, d, scale), components, spark)
    k = found.turn.shape[1]
    if not k:
        return spark.createDataFrame([], schema)
    error, shared = identity_error(rows, d, scale, found), spark.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                centred = parts.centred(matrix_of(part.column(1), d, scale))
                each = pa.array(np.repeat(np.arange(part.num_rows), k))
                columns = [
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1), part.num_rows), pa.int32()),
                    pa.array(np.full(len(each), parts.n)),
                    deviations(centred).take(each),
                    pa.array(parts.whitened(centred).ravel()),
                    pa.array(np.tile(parts.explained, part.num_rows)),
                    pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        release()

    return rows.mapInArrow(run, schema)
