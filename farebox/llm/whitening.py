"""Whitening of vectors by the eigenvectors of their exact integer scatter matrix."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import charpoly
from farebox.llm.vectors import SUMS, added, blocks, exact_gram, exact_sums, sum_rows, usual_length
from farebox.session import shuffle_width

COMPONENTS = 32
SCALE = 64


class Whitening(NamedTuple):
    """Sums of the fit list, and the components: rows of unit vectors, with eigenvalues and their shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: list[float]
    shares: list[float]


def _scatter(rows: DataFrame, vector: str, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums per dimension and n * sum(x x') - S S' of the fit list, exact."""
    upper = [(i, j) for i in range(dim) for j in range(i, dim)]

    def sums(batches):
        gram, total, n = np.zeros((dim, dim), dtype=object), np.zeros(dim, dtype=object), 0
        for _, y in blocks(batches, dim, SCALE):
            gram, total, n = gram + exact_gram(y), total + exact_sums(y), n + len(y)
        values = [gram[i, j] for i, j in upper] + list(total) + [n]
        yield sum_rows(list(range(len(values))), values)

    found = added(rows.select("vec_id", vector).mapInArrow(sums, SUMS))
    n, total = found[len(upper) + dim], [found[len(upper) + i] for i in range(dim)]
    matrix = [[0] * dim for _ in range(dim)]
    for k, (i, j) in enumerate(upper):
        matrix[i][j] = matrix[j][i] = n * found[k] - total[i] * total[j]
    return n, total, matrix


def _polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The characteristic polynomial, the constant first; a prime is a row of a Spark job."""
    dim = len(matrix)
    bound = charpoly.coefficient_bound(sum(matrix[i][i] for i in range(dim)), dim)
    primes = charpoly.primes_beyond(2 * bound)

    def remainders(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                residues = np.array([[v % p for v in row] for row in matrix], dtype=np.int64)
                row = [pa.array([p], pa.int64()), pa.array([charpoly.polynomial_mod(residues, p).tolist()])]
                yield pa.RecordBatch.from_arrays(row, names=["p", "residues"])

    listed = spark.createDataFrame([(p,) for p in primes], "p long")
    dealt = listed.repartition(min(len(primes), shuffle_width(spark)))
    got = {r["p"]: r["residues"] for r in dealt.mapInArrow(remainders, "p long, residues array<long>").collect()}
    return charpoly.from_residues(primes, [got[p] for p in primes])


def _vectors(
    spark: SparkSession, matrix: list[list[int]], roots: list[tuple[int, int]], places: int
) -> list[list[list[float]]]:
    """Unit vectors of each root; a root is a row of a Spark job."""

    def solve(batches):
        for batch in batches:
            for at, root, count in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                found = charpoly.null_vectors(matrix, int(root), places, count)
                row = [pa.array([at], pa.int32()), pa.array([found.tolist()])]
                yield pa.RecordBatch.from_arrays(row, names=["at", "vectors"])

    listed = spark.createDataFrame(
        [(i, str(root), count) for i, (root, count) in enumerate(roots)], "at int, root string, count int"
    )
    dealt = listed.repartition(min(len(roots), shuffle_width(spark)))
    got = dealt.mapInArrow(solve, "at int, vectors array<array<double>>").collect()
    return [r["vectors"] for r in sorted(got, key=lambda r: r["at"])]


def fitted(rows: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> Whitening:
    """The components of all valid vectors with the ``most`` largest eigenvalues over zero.

    The driver holds the matrix of a square of the dimension, its polynomial and the vectors. Eigenvalues under
    2**-200 of the trace count as zero; there are fewer components where the rank is lower, none for one
    vector or for vectors that are all equal.
    """
    spark = rows.sparkSession
    dim = usual_length(rows, vector)
    if not dim:
        return Whitening(0, [], np.zeros((0, 0)), [], [])
    n, sums, matrix = _scatter(rows, vector, dim)
    trace = sum(matrix[i][i] for i in range(dim))
    if not trace:
        return Whitening(n, sums, np.zeros((0, dim)), [], [])
    # Roots of a rounded matrix only say where to look.
    rough = np.linalg.eigvalsh(np.array([[float(Fraction(v, trace)) for v in row] for row in matrix])) * float(trace)
    polynomial = _polynomial(spark, matrix)
    roots, places = charpoly.largest_roots(polynomial, most, list((rough[1:] + rough[:-1]) / 2))
    found = _vectors(spark, matrix, roots, places)
    spread = [root for root, count in roots for _ in range(count)][:most]
    components = np.array([v for of_root in found for v in of_root])[:most]
    return Whitening(
        n,
        sums,
        components,
        [float(Fraction(root, n * n << places)) for root in spread],
        [float(Fraction(root, trace << places)) for root in spread],
    )


def _centred(y: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """y - floor(S / n) in whole numbers and x - S/n, rounded once."""
    floors = np.array([s // model.n for s in model.sums], dtype=np.int64)
    rests = np.array([float(Fraction(s % model.n, model.n)) for s in model.sums])
    whole = y - floors
    return whole, whole - rests


def _projected(y: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(y, model)[1] @ model.components.T / np.array([sqrt(e) for e in model.eigenvalues])


def _deviations(y: np.ndarray, model: Whitening) -> list[int]:
    """Sums over dimensions of (n x - S)**2, exact."""
    whole, n = _centred(y, model)[0], model.n
    rests = [s % n for s in model.sums]
    most = int(np.abs(whole).max()) if whole.size else 0
    if most * most * len(rests) >= 1 << 62 or most * sum(rests) >= 1 << 62:
        whole = whole.astype(object)
    squares = (whole * whole).sum(axis=1).tolist()
    along = (whole * np.array(rests, dtype=whole.dtype)).sum(axis=1).tolist() if sum(rests) < 1 << 62 else [
        sum(int(w) * r for w, r in zip(row, rests)) for row in whole
    ]
    rest = sum(r * r for r in rests)
    return [n * n * a - 2 * n * b + rest for a, b in zip(squares, along)]


def _identity_error(rows: DataFrame, vector: str, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k, dim = model.components.shape
    upper = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(batches: Iterator[pa.RecordBatch]):
        gram, total = np.zeros((k, k)), np.zeros(k)
        for _, y in blocks(batches, dim, SCALE):
            w = _projected(y, model)
            gram, total = gram + w.T @ w, total + w.sum(axis=0)
        values = [gram[i, j] for i, j in upper] + list(total)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["key", "v"])

    parts = rows.select("vec_id", vector).mapInArrow(sums, "key int, v double").groupBy("key").agg(F.sum("v").alias("v"))
    found = {r["key"]: r["v"] for r in parts.collect()}
    # The rows are centred already; what rounding leaves of their means is taken off as well.
    means = [found[len(upper) + i] / model.n for i in range(k)]
    return max(abs(found[at] / model.n - means[i] * means[j] - (i == j)) for at, (i, j) in enumerate(upper))


def whitened(rows: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per kept row and component.

    Rows whose vector is null, holds null or non-finite entries, or has another length than most vectors of
    the table (ties: than the longer ones) are dropped; they are not in the fit list. Repeated rows count
    as often as they occur and each comes back. Without a component (an empty table, one vector, equal vectors)
    there are no rows. A deviation over the range of a long is null. Extra columns are not read.
    """
    spark = rows.sparkSession
    id_type = rows.schema["vec_id"].dataType.simpleString()
    model = fitted(rows, vector, most)
    if not len(model.components):
        return spark.createDataFrame(
            [],
            f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double",
        )
    dim = model.components.shape[1]
    error = _identity_error(rows, vector, model)

    def project(batches: Iterator[pa.RecordBatch]):
        for ids, y in blocks(batches, dim, SCALE):
            w = _projected(y, model)
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel())
            )
            deviation = pa.array([v if v < 1 << 63 else None for v in _deviations(y, model)], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, deviation, values], names=["vec_id", "deviation", "w"])

    found = rows.select("vec_id", vector).mapInArrow(project, f"vec_id {id_type}, deviation long, w array<double>")
    shares = F.array(*[F.lit(s) for s in model.shares])
    return found.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
