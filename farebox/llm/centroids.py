"""Centroid clustering in whole numbers, with Ptolemaic lower bounds in front of the exact distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import stored
from farebox.llm.vectors import SUMS, added, blocks, exact_sums, sum_rows

CENTROIDS = 8
ROUNDS = 10
DIM = 64
SCALE = 1024

#: More than the relative error of a few roundings of doubles.
SLACK = 2.0**-48


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to the point ``c``."""
    diff = x - c
    if diff.size and (diff.max() >= 1 << 27 or diff.min() <= -(1 << 27)):
        wide = diff.astype(object)
        return (wide * wide).sum(axis=1)
    return np.einsum("ij,ij->i", diff, diff)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def nearest(
    x: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, exact squared distance) per row of ``x``, ties to the smaller number, and how many
    distances were computed.

    For a vector v, a centroid c and pivots p and q, Ptolemy's inequality gives
    d(v,c) d(p,q) >= |d(v,p) d(c,q) - d(v,q) d(c,p)|. ``cached`` holds d(v,p). The bound is lowered by more
    than its rounding error; only a centroid whose bound lies strictly over an exact distance is left out.
    """
    k = len(centroids)
    of_centroid = np.array([_roots(_squares(pivots, c)) for c in centroids])
    bound = np.zeros((len(x), k))
    for p in range(len(pivots)):
        q = (p + 1) % len(pivots)
        apart = _roots(_squares(pivots[p : p + 1], pivots[q]))[0]
        if apart == 0:
            continue
        a = cached[:, p, None] * of_centroid[None, :, q]
        b = cached[:, q, None] * of_centroid[None, :, p]
        np.maximum(bound, (np.abs(a - b) - SLACK * (a + b)) / apart, out=bound)
    bound = bound * bound * (1 - 8 * SLACK)
    cluster = bound.argmin(axis=1)
    best = _squares(x, centroids[cluster])
    checked = len(x)
    for j in range(k):
        open_ = np.flatnonzero((bound[:, j] <= best.astype(np.float64)) & (cluster != j))
        if not len(open_):
            continue
        checked += len(open_)
        found = _squares(x[open_], centroids[j])
        better = (found < best[open_]) | ((found == best[open_]) & (j < cluster[open_]))
        if found.dtype == object and best.dtype != object:
            best = best.astype(object)
        best[open_[better]] = found[better]
        cluster[open_[better]] = j
    return cluster, best, checked


def _held(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        yield batch.column(0), x, batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _list_column(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * width, pa.int32()), pa.array(rows.ravel(), kind))


def _starts(rows: DataFrame, vector: str, k: int, dim: int, scale: int, salt: int) -> np.ndarray:
    """The ``k`` kept vectors with the smallest hashes of their ids; vectors of one id go by their entries."""
    whole = F.expr(
        f"vector IS NOT NULL AND size(vector) = {dim} AND NOT exists(vector, x -> x IS NULL OR isnan(x)"
        " OR abs(x) = double('infinity'))"
    )
    named = rows.select(F.col("vec_id"), F.col(vector).alias("vector")).where(whole)
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = named.orderBy(F.asc_nulls_last(digest), "vector").limit(k).collect()
    listed = pa.array([list(r["vector"]) for r in first], pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(first)), pa.int64()), listed], names=["id", "vector"])
    return next(blocks(iter([batch]), dim, scale))[1]


def clustered(
    rows: DataFrame,
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dim: int = DIM,
    scale: int = SCALE,
    salt: int = 3,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Kept are vectors of ``dim`` components, none null or non-finite; entries become floor(scale * entry).
    The first centroids are the ``k`` kept vectors with the smallest sha256 of ``salt:vec_id`` (a null id
    comes last, equal ids go by their entries); fewer vectors make fewer centroids, an empty table gives no
    rows. Repeated rows count as often as they occur. Every round is one pass over a stored table that holds
    each vector beside its distances to the pivots, which are the first centroids; sums leave a task as one
    row per centroid and component. A distance or inertia over the range of a long is null.
    """
    spark = rows.sparkSession
    id_type = rows.schema["vec_id"].dataType.simpleString()
    centroids = _starts(rows, vector, k, dim, scale, salt)
    result = f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], result)
    pivots = centroids

    def prepare(batches):
        for ids, x in blocks(batches, dim, scale):
            far = np.stack([_roots(_squares(x, p)) for p in pivots], axis=1)
            columns = [ids, _list_column(x, pa.int64()), _list_column(far, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "x", "far"])

    table = stored(
        rows.select("vec_id", vector).mapInArrow(prepare, f"vec_id {id_type}, x array<long>, far array<double>")
    )

    def round_sums(centroids):
        def sums(batches):
            total = np.zeros((len(centroids), dim + 1), dtype=object)
            for _, x, far in _held(batches, dim):
                cluster, _, _ = nearest(x, far, centroids, pivots)
                for j in range(len(centroids)):
                    mine = x[cluster == j]
                    total[j, :dim] += exact_sums(mine)
                    total[j, dim] += len(mine)
            yield sum_rows(list(range(total.size)), list(total.ravel()))

        return sums

    for _ in range(rounds):
        found = added(table.mapInArrow(round_sums(centroids), SUMS))
        moved = centroids.copy()
        for j in range(len(centroids)):
            count = found[j * (dim + 1) + dim]
            if count:
                moved[j] = [found[j * (dim + 1) + i] // count for i in range(dim)]
        centroids = moved

    def assign(batches):
        for ids, x, far in _held(batches, dim):
            cluster, best, _ = nearest(x, far, centroids, pivots)
            whole = [v if v < 1 << 63 else None for v in best.tolist()]
            columns = [ids, pa.array(cluster, pa.int32()), pa.array(whole, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    last = stored(table.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance long"))
    inertia = {
        r["cluster"]: r["inertia"]
        for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    }
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def whole(value: int | None):
        return F.lit(None if value is None or value >= 1 << 63 else int(value)).cast("long")

    of_cluster = F.array(*[whole(inertia.get(j, 0)) for j in range(len(centroids))])
    over_all = None if None in inertia.values() else sum(inertia.values())
    return last.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(of_cluster, F.col("cluster")).alias("cluster_inertia"),
        whole(over_all).alias("inertia"),
        F.get(F.array(*[F.lit(d) for d in digests]), F.col("cluster")).alias("centroid_sha256"),
    )
