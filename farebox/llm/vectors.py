"""Vectors of a table as numpy blocks, and sums over all of them that stay exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries beyond this many binary places stand at the bound, as a cast to long would leave them.
MOST = 1 << 60
_BITS = 31
_PARTS = 5
SUMS = "key long, " + ", ".join(f"p{i} long" for i in range(_PARTS))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The most common number of components (ties: the larger); 0 for a table without vectors."""
    held = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0))
    first = held.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def blocks(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, floor(scale * entry) as int64) of the vectors with ``dim`` components, none null or non-finite.

    ``scale`` is a power of two, so the product is exact.
    """
    for batch in batches:
        lists = batch.column(1)
        fit = pc.fill_null(pc.equal(pc.list_value_length(lists), dim), False)
        ids, lists = batch.column(0).filter(fit), lists.filter(fit)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), dim)
        whole = np.isfinite(values).all(axis=1)
        if not whole.all():
            ids, values = ids.filter(pa.array(whole)), values[whole]
        with np.errstate(over="ignore"):
            yield ids, np.clip(np.floor(values * scale), -float(MOST), float(MOST)).astype(np.int64)


def exact_gram(y: np.ndarray) -> np.ndarray:
    """The integer matrix of inner products of columns, as Python integers, by exact products of doubles."""
    limbs, low = [], y
    while low.size and (low.max() >= 1 << 20 or low.min() < -(1 << 20)):
        limbs.append((low & ((1 << 20) - 1)).astype(np.float64))
        low = low >> 20
    limbs.append(low.astype(np.float64))
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    # 4096 products under 2**40 stay under 2**53.
    for start in range(0, len(y), 4096):
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                part = a[start : start + 4096].T @ b[start : start + 4096]
                total = total + part.astype(np.int64).astype(object) * (1 << (20 * (i + j)))
    return total


def exact_sums(y: np.ndarray) -> np.ndarray:
    """Sums of columns as Python integers."""
    high, low = y >> 30, y & ((1 << 30) - 1)
    return high.sum(axis=0).astype(object) * (1 << 30) + low.sum(axis=0).astype(object)


def sum_rows(keys: list[int], values: list[int]) -> pa.RecordBatch:
    """Integers of any size up to 150 bits, cut into parts that Spark adds up as longs."""
    low = (1 << _BITS) - 1
    parts = [[(int(v) >> (_BITS * i)) & low for v in values] for i in range(_PARTS - 1)]
    parts.append([int(v) >> (_BITS * (_PARTS - 1)) for v in values])
    columns = [pa.array(c, pa.int64()) for c in [keys, *parts]]
    return pa.RecordBatch.from_arrays(columns, names=["key", *[f"p{i}" for i in range(_PARTS)]])


def added(rows: DataFrame) -> dict[int, int]:
    """The sums of rows made by ``sum_rows``, per key; as many rows reach the driver as there are keys."""
    sums = rows.groupBy("key").agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in range(_PARTS)])
    return {r["key"]: sum(r[f"p{i}"] << (_BITS * i) for i in range(_PARTS)) for r in sums.collect()}
