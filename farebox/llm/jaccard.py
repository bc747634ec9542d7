"""Near-copies by n-gram Jaccard similarity: candidates by MinHash bands, Bayesian pruning, exact check.

Texts with one set of shingles are one class from the start. Classes that share a band fall into one
group; a group is compared in blocks against blocks inside tasks, so that a group of any size makes
rows in proportion to its members and blocks, never a row per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.bytehash import Ranges, flat, kept, lower, mixed, slices, word_bounds
from farebox.llm.common import keyed, sized, stored
from farebox.llm.components import components

N = 5
THRESHOLD = 0.8
#: A pair at the threshold shares none of the bands with probability (1 - 0.8**4)**32, about 5e-8.
BANDS, ROWS = 32, 4
#: MinHash values compared between two looks at the posterior, and the probability it may give away.
STEP, TOLERANCE = 16, 1e-7
#: A block holds so many classes, or so many bytes of shingles.
BLOCK, BLOCK_BYTES = 512, 16 << 20


def _hashers(count: int) -> tuple[np.ndarray, np.ndarray]:
    if ("hashers", count) not in kept():
        rng = np.random.default_rng(41)
        kept()["hashers", count] = (
            (rng.integers(0, 2**31, count, dtype=np.int64) * 2 + 1).astype(np.uint32),
            rng.integers(0, 2**32, count, dtype=np.int64).astype(np.uint32),
        )
    return kept()["hashers", count]


def signature(shingles: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """Least value of each hash over the set."""
    a, b = _hashers(count)
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(count, 0xFFFFFFFF, np.uint32)
    for low in range(0, len(x), 512):
        values = x[None, low : low + 512] * a[:, None] + b[:, None]
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x85EBCA6B)
        np.minimum(out, values.min(axis=1), out=out)
    return out


def shingle_sets(column: pa.Array, n: int = N) -> list[np.ndarray]:
    """Per row the ascending distinct hashes of its runs of ``n`` words, A-Z in lower case.

    A text of fewer words is one shingle; a text without words has none.
    """
    data, bounds = flat(column)
    data = lower(data)
    start, end, before = word_bounds(data, bounds)
    word = Ranges(data, 5).of(start, end)
    word = mixed(word + (end - start).astype(np.uint64))
    row_of = np.searchsorted(before, np.arange(len(word)), "right") - 1
    sets = []
    run = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for i in range(n):
        run = mixed(run * np.uint64(0x2545F4914F6CDD1D) + word[i : i + len(run)])
    for row in range(len(bounds) - 1):
        low, high = int(before[row]), int(before[row + 1])
        if high - low >= n:
            sets.append(np.unique(run[low : high - n + 1]))
        elif high > low:
            short = np.zeros(1, np.uint64)
            for i in range(low, high):
                short = mixed(short * np.uint64(0x2545F4914F6CDD1D) + word[i])
            sets.append(mixed(short + np.uint64(high - low)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def set_name(shingles: np.ndarray) -> bytes:
    """16 bytes that stand for the set: two sums of independent hashes of its members."""
    one = int(mixed(shingles + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)) + len(shingles)
    two = int(mixed(shingles * np.uint64(0xD6E8FEB86659FD93) + np.uint64(7)).sum(dtype=np.uint64)) + len(shingles)
    return (one % 2**64).to_bytes(8, "big") + (two % 2**64).to_bytes(8, "big")


def _described(n: int, with_sets: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 19, 4096):
                sets = shingle_sets(part.column(2), n)
                names = pa.array([set_name(s) for s in sets], pa.binary())
                if with_sets:
                    yield pa.RecordBatch.from_arrays(
                        [names, pa.array([s.tobytes() for s in sets], pa.binary())], ["c", "shingles"]
                    )
                    continue
                bands = []
                for s in sets:
                    if not len(s):
                        bands.append([])
                        continue
                    rows = signature(s).reshape(BANDS, ROWS).astype(np.uint64)
                    key = np.arange(BANDS, dtype=np.uint64)
                    for i in range(ROWS):
                        key = mixed(key * np.uint64(0x2545F4914F6CDD1D) + rows[:, i])
                    bands.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), names, pa.array([len(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                    ["id", "h", "c", "size", "bands"],
                )

    return run


def least_matches(threshold: float, step: int, count: int, tolerance: float) -> tuple[int, ...]:
    """For each look, the fewest equal values that keep a pair.

    With a flat prior, the similarity after m equal values of n is Beta(m + 1, n - m + 1), and it
    reaches the threshold with the probability that a Binomial(n + 1, threshold) is at most m.
    """
    at = ("least_matches", threshold, step, count, tolerance)
    if at in kept():
        return kept()[at]
    needed = []
    for n in range(step, count + 1, step):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        needed.append(m)
    return kept().setdefault(at, tuple(needed))


def links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (left[i], right[i]) reach the threshold."""
    sizes = np.array([len(s) for s in sets])
    small, large = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
    alive = np.flatnonzero(small >= threshold * large - 1e-9)
    marks = np.stack([signature(s) for s in sets]) if sets else np.empty((0, BANDS * ROWS), np.uint32)
    equal = np.zeros(len(alive), np.int32)
    for look, needed in enumerate(least_matches(threshold, STEP, BANDS * ROWS, TOLERANCE)):
        some = slice(look * STEP, look * STEP + STEP)
        for low in range(0, len(alive), 1 << 16):
            pairs = alive[low : low + (1 << 16)]
            equal[low : low + (1 << 16)] += (marks[left[pairs], some] == marks[right[pairs], some]).sum(axis=1, dtype=np.int32)
        kept = equal >= needed
        alive, equal = alive[kept], equal[kept]
    # The exact check: shared shingles of all surviving pairs at once, a run of shingles at a time.
    out = np.zeros(len(left), bool)
    if not len(alive):
        return out
    used = np.unique(np.concatenate([left[alive], right[alive]]))
    place = np.full(len(sets), -1)
    place[used] = np.arange(len(used))
    owner = np.repeat(np.arange(len(used)), sizes[used])
    known, column, times = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    common = times[column] > 1
    renumbered = np.cumsum(times > 1) - 1
    owner, column = owner[common], renumbered[column[common]]
    shared = np.zeros((len(used), len(used)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 2048
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        held = np.zeros((len(used), width), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        shared += held @ held.T
    both = shared[place[left[alive]], place[right[alive]]].astype(np.int64)
    either = sizes[left[alive]] + sizes[right[alive]] - both
    out[alive] = both >= threshold * either - 1e-9
    return out


def _compare(threshold: float):
    def run(key: tuple[Any, ...], block: pd.DataFrame) -> pd.DataFrame:
        x, y = int(key[1]), int(key[2])
        block = block.sort_values("c")
        sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
        n = len(sets)
        part = block["b"].to_numpy()
        left, right = np.triu_indices(n, 1)
        if x != y:  # pairs inside a block are the block's own
            across = part[left] != part[right]
            left, right = left[across], right[across]
        met = links(sets, left, right, threshold)
        left, right = left[met], right[met]
        copies = block["copies"].to_numpy()
        count = np.zeros(n, np.int64)
        np.add.at(count, left, copies[right])
        np.add.at(count, right, copies[left])
        root = np.arange(n)
        while True:  # least label of the block's own components
            new = root.copy()
            np.minimum.at(new, left, root[right])
            np.minimum.at(new, right, root[left])
            new = new[new]
            if (new == root).all():
                break
            root = new
        names = block["c"].to_numpy()
        kept = count > 0
        return pd.DataFrame({"c": names[kept], "root": names[root[kept]], "links": count[kept]})

    return run


def joined(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, and ``first`` (one row of each class).

    class_id is the least doc_id of the texts that links connect, n_links the number of other rows
    within the threshold. Equal texts are linked; texts without words, null ones too, equal each other.
    Rows that repeat each other are rows of one class. Null ids come last: they name a class, and are its
    first row, only where it has no other. Classes are told apart by class_id as far as ids are unique.
    Shingles are told apart by 64-bit hashes.
    """
    rows = keyed(docs).select("id", "h", "t")
    key = f"id {docs.schema['doc_id'].dataType.simpleString()}, h long"
    marked = stored(rows.mapInArrow(_described(n, False), f"{key}, c binary, size long, bands array<long>"))
    where = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    classes = stored(
        marked.groupBy("c").agg(
            F.count("*").alias("copies"),
            F.min("id").alias("least"),
            F.min(where).alias("one"),
            F.first("size").alias("size"),
        )
    )
    # Classes that share a band: a star around the least class of each band makes the groups.
    banded = marked.select("c", F.explode("bands").alias("band")).distinct()
    stars = banded.groupBy("band").agg(F.min("c").alias("m"), F.max("c").alias("x")).where("m <> x").select("band", "m")
    group = components(banded.join(stars, "band").select(F.col("c").alias("a"), F.col("m").alias("b")))
    group = stored(group.join(classes, F.col("node") == F.col("c")).select("c", "root", "copies", "one", "size"))
    blocks = group.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") * 8 / BLOCK_BYTES)).cast("int").alias("nb")
    )
    of = group.join(blocks, "root").withColumn("b", F.pmod(F.xxhash64("c"), F.col("nb")).cast("int"))
    wanted = sized(stored(of.select("one.id", "one.h")))
    text = rows.alias("r").join(wanted.alias("o"), F.expr("r.id <=> o.id and r.h = o.h")).select("t")
    sets = text.select(F.lit(0).alias("x"), F.lit(0).alias("y"), "t").mapInArrow(_described(n, True), "c binary, shingles binary")
    placed = sets.dropDuplicates(["c"]).join(of.select("c", "root", "copies", "b", "nb"), "c").select(
        "c", "shingles", "root", "copies", "b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other")
    )
    found = stored(
        placed.select(
            "c", "shingles", "copies", "b", "root", F.least("b", "other").alias("x"), F.greatest("b", "other").alias("y")
        )
        .groupBy("root", "x", "y")
        .applyInPandas(_compare(threshold), "c binary, root binary, links long")
    )
    counted = found.groupBy("c").agg(F.sum("links").alias("links"))
    near = components(found.select(F.col("c").alias("a"), F.col("root").alias("b")))
    whole = stored(
        classes.join(near, F.col("c") == F.col("node"), "left")
        .join(counted.withColumnRenamed("c", "d"), F.col("c") == F.col("d"), "left")
        .select("c", "copies", "least", "one", F.coalesce("root", "c").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    named = whole.groupBy("root").agg(F.min("least").alias("class_id"), F.min("one").alias("first"))
    of_class = whole.join(named, "root").select("c", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "first")
    return marked.join(of_class, "c").select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "h", where.eqNullSafe(F.col("first")).alias("first")
    )


def one_of_each(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` but for near-copies: of each class the row with the least doc_id stays.

    Rows that repeat that row's id and text are copies of it, and one of them stays. All columns come back.
    """
    rows = keyed(docs).select("row", "id", "h")
    firsts = joined(docs, n, threshold).where("first").groupBy(F.col("doc_id").alias("id"), "h")
    firsts = sized(stored(firsts.agg(F.count("*").alias("times"))))
    kept = rows.alias("a").join(firsts.alias("b"), F.expr("a.id <=> b.id and a.h = b.h")).select("row", "a.id", "a.h", "times")
    # Only rows that occur more than once have to meet each other.
    once = kept.where("times = 1").unionByName(kept.where("times > 1").dropDuplicates(["id", "h"]))
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
