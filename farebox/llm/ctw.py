"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions. Each decision has a tree of contexts: the bytes before it, none to
``DEPTH``. Krichevsky-Trofimov estimates at every depth are mixed with the weights that the training
text gives each node, from the deepest contexts up; a context that training never met leaves the
prediction to the one above it. Texts end with a byte that no text holds.

Texts are packed into blocks. A block sends each distinct word and each distinct gram (context and next
byte) once, with its training count, as compressed runs dealt by the keys' hash; each bucket adds its
keys up over all blocks; the model is a table keyed by gram; and a block gets back only the entries it
asked for. Nothing that grows with the corpus is broadcast or gathered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.bytehash import Ranges, flat, lower, mixed, slices, word_bounds
from farebox.llm.common import keyed, stored
from farebox.session import shuffle_width

DEPTH = 5
BLOCK_BYTES = 32 << 20
#: A block lies in rows of so many bytes of text, so that no row of it is large.
PIECE_BYTES = 1 << 20
#: Bytes a task turns into grams at a time.
HELD = 1 << 18
#: Keys a task gathers before it merges them.
LOOSE = 1 << 18
#: A gram and the number of a row in its slice share a word.
ROW_BITS = 64 - 8 * (DEPTH + 1)
WORD, GRAM = 0, 1
END_TOKEN = np.uint64(0x5851F42D4C957F2D)
_BOUNDARY = 0xFF


def _grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and each end: context and byte as one number, and the row."""
    rows = len(bounds) - 1
    pad = DEPTH + 1
    size = np.diff(bounds)
    row_of = np.repeat(np.arange(rows), size)
    line = np.full(len(data) + pad * rows, _BOUNDARY, np.uint8)
    line[np.arange(len(data)) + pad * row_of + DEPTH] = data
    key = np.zeros(max(0, len(line) - DEPTH), np.uint64)
    for i in range(pad):
        key = (key << np.uint64(8)) | line[i : i + len(key)]
    row = np.repeat(np.arange(rows), size + 1)
    at = np.arange(len(row)) + DEPTH * row
    return key[at], row


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word and of one end token a row."""
    start, end, before = word_bounds(data, bounds)
    rows = len(bounds) - 1
    key = mixed(Ranges(data, 5).of(start, end) + (end - start).astype(np.uint64))
    row = np.repeat(np.arange(rows), np.diff(before))
    return np.append(key, np.full(rows, END_TOKEN)), np.append(row, np.arange(rows))


def _tallied(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


class _Tally:
    """Counts by key; parts are merged before they outgrow what they add up to."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.loose = 0

    def add(self, key: np.ndarray, count: np.ndarray) -> None:
        self.parts.append(_tallied(key, count))
        self.loose += len(self.parts[-1][0])
        if self.loose > LOOSE:
            self.parts, self.loose = [self.total()], 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return _tallied(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))


def _blocks(block_bytes: int):
    """Rows into the blocks of a task, numbered: a block is some rows with a compressed table each."""

    def packed(block: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            for part in parts:
                writer.write_batch(part)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "payload"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece_bytes = min(PIECE_BYTES, block_bytes)
        parts, held, block, filled = [], 0, 0, 0
        for batch in batches:
            at = batch.schema.get_field_index("t")
            for part in slices(batch, at, piece_bytes):
                parts.append(part)
                held += len(flat(part.column(at))[0])
                if held >= piece_bytes:
                    yield packed(block, parts)
                    filled += held
                    parts, held = [], 0
                    if filled >= block_bytes:
                        block, filled = block + 1, 0
        if parts:
            yield packed(block, parts)

    return run


def _opened(payload: pa.Scalar) -> Iterator[pa.RecordBatch]:
    """The rows of a block, some hundred thousand bytes of text at a time."""
    for batch in pa.ipc.open_stream(payload.as_buffer()):
        yield from slices(batch, batch.schema.get_field_index("t"), HELD, 1 << min(ROW_BITS, 14))


def _squeezed(values: np.ndarray) -> bytes:
    """Compressed byte plane by byte plane: equal high bytes then lie together."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _loosened(held: pa.Scalar, kind: type, size: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(held.as_buffer(), size * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, size).T).view(kind).ravel()


def _keys_in(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return _squeezed(np.diff(keys, prepend=np.uint64(0)))


def _keys_out(held: pa.Scalar, size: int) -> np.ndarray:
    return np.cumsum(_loosened(held, np.uint64, size), dtype=np.uint64)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(key + END_TOKEN) % np.uint64(buckets)).astype(np.int32)


def _asked(buckets: int):
    """A block's distinct words and grams with their training counts, in runs by bucket.

    A block whose rows meet in several tasks has runs from each of them.
    """

    def runs(block: int, got: dict[int, _Tally]) -> Iterator[pa.RecordBatch]:
        for kind in list(got):
            key, count = got.pop(kind).total()
            bucket = _bucket(key, buckets)
            order = np.argsort(bucket, kind="stable")  # keys stay ascending inside a bucket
            key, count, bucket = key[order], count[order].astype(np.uint64), bucket[order]
            edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            end = np.append(edge[1:], len(key))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(edge), block)),
                    pa.array(bucket[edge]),
                    pa.array(np.full(len(edge), kind, np.int8)),
                    pa.array((end - edge).astype(np.int32)),
                    pa.array([_keys_in(key[i:j]) for i, j in zip(edge, end)], pa.binary()),
                    pa.array([_squeezed(count[i:j]) for i, j in zip(edge, end)], pa.binary()),
                ],
                ["block", "bucket", "kind", "size", "keys", "counts"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, got = None, {}
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != now:
                    if got:
                        yield from runs(now, got)
                    now, got = block, {WORD: _Tally(), GRAM: _Tally()}
                for part in _opened(payload):
                    data, bounds = flat(part.column("t"))
                    data = lower(data)
                    learn = part.column("learn").to_numpy(zero_copy_only=False).astype(np.uint64)
                    key, row = _words(data, bounds)
                    got[WORD].add(key, learn[row].astype(np.int64))
                    key, row = _grams(data, bounds)
                    # The low bit says whether a gram counts, so that one sort does both.
                    held = np.sort(key << np.uint64(1) | learn[row])
                    first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
                    times = np.diff(np.append(first, len(held)))
                    held = held[first]
                    got[GRAM].add(held >> np.uint64(1), times * (held & np.uint64(1)).astype(np.int64))
        if got:
            yield from runs(now, got)

    return run


def _added(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By kind: a bucket's keys and their counts over all blocks."""
    tallies = {WORD: _Tally(), GRAM: _Tally()}
    for batch in table.to_batches():
        kinds, sizes = batch.column("kind").to_pylist(), batch.column("size").to_pylist()
        for kind, size, keys, counts in zip(kinds, sizes, batch.column("keys"), batch.column("counts")):
            tallies[kind].add(_keys_out(keys, size), _loosened(counts, np.uint64, size).view(np.int64))
    return {kind: tally.total() for kind, tally in tallies.items()}


def _totals(table: pa.Table) -> pa.Table:
    """A bucket's grams with their counts; of its words only how many training has, and how often."""
    added = _added(table)
    key, n = added[GRAM]
    words = added[WORD][1]
    kind = np.append(np.full(len(key), GRAM, np.int8), np.int8(WORD))
    return pa.table(
        {"kind": kind, "key": np.append(key.view(np.int64), np.count_nonzero(words)), "n": np.append(n, words.sum())}
    )


def _answered(table: pa.Table, chances: pa.Table) -> pa.Table:
    """For each run: its keys with the words' counts or the grams' log chances."""
    key, count = _added(table)[WORD]
    gram = chances.column("key").to_numpy().view(np.uint64)
    order = np.argsort(gram)
    gram, chance = gram[order], chances.column("value").to_numpy()[order].astype(np.float32)
    out = []
    for batch in table.to_batches():
        values = []
        kinds, sizes = batch.column("kind").to_pylist(), batch.column("size").to_pylist()
        for kind, size, keys in zip(kinds, sizes, batch.column("keys")):
            asked = _keys_out(keys, size)
            if kind == WORD:
                values.append(_squeezed(count[np.searchsorted(key, asked)].astype(np.uint64)))
            else:
                values.append(_squeezed(chance[np.searchsorted(gram, asked)]))
        columns = {c: batch.column(c) for c in ("block", "kind", "size", "keys")}
        out.append(pa.table({**columns, "values": pa.array(values, pa.binary())}))
    return pa.concat_tables(out)


def _scored(total: int, distinct: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        known = {}
        for wanted, value_type in ((WORD, np.uint64), (GRAM, np.float32)):
            keys, values = [np.empty(0, np.uint64)], [np.empty(0)]
            for batch in answers.to_batches():
                kinds, sizes = batch.column("kind").to_pylist(), batch.column("size").to_pylist()
                for kind, size, key, value in zip(kinds, sizes, batch.column("keys"), batch.column("values")):
                    if kind == wanted:
                        keys.append(_keys_out(key, size))
                        values.append(_loosened(value, value_type, size).astype(float))
            key = np.concatenate(keys)
            order = np.argsort(key)
            known[wanted] = key[order], np.concatenate(values)[order]
        out = []
        for payload in table.column("payload").combine_chunks():
            for part in _opened(payload):
                data, bounds = flat(part.column("t"))
                data = lower(data)
                rows = part.num_rows
                key, row = _words(data, bounds)
                count = known[WORD][1][np.searchsorted(known[WORD][0], key)]
                base = np.log10((count + 1) / (total + distinct + 1))
                key, row2 = _grams(data, bounds)
                packed = np.sort(key << np.uint64(ROW_BITS) | row2.astype(np.uint64))
                first = np.flatnonzero(np.append(True, packed[1:] != packed[:-1]))
                times = np.diff(np.append(first, len(packed)))
                packed = packed[first]
                logs = known[GRAM][1][np.searchsorted(known[GRAM][0], packed >> np.uint64(ROW_BITS))]
                score = np.bincount((packed & np.uint64((1 << ROW_BITS) - 1)).astype(np.int64), logs * times, rows)
                out.append(
                    pa.table(
                        {
                            "doc_id": part.column("id"),
                            "n_tokens": np.bincount(row, minlength=rows).astype(np.int64),
                            "n_known": np.bincount(row, count > 0, rows).astype(np.int64),
                            "base_score": np.bincount(row, base, rows),
                            "score": score,
                            "n_bytes": np.diff(bounds),
                            "held_out": part.column("held_out"),
                        }
                    )
                )
        return pa.concat_tables(out) if out else None

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of x >= 1/2: Stirling's series seven above, taken back down."""
    z = x + 7
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6))


class Level(NamedTuple):
    """Nodes of one depth, ascending: counts of both bits, log weight, the estimate's own share, and, for
    the nodes of the depth below, which of these is above each."""

    node: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    weight: np.ndarray
    own: np.ndarray
    above: np.ndarray | None

    @property
    def one(self) -> np.ndarray:
        return (self.n1 + 0.5) / (self.n0 + self.n1 + 1)


def _level(node, n0, n1, below, above=None) -> Level:
    """``below``: the summed log weights of the depth below, None at the deepest."""
    alone = _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - math.log(math.pi)
    if below is None:
        return Level(node, n0, n1, alone, np.ones(len(node)), above)
    weight = np.logaddexp(alone, below) - math.log(2)
    return Level(node, n0, n1, weight, 1 / (1 + np.exp(np.minimum(below - alone, 700.0))), above)


def _raised(level: Level, depth: int) -> Level:
    """The nodes one depth up: a node's parent drops the oldest byte of its context."""
    node, above = np.unique(level.node & ((1 << (8 * (depth + 1))) - 1), return_inverse=True)
    n = len(node)
    sums = [np.bincount(above, x, n) for x in (level.n0, level.n1, level.weight)]
    return _level(node, *sums, above)


def _lowered(level: Level, stop, total, left) -> tuple[np.ndarray, ...]:
    """Predictions pass down a depth. ``stop``: the chance of a 1 if the mix ends above; ``total`` and
    ``left``: the mix so far and the weight not yet given out, all by node of ``level``."""
    met = level.n0 + level.n1 > 0
    return (
        np.where(met, total + left * level.one, stop),
        np.where(met, total + left * level.own * level.one, stop),
        np.where(met, left * (1 - level.own), 0.0),
    )


#: Grams that share so many last bytes of context meet in one task.
NEAR = 2


def _grown(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, Level]]:
    """A task's grams: keys, and bit and deepest node of the eight decisions of each; its levels."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    key = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64)
    count = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)
    byte, context = key & 0xFF, key >> 8
    node = np.concatenate([context << 8 | (1 << i | byte >> (8 - i)) for i in range(8)])
    bit = np.concatenate([byte >> (7 - i) & 1 for i in range(8)])
    unique, of = np.unique(node, return_inverse=True)
    n = len(unique)
    both = [np.bincount(of, np.tile(count, 8) * (bit == b), n).astype(float) for b in (0, 1)]
    levels = {DEPTH: _level(unique, *both, None)}
    for depth in range(DEPTH - 1, NEAR - 1, -1):
        levels[depth] = _raised(levels[depth + 1], depth)
    return key, bit, of, levels


def _upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    level = _grown(batches)[3][NEAR]
    yield pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (level.node, level.n0, level.n1, level.weight)], ["node", "n0", "n1", "weight"]
    )


def _predicted(buckets: int, node: np.ndarray, stop: np.ndarray, total: np.ndarray, left: np.ndarray):
    """The last three for each of the nodes at depth NEAR - 1, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bit, of, levels = _grown(batches)
        at = np.searchsorted(node, levels[NEAR].node & ((1 << (8 * NEAR)) - 1))
        now = _lowered(levels[NEAR], stop[at], total[at], left[at])
        for depth in range(NEAR + 1, DEPTH + 1):
            above = levels[depth - 1].above
            now = _lowered(levels[depth], *[x[above] for x in now])
        one = now[0][of]
        value = np.log10(np.where(bit == 1, one, 1 - one)).reshape(8, -1).sum(axis=0)
        for low in range(0, len(key), 1 << 16):
            some = slice(low, low + (1 << 16))
            bucket = _bucket(key[some].view(np.uint64), buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(key[some]), pa.array(value[some])], ["bucket", "key", "value"]
            )

    return run


def model(grams: DataFrame, buckets: int) -> DataFrame:
    """(bucket, key, value): log10 of the probability of each gram's byte after its context.

    ``grams`` (key, n) holds every gram to be scored once, with training counts that may be 0. A node is
    a context and the bits of the byte so far. Grams that share the last two bytes of context meet in
    one task, which works out all deeper nodes. The depths above are sums over those tasks, of at most
    65,280 and 255 nodes; these, and nothing that grows, pass through the driver.
    """
    suffix = F.shiftright("key", 8).bitwiseAND((1 << (8 * NEAR)) - 1)
    near = grams.select("key", "n").repartition(shuffle_width(grams.sparkSession), suffix)
    top = near.mapInArrow(_upper, "node long, n0 double, n1 double, weight double")
    rows = (
        top.groupBy(F.col("node").bitwiseAND((1 << (8 * NEAR)) - 1).alias("node"))
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weight").alias("below"))
        .orderBy("node")
        .toPandas()
    )
    level = _level(*[rows[c].to_numpy() for c in ("node", "n0", "n1", "below")])
    chain = [level]
    for depth in range(NEAR - 2, -1, -1):
        chain.append(_raised(chain[-1], depth))
    root = chain[-1]
    now = root.one, root.own * root.one, 1 - root.own
    for lower_level, upper_level in zip(chain[-2::-1], chain[::-1]):
        now = _lowered(lower_level, *[x[upper_level.above] for x in now])
    return near.mapInArrow(_predicted(buckets, level.node, *now), "bucket int, key long, value double")


def scored(docs: DataFrame, folds: int = 7, held: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: the base score, the model's score and its code length per byte.

    A null text is empty: its only token and only byte is the end. Rows that repeat each other count
    and score as often as they occur; a null doc_id is not held out; words are told apart by 64-bit
    hashes, grams exactly. Other columns are not read.
    """
    out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % folds == held, F.lit(False))
    rows = keyed(docs).select("id", (~out).alias("learn"), out.alias("held_out"), "t")
    number = F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("block")
    blocks = stored(
        rows.mapInArrow(_blocks(block_bytes), "block long, payload binary").select(number.alias("block"), "payload")
    )
    buckets = max(blocks.select("block").distinct().count(), shuffle_width(docs.sparkSession))
    asked = stored(
        blocks.mapInArrow(
            _asked(buckets), "block long, bucket int, kind byte, size int, keys binary, counts binary"
        )
    )
    totals = stored(asked.groupBy("bucket").applyInArrow(_totals, "kind byte, key long, n long"))
    seen = totals.where(F.col("kind") == WORD).agg(F.sum("n").alias("total"), F.sum("key").alias("distinct")).first()
    total, distinct = seen["total"] or 0, seen["distinct"] or 0
    chances = stored(model(totals.where(F.col("kind") == GRAM), buckets))
    answers = (
        asked.groupBy("bucket")
        .cogroup(chances.groupBy("bucket"))
        .applyInArrow(_answered, "block long, kind byte, size int, keys binary, values binary")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _scored(total, distinct),
            f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double, n_bytes long, held_out boolean",
        )
    )
    return result.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
