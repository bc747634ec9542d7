"""Repeated byte strings by a depth-limited radix sort of content-chosen suffixes.

Every window of ``depth`` bytes is represented by the least-hashed short gram in it, so equal windows
choose equal grams at equal offsets and only one suffix in some eighty is sorted. The passes take the
most significant digit first: the gram; the whole stretch of windows that chose it; then, for stretches
that share a gram but differ, runs of a few windows with equal offsets, by the bytes all of them hold;
and last each window by itself. Only groups of two or more reach the next pass, and the groups equal to
full depth are the repeated windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.bytehash import Ranges, flat, mixed, slices
from farebox.llm.common import keyed, sized, stored

DEPTH = 200
GRAM = 32
#: Offsets in a run of windows.
RUN = 24
#: Bytes whose hashes a task holds at once; longer texts are taken in runs of windows.
HELD = 1 << 19
_PLACE = np.uint64((1 << 22) - 1)
#: A stretch in one number: 15 bits of the text's hash, first window, offset of the gram, windows.
_TAG, _BEGIN, _OFFSET = 47, 16, 8


def _packed(tag, begin, offset, count) -> np.ndarray:
    return (tag << _TAG) | (begin << _BEGIN) | (offset << _OFFSET) | count


def _tag() -> Column:
    return F.col("h").bitwiseAND(0x7FFF)


def _stretches(data: np.ndarray, bounds: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For runs of rows or of windows: row, first window, offset of the gram, windows, gram hash, stretch hash."""
    width = depth - GRAM + 1
    row = 0
    while row < len(bounds) - 1:
        low = int(bounds[row])
        if bounds[row + 1] - low > HELD:  # one long row, run by run; runs overlap by a window
            last = int(bounds[row + 1]) - depth
            for at in range(low, last + 1, HELD):
                high = min(at + HELD, last + 1)
                got = _run(data[at : high + depth - 1], np.array([0, high + depth - 1 - at]), depth, width)
                if got is not None:
                    yield (got[0] + row, got[1] + at - low, *got[2:])
            row += 1
            continue
        top = int(np.searchsorted(bounds, low + HELD, "right")) - 1
        got = _run(data[low : int(bounds[top])], bounds[row : top + 1] - low, depth, width)
        if got is not None:
            yield (got[0] + row, *got[1:])
        row = top


def _run(data: np.ndarray, bounds: np.ndarray, depth: int, width: int):
    n = len(data) - depth + 1
    if n < 1:
        return None
    valid = np.ones(n, bool)
    for end in bounds[1:]:
        valid[max(0, end - depth + 1) : end] = False
    grams = Ranges(data, 1)
    key = grams.grams(GRAM)
    least = (key & ~_PLACE) | np.arange(len(key), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    starts = np.flatnonzero(valid[: len(least)])
    if not len(starts):
        return None
    anchor = (least[starts] & _PLACE).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin, anchor = starts[first], anchor[first]
    stretch = Ranges(data, 2).of(begin, begin + count + depth - 1)
    stretch = mixed(stretch ^ ((anchor - begin) << 32 | count).astype(np.uint64))
    row = np.searchsorted(bounds, begin, "right") - 1
    return row, begin - bounds[row], anchor - begin, count, key[anchor], stretch


def _anchors(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, HELD * 8):
                data, bounds = flat(part.column(2))
                tags = part.column(1).to_numpy()
                for row, begin, offset, count, gram, stretch in _stretches(data, bounds, depth):
                    w = _packed(tags[row], begin, offset, count)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(row)), pa.array(w), pa.array(gram.view(np.int64)), pa.array(stretch.view(np.int64))],
                        ["id", "w", "a", "b"],
                    )

    return run


def _listed(batches: Iterator[pa.RecordBatch]):
    """Per document and some thousands of its listed stretches: ids, tag, bytes from ``base`` on, stretches."""
    for batch in batches:
        for i in range(batch.num_rows):
            data, _ = flat(batch.column(2).slice(i, 1))
            w = np.sort(batch.column(3)[i].values.to_numpy())
            begin, offset, count = w >> _BEGIN & 0x7FFFFFFF, w >> _OFFSET & 255, w & 255
            for low in range(0, len(w), 4096):
                some = slice(low, low + 4096)
                base, top = int(begin[low]), int((begin[some] + count[some]).max()) + 256
                yield batch.column(0).slice(i, 1), int(w[0] >> _TAG), data[base:top], base, begin[some], offset[some], count[some]


def _each(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers first, first + 1, ... of each, and whose they are."""
    owner = np.repeat(np.arange(len(count)), count)
    return np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner], owner


def _runs(depth: int):
    """The listed stretches cut at fixed offsets from their gram: by the bytes that all windows of a run
    hold (a) and by the bytes that any of them holds (b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id, tag, data, base, begin, offset, count in _listed(batches):
            low = (offset - count + 1) // RUN
            piece, of = _each(low, offset // RUN - low + 1)
            most = np.minimum(offset[of], piece * RUN + RUN - 1)
            least = np.maximum(offset[of] - count[of] + 1, piece * RUN)
            gram = begin[of] + offset[of]
            first, n = gram - most, most - least + 1
            core = Ranges(data, 3).of(gram - piece * RUN - base, gram - piece * RUN - RUN + 1 + depth - base)
            union = Ranges(data, 4).of(first - base, first + n + depth - 1 - base)
            core = mixed(core + piece.astype(np.uint64))
            union = mixed(union ^ (most << 8 | n).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    id.take(pa.array(np.zeros(len(of), np.int64))),
                    pa.array(_packed(tag, first, most, n)),
                    pa.array(core.view(np.int64)),
                    pa.array(union.view(np.int64)),
                ],
                ["id", "w", "a", "b"],
            )

    return run


def _windows(depth: int):
    """Each window of the listed runs, by two hashes of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id, tag, data, base, begin, _, count in _listed(batches):
            at, _ = _each(begin, count)
            one, two = (Ranges(data, seed).of(at - base, at - base + depth) for seed in (3, 4))
            yield pa.RecordBatch.from_arrays(
                [
                    id.take(pa.array(np.zeros(len(at), np.int64))),
                    pa.array(_packed(tag, at, 0, 1)),
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                ],
                ["id", "w", "a", "b"],
            )

    return run


def _digit(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups by (a, b): rows whose pair is met twice, and rows that share ``a`` but not ``b`` with others,
    with one row of every pair met twice beside them.

    Counts are summed before the shuffle and written down, so that locations travel only by joins of
    stored tables, whose large partitions can be split. A row that meets no other in ``a`` ends here.
    """
    shared = stored(
        rows.groupBy("a")
        .agg(F.count("*").alias("n"), F.min("b").alias("least"), F.max("b").alias("most"))
        .where("n > 1")
        .select("a", (F.col("least") == F.col("most")).alias("alike"))
    )
    live = stored(rows.join(shared, "a"))
    mixed_rows = live.where("not alike").drop("alike")
    pairs = stored(mixed_rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("id", "w")).alias("one")))
    counted = stored(mixed_rows.join(pairs, ["a", "b"]).select("id", "w", "n", F.struct("id", "w").eqNullSafe(F.col("one")).alias("one")))
    sure = live.where("alike").select("id", "w").unionByName(counted.where("n > 1").select("id", "w"))
    return sure, counted.where("n = 1 or one").select("id", "w")


def _reread(rows: DataFrame, open_rows: DataFrame, function, schema: str) -> DataFrame:
    """Runs ``function`` over the texts of the documents that ``open_rows`` names, each text once."""
    tag = F.shiftright("w", _TAG)
    marks = open_rows.groupBy("id", tag.alias("tag")).agg(F.collect_list("w").alias("marks"))
    joined = rows.alias("r").join(marks.alias("m"), F.expr("r.id <=> m.id and r.tag = m.tag"))
    return stored(joined.select("r.id", "r.tag", "t", "marks").mapInArrow(function, schema))


def repeated(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(id, tag, start, end): stretches of bytes whose every window of ``depth`` bytes starts elsewhere too.

    Strings are told apart by two independent 64-bit hashes. ``tag`` are 15 bits of the text's hash,
    which part rows that share an id.
    """
    if not GRAM + RUN < depth <= 256:
        raise ValueError("depth must leave room for a gram and fit the packed offsets")
    rows = keyed(docs).where(F.octet_length("t") >= depth).select("id", _tag().alias("tag"), "t")
    schema = f"id {docs.schema['doc_id'].dataType.simpleString()}, w long, a long, b long"
    found, open_rows = _digit(stored(rows.mapInArrow(_anchors(depth), schema)))
    more, open_runs = _digit(_reread(rows, open_rows, _runs(depth), schema))
    # Few documents are left by now: while their keys are small, only their texts are shuffled.
    left = sized(stored(open_runs.select("id", F.shiftright("w", _TAG).alias("tag")).distinct()))
    few = rows.alias("r").join(left.alias("l"), F.expr("r.id <=> l.id and r.tag = l.tag"), "left_semi")
    windows = _reread(few, open_runs, _windows(depth), schema).distinct()
    twice = windows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    last = windows.join(twice, ["a", "b"], "left_semi").select("id", "w")
    begin = F.shiftright("w", _BEGIN).bitwiseAND(0x7FFFFFFF)
    return (
        found.unionByName(more)
        .unionByName(last)
        .select(
            "id",
            F.shiftright("w", _TAG).alias("tag"),
            begin.alias("start"),
            (begin + F.col("w").bitwiseAND(255) + depth - 1).alias("end"),
        )
    )


def merged(stretches: DataFrame) -> DataFrame:
    """(id, tag, spans): a document's stretches, joined where they touch. One document at a time."""
    along = Window.partitionBy("id", "tag").orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    marked = stretches.withColumn("fresh", (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("int"))
    islands = marked.withColumn("island", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy("id", "tag", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.groupBy("id", "tag").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_buffer().to_pybytes()
            spans = batch.column(2)[i].values
            removed, rest, at = 0, [], 0
            if spans is not None:
                for s, e in zip(spans.field("start").to_pylist(), spans.field("end").to_pylist()):
                    rest.append(text[at:s])
                    removed += e - s
                    at = e
            rest.append(text[at:])
            n_bytes.append(len(text))
            n_removed.append(removed)
            n_spans.append(0 if spans is None else len(spans))
            kept.append(b"".join(rest))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_bytes, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(n_spans, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def without_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    A byte goes if it lies in ``depth`` bytes that also start at another place, of the same text or of
    another. Null is empty, shorter texts stay whole, rows that repeat each other lose whatever they
    share. Other columns are not read.
    """
    rows = keyed(docs).select("id", _tag().alias("tag"), "t")
    spans = sized(stored(merged(repeated(docs, depth))))
    joined = rows.alias("r").join(spans.alias("s"), F.expr("r.id <=> s.id and r.tag = s.tag"), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("r.id", "t", "spans").mapInArrow(
        _cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
