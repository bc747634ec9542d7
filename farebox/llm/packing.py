"""Packing by powers of two: every document is cut into pieces of binary lengths, each its own sequence.

A piece of 2^k tokens fills a sequence of 2^k tokens, so nothing is padded, no sequence crosses
documents, and equal lengths lie together in one bucket: its sequences have a range of ids of their own.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.bytehash import kept
from farebox.llm.common import whole_text
from farebox.session import checkpointed

LIMIT = 2048
END = 1
TOKENIZER = "byte_bpe_50k"
#: The buckets: their numbers fit above the row numbers of 2**26 tasks.
_LENGTHS = [1 << k for k in range(16)]
#: Text for the slower reader of the same vocabulary: characters on whose class two Unicode versions might
#: differ, and runs long enough to be one huge piece.
_UNUSUAL = r"[^\x00-ɏ‐-…€]|\S{1000}|\s{1000}"


def encoder(name: str = TOKENIZER):
    """Text to ids, kept for the life of a worker. ``name`` is a public vocabulary, or the path of one
    without its ending; both readers hold it."""
    if ("encoder", name) not in kept():
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = str if os.path.isabs(name) else public_tokenizers.path
        whole = Tokenizer.from_file(path(f"{name}.json"))
        # Texts that spell a token which the vocabulary adds go to the reader that knows it.
        added = [re.escape(t.content) for t in whole.get_added_tokens_decoder().values()]
        unusual = re.compile("|".join([_UNUSUAL, *added]))
        with open(path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        quick = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> list[int]:
            if unusual.search(text):
                return whole.encode(text, add_special_tokens=False).ids
            return quick.encode_ordinary(text)

        kept()["encoder", name] = encode
    return kept()["encoder", name]


def binary_cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole limits, then falling powers of two."""
    pieces, at = [], 0
    while at < n:
        left = n - at
        length = limit if left >= limit else 1 << (left.bit_length() - 1)
        pieces.append((at, length))
        at += length
    return pieces


def pack(docs: DataFrame, limit: int = LIMIT, end: int = END, tokenizer: str = TOKENIZER, stored: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset.

    Each piece is a sequence, so ``offset`` is 0 and ``length`` its bucket. A null or empty text is its
    end token alone; repeated rows are packed once each; columns other than doc_id and text are not read.
    ``limit`` is a power of two, 32768 at most. Sequence ids run through the buckets, shorter lengths first,
    and in a bucket number the rows of each task: ``docs`` must read stored files, which give a task the same rows whenever it runs again; otherwise pass ``stored=False``, and
    the pieces are written down before they are numbered.
    """
    if limit not in _LENGTHS:
        raise ValueError("limit must be a power of two, 32768 at most")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                row, start, length, total, ids = [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    tokens = np.array([*encode(text), end], "<u4")
                    for at, n in binary_cut(len(tokens), limit):
                        row.append(i)
                        start.append(at)
                        length.append(n)
                        total.append(len(tokens))
                        ids.append(tokens[at : at + n].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int64())),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(total, pa.int64()),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    pieces = docs.select(docs["doc_id"], whole_text(docs).alias("text")).mapInArrow(
        cut, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long"
    )
    if not stored:
        pieces = checkpointed(pieces)
    bucket = F.round(F.log2("length")).cast("long") * (1 << 59)
    return pieces.withColumn("sequence_id", bucket + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences in one directory per length, ready to be read as equal-length batches."""
    pieces.write.mode("overwrite").partitionBy("length").parquet(path)
