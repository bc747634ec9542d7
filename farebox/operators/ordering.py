"""Row numbers and running sums over one global order, without a one-task window.

The rows are range-partitioned on a unique order, sorted inside each partition and checkpointed.
From there a row's position is its place in its partition plus the size of the partitions before
it, and those sizes are one small row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.session import checkpointed, shuffle_width

_ROW_BITS = (1 << 33) - 1
#: Chunks whose running totals one task works out.
BLOCK = 1024


def ordered(df: DataFrame, *order: str) -> DataFrame:
    """Globally ordered rows with their ``chunk`` and their 0-based place in it.

    ``order`` must be unique: its last columns then split a value that many rows share.
    """
    width = shuffle_width(df.sparkSession)
    placed = checkpointed(df.repartitionByRange(width, *order).sortWithinPartitions(*order))
    return placed.withColumn("chunk", F.spark_partition_id()).withColumn(
        "place", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    )


def _chunk_starts(totals: DataFrame, names: list[str]) -> DataFrame:
    """What lies before each chunk, from the chunk totals: a running sum over one row per chunk.

    Chunks are first summed in blocks of ``BLOCK``, so that no task orders more than a block of chunks
    or the totals of all blocks.
    """
    block = F.floor(F.col("chunk") / BLOCK)
    inside = Window.partitionBy("block").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    blocked = totals.withColumn("block", block)
    blocks = blocked.groupBy("block").agg(*[F.sum(n).alias(f"all_{n}") for n in names])
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("block", *[F.sum(f"all_{n}").over(before).alias(f"before_{n}") for n in names])
    zero = F.lit(0)
    starts = blocked.select(
        "chunk", "block", *[F.coalesce(F.sum(n).over(inside), zero).alias(f"in_{n}") for n in names]
    ).join(offsets, "block")
    return starts.select(
        "chunk", *[(F.col(f"in_{n}") + F.coalesce(f"before_{n}", zero)).alias(f"start_{n}") for n in names]
    )


def with_position(df: DataFrame, *order: str) -> DataFrame:
    """Adds ``position``, 0-based in the global order."""
    rows = ordered(df, *order)
    sizes = rows.groupBy("chunk").agg(F.count("*").alias("n"))
    return (
        rows.join(_chunk_starts(sizes, ["n"]), "chunk")
        .withColumn("position", F.col("start_n") + F.col("place"))
        .drop("chunk", "place", "start_n")
    )


def running_sums(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Adds running totals over the global order: ``{new column: summed column}``."""
    rows = ordered(df, *order)
    totals = rows.groupBy("chunk").agg(*[F.sum(c).alias(new) for new, c in sums.items()])
    inside = Window.partitionBy("chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(_chunk_starts(totals, list(sums)), "chunk").select(
        *df.columns,
        *[(F.sum(c).over(inside) + F.col(f"start_{new}")).alias(new) for new, c in sums.items()],
    )
