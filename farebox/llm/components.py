"""Connected components by hash-to-minimum rounds over stored edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import stored
from farebox.session import shuffle_width

#: Edges a task holds before a round is dealt to more tasks than there are cores.
EDGES = 1 << 16


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component, for every node of ``edges`` (a, b).

    Alternates two steps until nothing changes: every node hands its larger neighbours to its least
    one, then its smaller ones. A component becomes a star in some log n rounds, and no step gathers a
    node's neighbours: each is one minimum per node, aggregated before the shuffle and written down, and
    a join of stored tables, which splits the partition of a node with very many neighbours. A round's
    tasks and files follow the number of edges, not that of shuffle partitions.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    seen = _digest(now)
    while True:
        tasks = _tasks(now, seen[0])
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("near")).select("a", F.least("a", "near").alias("m"))
        least = stored(least.coalesce(tasks))
        # Each edge leaves one row here at most; equal ones fall together at the round's end.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.coalesce(tasks))
        floor = stored(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks))
        pair = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(floor, "a").select(F.explode(pair).alias("e")).select("e.a", "e.b").where("a <> b")
        now = stored(small.coalesce(tasks).distinct().coalesce(tasks))
        following = _digest(now)
        if following == seen:
            break
        seen = following
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _tasks(edges: DataFrame, count: int) -> int:
    """Tasks for so many edges: one a core at least, one a shuffle partition at most."""
    spark = edges.sparkSession
    return min(max(spark.sparkContext.defaultParallelism, -(-count // EDGES)), shuffle_width(spark))


def _digest(edges: DataFrame) -> tuple[int, int | None]:
    """Number of edges and a hash of their set: two numbers that stop changing when the edges do."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
