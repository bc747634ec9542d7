"""Redelivered messages: the first delivery of every trip id, kept in an index of id buckets.

Each batch logs the first delivery of its ids. Folding replaces only those buckets of the index that newer
batches touch; readers take the other buckets as they lie, without grouping them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.storage import PACKED
from farebox.streaming import log, versions

#: Parts of the index; one is rewritten whole when an id of it comes again or for the first time.
BUCKETS = 64
VALUES = ["vendor_id", "total_amount"]
_BODY = "trip_id STRING, VendorID DOUBLE, total_amount STRING"


def first_delivery(rows: DataFrame) -> DataFrame:
    """Per trip id its earliest message, whole.

    Of messages that arrived at once the one of the lowest topic partition and offset counts (none, as in
    a file-backed topic, comes first), then that with the smallest values. So the row is one message's, and
    the same one in whatever order and batches they are read.
    """
    order = ["arrived", "partition", "offset", *VALUES]
    least = rows.groupBy("bucket", "trip_id").agg(F.min(F.struct(*order)).alias("m"))
    return least.select("bucket", "trip_id", "m.*")


def delivery_batch(home: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that logs one message per trip id of the batch. The number of buckets belongs
    to the index and stays."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        body = F.from_json(F.col("value").cast("string"), _BODY)
        read = batch.select(
            F.unix_millis("timestamp").alias("arrived"), "partition", "offset", body.alias("msg")
        )
        rows = read.select(
            F.pmod(F.xxhash64("msg.trip_id"), F.lit(buckets)).cast("int").alias("bucket"),
            "msg.trip_id",
            "arrived",
            "partition",
            "offset",
            F.col("msg.VendorID").cast("int").alias("vendor_id"),
            F.col("msg.total_amount").try_cast("double").alias("total_amount"),
        )
        log.write_batch(first_delivery(rows), home, batch_id)

    return on_batch


def _touched(rows: DataFrame) -> set[int]:
    return {r[0] for r in rows.select("bucket").distinct().collect()}


def fold(spark: SparkSession, home: str, keep: int = versions.KEEP) -> int:
    """Bring the index up to the last batch but one, which may be replayed; returns the buckets written.

    May run beside the stream and readers. Only buckets that the batches touch are read and written.
    """
    version, done = versions.current(spark, home), log.complete(spark, home)
    new = [i for i in done[:-1] if i > version.upto]
    if not new:
        return 0
    fresh = log.batches(spark, home, new).drop("batch_id")
    touched = _touched(fresh)
    held = [s for s in version.segments if s["bucket"] in touched]
    index = versions.read(spark, home, held, versions.schema_of(spark, home))
    name = versions.segment(f"_index/upto={new[-1]}")
    rows = first_delivery(index.unionByName(fresh))
    # Large buckets become several files, small ones share a task.
    rows.withColumn("part", F.col("bucket")).hint("rebalance", "part").write.options(**PACKED).partitionBy("part").parquet(f"{home}/{name}")
    now = [{"path": f"{name}/part={b}", "bucket": b} for b in sorted(touched)]
    versions.commit(spark, home, version, new[-1], [s for s in version.segments if s["bucket"] not in touched] + now, keep)
    log.forget(spark, home, version.upto if keep else new[-1])
    return len(now)


def without_redeliveries(spark: SparkSession, home: str) -> DataFrame:
    """One message per trip id over all batches, however late it was delivered again.

    Buckets that no batch has touched since the last fold are read as they are.
    """
    version = versions.current(spark, home)
    schema = versions.schema_of(spark, home)
    fresh = log.batches(spark, home, [i for i in log.complete(spark, home) if i > version.upto]).drop("batch_id")
    touched = _touched(fresh)
    still = versions.read(spark, home, [s for s in version.segments if s["bucket"] not in touched], schema)
    again = versions.read(spark, home, [s for s in version.segments if s["bucket"] in touched], schema)
    return still.unionByName(first_delivery(again.unionByName(fresh))).select("trip_id", *VALUES)
