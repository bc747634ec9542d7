"""The trip consumer: each micro-batch is decoded once, and rollups, outcomes and dictionary are fed from it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators import documents, rollups
from farebox.operators.rollups import ROLLUPS, Rollup
from farebox.sources.topic import decode_numbers
from farebox.streaming import served, versions
from farebox.streaming.log import Merge, at_once, fold, read_batches, write_batch


def _sum_outcomes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bad").agg(F.sum("n").alias("n"))


def _first_places(rows: DataFrame) -> DataFrame:
    return rows.groupBy("borough").agg(F.min("first").alias("first"))


#: Logs of the consumer beside those of the rollups, with what merges their batches.
LOGS: dict[str, Merge] = {"outcomes": _sum_outcomes, "dictionary": _first_places}

#: Facts that neither rollups nor outcomes nor the dictionary read; a batch is held without them.
_UNREAD = ("pickup_ts", "dropoff_ts")
#: Keys of two rollups; rows of the other two are few once the trips of a place and day lie together.
_TOGETHER = ("pickup_date", "pickup_location_id")


def batch_facts(batch: DataFrame) -> DataFrame:
    """What the jobs of a batch read of its messages, trips of a place and day together.

    The trips are shuffled here once, as narrow as they are parsed. Shuffled rollup by rollup they would be four
    times as many rows, each of them wider: few trips of a task have a key of a rollup in common.
    """
    more = {"arrived": F.unix_millis("timestamp"), "dropoff_borough": F.col("msg.DOLocationID.borough")}
    flat = rollups.flat_messages(decode_numbers(batch), more).drop("trip_id")
    return rollups.facts_of(rollups.timed(flat).drop(*_UNREAD).repartition(*_TOGETHER))


def rollup_batch(home: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that logs under ``home`` the batch's partial rollups, its trips per outcome
    (taken, or the field that kept them out) and the first place of each borough.

    The message is parsed once, into columns that are held while the jobs run.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        facts = batch_facts(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            outcomes = facts.groupBy("bad").agg(F.count("*").alias("n"))
            # The first job fills the cache the others read.
            write_batch(outcomes, f"{home}/outcomes", batch_id)
            good = rollups.accepted(facts)
            first = documents.first_seen(facts, F.col("arrived"), F.col("borough"), F.col("dropoff_borough"))
            at_once(
                partial(write_batch, first, f"{home}/dictionary", batch_id),
                *[
                    partial(write_batch, rollups.aggregate(good, r), f"{home}/{r.name}", batch_id)
                    for r in ROLLUPS.values()
                ],
            )
        finally:
            facts.unpersist()

    return on_batch


def served_table(home: str, rollup: Rollup) -> str:
    return f"{home}/served_{rollup.name}"


def stored_state(spark: SparkSession, home: str, rollup: Rollup) -> DataFrame:
    """The rollup's state over all batches."""
    return served.state(spark, f"{home}/{rollup.name}", rollup, served_table(home, rollup))


def publish(spark: SparkSession, home: str, keep: int = versions.KEEP) -> None:
    """Bring the served tables up to date and fold the other logs; may run beside the stream and readers."""
    at_once(
        *[partial(served.publish, spark, f"{home}/{r.name}", r, served_table(home, r), keep=keep) for r in ROLLUPS.values()],
        *[partial(fold, spark, f"{home}/{name}", merge, keep) for name, merge in LOGS.items()],
    )


def dictionary(spark: SparkSession, home: str) -> DataFrame:
    """Borough ids over all batches; the same whatever batches the messages came in."""
    return documents.borough_dictionary(_first_places(read_batches(spark, f"{home}/dictionary")))


def ingest_metrics(spark: SparkSession, home: str) -> DataFrame:
    """Messages received, processed and rejected, and rows the rollups hold."""
    stored = None
    for rollup in ROLLUPS.values():
        rows = stored_state(spark, home, rollup).agg(F.count("*").alias("rows_stored"))
        stored = rows if stored is None else stored.unionByName(rows)
    return (
        read_batches(spark, f"{home}/outcomes")
        .agg(
            F.sum("n").alias("received"),
            F.coalesce(F.sum(F.when(F.col("bad").isNull(), F.col("n"))), F.lit(0)).alias("processed"),
        )
        .withColumn("rejected", F.col("received") - F.col("processed"))
        .withColumn("rows_stored", stored.agg(F.sum("rows_stored")).scalar())
    )
