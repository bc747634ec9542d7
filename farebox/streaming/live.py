"""Live view of the topic: totals, latency, recent trips, windows."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.sources.topic import absent, decode_facts
from farebox.streaming.log import Merge, at_once, read_batches, write_batch

# How many trips and latencies the live view keeps.
RECENT = 15
LATENCIES = 5000


def card() -> list[Column]:
    """The eight fields a trip shows in the live list, from a decoded fact message."""

    def text(path: str, default: str) -> Column:
        return F.coalesce(F.col(f"msg.{path}"), F.lit(default))

    return [
        F.date_format("timestamp", "HH:mm:ss").alias("shown_at"),
        text("trip_id", "N/A").alias("trip_id"),
        text("PULocationID.zone", "Unknown").alias("pickup_zone"),
        text("DOLocationID.zone", "Unknown").alias("dropoff_zone"),
        text("PULocationID.borough", "Unknown").alias("borough"),
        F.coalesce(F.col("msg.total_amount").try_cast("double"), F.lit(0.0)).alias("amount"),
        F.col("msg.trip_distance").try_cast("double").alias("distance"),
        F.col("msg.passenger_count").try_cast("double").cast("int").alias("passengers"),
    ]


def measures() -> list[Column]:
    """Latency, revenue, and whether the list could not show the trip: a number is null or does
    not convert."""
    broken = F.lit(False)
    for name in ("trip_distance", "passenger_count"):
        broken = broken | (~absent(name) & F.col(f"msg.{name}").try_cast("double").isNull())
    sent = F.col("msg.producer_timestamp").cast("bigint")
    return [
        (F.unix_millis("timestamp") - sent).alias("latency_ms"),
        F.col("msg.total_amount").try_cast("decimal(18,2)").alias("paid"),
        broken.alias("broken"),
    ]


def live_batch(home: str, per_poll: int | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for totals, latencies and recent trips.

    Totals are logged per latency in ms, so mean, maximum and percentiles merge exactly. Of each
    batch the ``RECENT`` newest trips are kept, or its first ``per_poll``.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        shown = decode_facts(batch).select("timestamp", *card(), *measures())
        shown.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            totals = shown.groupBy("latency_ms").agg(
                F.count("*").alias("total_trips"),
                F.sum(F.coalesce("paid", F.lit(0))).alias("total_revenue"),
                F.count_if("broken").alias("errors"),
                F.max("timestamp").alias("last_trip_time"),
            )
            # The first job fills the cache the others read.
            write_batch(totals, f"{home}/totals", batch_id)
            newest = _newest(shown) if per_poll is None else shown.orderBy("timestamp", "trip_id").limit(per_poll)
            stamped = shown.filter(F.col("latency_ms").isNotNull())
            at_once(
                partial(write_batch, newest.drop("latency_ms", "paid", "broken"), f"{home}/recent", batch_id),
                partial(write_batch, _newest_latencies(stamped), f"{home}/latencies", batch_id),
            )
        finally:
            shown.unpersist()

    return on_batch


def _newest(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc("timestamp"), F.desc("trip_id")).limit(RECENT)


def _sum_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("latency_ms").agg(
        *[F.sum(c).alias(c) for c in ("total_trips", "total_revenue", "errors")],
        F.max("last_trip_time").alias("last_trip_time"),
    )


def live_stats(spark: SparkSession, home: str) -> DataFrame:
    return read_batches(spark, f"{home}/totals").agg(
        F.sum("total_trips").alias("total_trips"),
        F.sum("total_revenue").cast("double").alias("total_revenue"),
        F.sum("errors").alias("errors"),
        F.date_format(F.max("last_trip_time"), "yyyy-MM-dd HH:mm:ss").alias("last_trip_time"),
    )


def _newest_latencies(rows: DataFrame) -> DataFrame:
    newest = rows.orderBy(F.desc("timestamp"), F.desc("trip_id")).limit(LATENCIES)
    return newest.select("timestamp", "trip_id", "latency_ms")


def live_latency(spark: SparkSession, home: str) -> DataFrame:
    """Time from stamp to arrival, over the newest messages and over all that carry a stamp."""
    log = read_batches(spark, f"{home}/totals").filter(F.col("latency_ms").isNotNull())
    newest = _newest_latencies(read_batches(spark, f"{home}/latencies"))
    recent = newest.agg(
        F.struct(F.round(F.avg("latency_ms"), 2).alias("mean"), F.max("latency_ms").alias("top"))
    ).scalar()
    n = F.col("total_trips")
    whole = log.agg(
        F.sum(n).alias("messages"),
        F.round(F.sum(F.col("latency_ms") * n) / F.sum(n), 2).alias("all_avg_latency_ms"),
        F.max("latency_ms").alias("all_max_latency_ms"),
    )
    return whole.withColumns({"avg_latency_ms": recent["mean"], "max_latency_ms": recent["top"]})


def recent_trips(spark: SparkSession, home: str, n: int = RECENT) -> DataFrame:
    """Newest trips first, at most ``RECENT``: older ones go when the log is folded."""
    log = read_batches(spark, f"{home}/recent")
    return log.orderBy(F.desc("timestamp"), F.desc("trip_id")).limit(min(n, RECENT)).drop("batch_id", "timestamp")


#: Logs of the live view, with what merges their batches.
LOGS: dict[str, Merge] = {
    "totals": _sum_totals,
    "recent": _newest,
    "latencies": _newest_latencies,
}


def hourly_window(events: DataFrame) -> DataFrame:
    """Trips and revenue per hour and key: a tumbling window. Parts of it add up."""
    return (
        events.groupBy(F.window("ts", "1 hour")["start"].alias("window_start"), "event_type")
        .agg(F.count("*").alias("trips"), F.sum(F.col("value").cast("decimal(18,2)")).alias("revenue"))
    )


def minute_rate(events: DataFrame) -> DataFrame:
    """Messages of the last 60 seconds, every 10 seconds: a sliding window. Parts of it add up."""
    window = F.window("ts", "60 seconds", "10 seconds")
    return (
        events.groupBy(window.alias("window"))
        .agg(F.count("*").alias("trips"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "trips")
    )


def window_batch(home: str, window: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that logs the batch's part of every window it touches.

    Nothing is dropped for coming late: a window is complete once its messages have been read.
    """
    return lambda batch, batch_id: write_batch(window(batch), home, batch_id)


def sum_windows(keys: list[str]) -> Merge:
    """Parts of windows with the same keys add up."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in (*keys, "batch_id")])

    return merge


def windows(spark: SparkSession, home: str, keys: list[str]) -> DataFrame:
    """The windows over all batches."""
    return sum_windows(keys)(read_batches(spark, home))
