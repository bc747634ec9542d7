"""Skew, reconciliation, latency and measurement reports."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.functions.scalars import capitalize, divide_or, exact_avg, md5_bucket
from farebox.operators.ordering import ordered
from farebox.session import checkpointed

# ---- skew ------------------------------------------------------------------------------------


def partition_sizes(df: DataFrame, key: Column) -> DataFrame:
    return df.groupBy(key.alias("partition_key")).agg(F.count("*").alias("n"))


def skew_summary(df: DataFrame, key: Column) -> DataFrame:
    """How evenly a key choice spreads the rows: 100 minus the coefficient of variation in %."""
    stats = partition_sizes(df, key).agg(
        F.count("*").alias("num_partitions"),
        exact_avg(F.col("n")).alias("mean"),
        F.max("n").alias("max_records_in_partition"),
        F.min("n").alias("min_records_in_partition"),
        F.coalesce(F.stddev_samp("n"), F.lit(0.0)).alias("std"),
    )
    variation = divide_or(F.col("std"), F.col("mean"), 0.0) * 100
    return stats.select(
        "num_partitions",
        F.round("mean", 2).alias("avg_records_per_partition"),
        "max_records_in_partition",
        "min_records_in_partition",
        F.round("std", 2).alias("std_deviation"),
        F.round(variation, 2).alias("coefficient_of_variation_percent"),
        F.round(F.lit(100.0) - variation, 2).alias("balance_score"),
    )


def hottest(df: DataFrame, key: Column, n: int = 10) -> DataFrame:
    return partition_sizes(df, key).orderBy(F.desc("n"), "partition_key").limit(n)


def _bucket_sizes(df: DataFrame, key: Column, buckets: int, size: Column) -> DataFrame:
    """Rows and bytes per hash bucket, with a row for every bucket."""
    found = df.groupBy(md5_bucket(key, buckets).alias("bucket")).agg(
        F.count("*").alias("documents"), F.sum(size).alias("data_size_bytes")
    )
    every = df.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    return every.join(found, "bucket", "left").na.fill(0, ["documents", "data_size_bytes"])


def bucket_report(df: DataFrame, key: Column, buckets: int, size: Column) -> DataFrame:
    """Share, size and band of each hash bucket, in bucket order."""
    sizes = _bucket_sizes(df, key, buckets, size)
    # A fixed number of buckets: one task is enough for their total.
    total = F.sum("documents").over(Window.partitionBy())
    share = F.when(total > 0, F.round(F.col("documents") / total * 100, 2)).otherwise(F.lit(0.0))
    mean_size = F.coalesce(F.try_divide("data_size_bytes", "documents"), F.lit(0.0))
    return (
        sizes.withColumn("percentage", share)
        .select(
            "bucket",
            "documents",
            "percentage",
            "data_size_bytes",
            F.round(F.col("data_size_bytes") / F.lit(1024.0 * 1024.0), 2).alias("data_size_mb"),
            F.round(mean_size / F.lit(1024.0), 2).alias("avg_obj_size_kb"),
            F.when(F.col("percentage") > 40, "high")
            .when(F.col("percentage") < 25, "low")
            .otherwise("normal")
            .alias("band"),
        )
        .orderBy("bucket")
    )


def bucket_balance(df: DataFrame, key: Column, buckets: int) -> DataFrame:
    """100 minus the largest distance from the mean bucket, in % of the mean."""
    sizes = _bucket_sizes(df, key, buckets, F.lit(0))
    stats = sizes.agg(
        F.sum("documents").alias("total_documents"),
        F.max("documents").alias("most"),
        F.min("documents").alias("least"),
    )
    mean = F.col("total_documents") / F.lit(float(buckets))
    worst = F.greatest(F.col("most") - mean, mean - F.col("least"))
    score = F.when(mean > 0, F.lit(100.0) - worst / mean * 100).otherwise(F.lit(100.0))
    return stats.select(
        "total_documents",
        F.lit(buckets).cast("bigint").alias("total_buckets"),
        F.round(score, 2).alias("balance_score"),
    )


def shares(counts: DataFrame, n: str, top: int) -> DataFrame:
    """The largest groups with their share of everything. The counts are worked out once."""
    counts = checkpointed(counts)
    total = counts.agg(F.sum(n)).scalar()
    largest = counts.orderBy(F.desc(n), *[c for c in counts.columns if c != n]).limit(top)
    return largest.withColumn("percentage", F.round(F.col(n) / total * 100, 2))


# ---- reconciliation --------------------------------------------------------------------------


def missing_keys(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys written but not read back."""
    return expected.select(key).distinct().join(found.select(key), key, "left_anti")


def key_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The same by set difference."""
    return a.select(key).subtract(b.select(key))


def duplicate_keys(rows: DataFrame, *key: str, first: int | None = None) -> DataFrame:
    """Keys that occur more than once with their number of copies."""
    copies = rows.groupBy(*key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    return copies if first is None else copies.orderBy(*key).limit(first)


def integrity(expected: DataFrame, found: DataFrame, key: str, slack: int = 5) -> DataFrame:
    """Verdict over both sides: no copies and nothing missing (documents), or no copies and at most
    ``slack`` rows short (rollups).

    Both sides meet in one aggregation per key, so the keys are shuffled once.
    """
    sides = expected.select(key, F.lit(1).alias("wrote"), F.lit(0).alias("read")).unionByName(
        found.select(key, F.lit(0).alias("wrote"), F.lit(1).alias("read"))
    )
    per_key = sides.groupBy(key).agg(F.max("wrote").alias("wrote"), F.sum("read").alias("read"))
    totals = per_key.agg(
        F.sum("wrote").cast("bigint").alias("expected_records"),
        F.sum("read").alias("found_records"),
        F.sum(F.greatest(F.col("read") - 1, F.lit(0))).alias("duplicate_records"),
        F.count_if((F.col("wrote") == 1) & (F.col("read") == 0)).alias("missing_records"),
    )
    clean = F.col("duplicate_records") == 0
    close = F.col("found_records") >= F.col("expected_records") - slack
    return totals.select(
        "*",
        F.when(clean & (F.col("missing_records") == 0), "true").otherwise("false").alias("data_integrity"),
        F.when(clean & close, "OK").otherwise("ISSUES").alias("rollup_integrity"),
    )


# ---- latency ---------------------------------------------------------------------------------

PERCENTILES = {"p95": 0.95, "p99": 0.99}


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null: null meets null."""
    right = b.withColumnsRenamed({k: f"other_{k}" for k in keys})
    met = reduce(and_, [F.col(k).eqNullSafe(F.col(f"other_{k}")) for k in keys])
    return a.join(right, met).drop(*[f"other_{k}" for k in keys])


def latency_summary(samples: DataFrame, group: list[str], value: str) -> DataFrame:
    """Count, mean, maximum, p95 and p99 per group.

    A percentile p is the value at 0-based place int(n * p) of the sorted values, at most n - 1.
    Equal values are counted before the sort, and the sorted values are cut into chunks across all
    groups, so a group that holds most of the samples still spreads over all tasks. Chunk totals
    tell which chunk holds a wanted place; only those chunks are looked into.
    """
    counted = samples.groupBy(*group, value).agg(F.count("*").alias("n"))
    rows = ordered(counted, *group, value)
    chunks = rows.groupBy("chunk", *group).agg(
        F.sum("n").alias("chunk_n"),
        F.sum(F.col(value).cast("decimal(28,6)") * F.col("n")).alias("chunk_sum"),
        F.max(value).alias("chunk_top"),
    )
    # At most one row per chunk and group from here on.
    whole = Window.partitionBy(*group)
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    n = F.col("samples")
    placed = chunks.select(
        "*",
        F.coalesce(F.sum("chunk_n").over(before), F.lit(0)).alias("start"),
        F.sum("chunk_n").over(whole).alias("samples"),
    ).withColumns({f"at_{p}": F.least(F.floor(n * F.lit(q)), n - 1) for p, q in PERCENTILES.items()})

    def holds(p: str) -> Column:
        return F.col(f"at_{p}").between(F.col("start"), F.col("start") + F.col("chunk_n") - 1)

    wanted = placed.filter(reduce(or_, [holds(p) for p in PERCENTILES]))
    inside = Window.partitionBy("chunk", *group).orderBy("place")
    upto = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("start")
    # The value at place k is the first with more than k values up to it.
    picked = (
        _same(rows, wanted, ["chunk", *group])
        .withColumn("upto", upto)
        .groupBy(*group)
        .agg(
            *[
                F.min(F.when(holds(p) & (F.col("upto") > F.col(f"at_{p}")), F.col(value))).alias(p)
                for p in PERCENTILES
            ]
        )
    )
    summary = chunks.groupBy(*group).agg(
        F.sum("chunk_n").alias("samples"),
        F.sum("chunk_sum").cast("double").alias("total"),
        F.max("chunk_top").alias("top"),
    )
    return _same(summary, picked, group).select(
        *group,
        "samples",
        F.round(F.col("total") / n, 2).alias("avg_latency_ms"),
        F.round("top", 2).alias("max_latency_ms"),
        *[F.round(p, 2).alias(f"{p}_latency_ms") for p in PERCENTILES],
    )


def timing_extremes(timings: DataFrame, name: str, ms: str) -> DataFrame:
    """Mean of the timings above zero, and the fastest and slowest name (zeros included)."""
    above = F.when(F.col(ms) > 0, F.col(ms).cast("decimal(28,6)"))
    return timings.agg(
        F.count("*").alias("total_queries"),
        F.round(F.coalesce(exact_avg(above), F.lit(0.0)), 2).alias("avg_execution_time_ms"),
        F.min_by(name, F.struct(F.col(ms), F.col(name))).alias("fastest_query"),
        F.min_by(name, F.struct(-F.col(ms), F.col(name))).alias("slowest_query"),
    )


def side_by_side(a: DataFrame, b: DataFrame, name: str, ms: str) -> DataFrame:
    """Two timing tables by query name, 0 where one has none; labels start with a capital."""
    left = a.select(name, F.col(ms).alias("a_ms"))
    right = b.select(name, F.col(ms).alias("b_ms"))
    return left.join(right, name, "full_outer").select(
        capitalize(F.col(name)).alias("query"),
        F.coalesce("a_ms", F.lit(0.0)).alias("a_ms"),
        F.coalesce("b_ms", F.lit(0.0)).alias("b_ms"),
    )
