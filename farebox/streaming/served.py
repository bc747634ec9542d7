"""Served rollup tables: a month is cut into key ranges, and only the ranges that new rows touch are rewritten.

Rows are added from a rollup's log (the table is then the folded part of that log), put over stored ones, or
deleted; each is a new version of the table. The leading key (what comes beside the month in the
partition key) cuts a month into ranges of about ``ROWS_PER_RANGE`` rows; a range is one segment, sorted by
the rest of the key, and owns all leading keys from its lowest one up to that of the next range.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farebox.operators import rollups
from farebox.operators.rollups import Rollup
from farebox.session import written
from farebox.storage import PACKED
from farebox.streaming import log, versions

ROWS_PER_RANGE = 100_000
_RANGE = "owner string, of_month string, from_key string, to_key string"


def _lead(rollup: Rollup) -> Column:
    """The leading key as text, nulls first; any order will do as long as it is one."""
    inside = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rollup.partition if c != "year_month"]
    return F.concat_ws("\t", *inside)


def _month() -> Column:
    return F.coalesce(F.col("year_month"), F.lit(""))


def _ranges(spark: SparkSession, segments: list[dict]) -> DataFrame:
    """The ranges as rows; the first of a month reaches down to every key, the last up. Written down, so that
    Catalyst knows their size: rows of the driver count as a large table, to which the state would be shuffled."""
    rows = []
    by_month: dict[str, list[dict]] = {}
    for s in segments:
        by_month.setdefault(s["month"], []).append(s)
    for month, held in by_month.items():
        held.sort(key=lambda s: s["low"])
        lows = ["", *[s["low"] for s in held[1:]]]
        rows += [(s["path"], month, low, up) for s, low, up in zip(held, lows, [*lows[1:], None])]
    return written(spark.createDataFrame(rows, _RANGE).coalesce(1))


def _owned(rows: DataFrame, ranges: DataFrame | None) -> DataFrame:
    """Rows with month, leading key and the range that owns them, null in a month without ranges; a table that
    is new has no ``ranges`` at all."""
    if ranges is None:
        return rows.withColumns({c: F.lit(None).cast("string") for c in ("owner", "from_key")})
    inside = (F.col("month") == F.col("of_month")) & (F.col("lead") >= F.col("from_key"))
    inside = inside & (F.col("to_key").isNull() | (F.col("lead") < F.col("to_key")))
    return rows.join(ranges, inside, "left").drop("of_month", "to_key")


def _slices(owned: DataFrame, rows_per_range: int) -> DataFrame:
    """(month, lead, slice, low): new ranges inside each owner, cut between leading keys by running counts."""
    counts = owned.groupBy("month", "owner", "from_key", "lead").agg(F.count("*").alias("n"))
    along = Window.partitionBy("month", "owner").orderBy("lead")
    before = F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = counts.withColumn("nth", F.floor(before / rows_per_range))
    first = F.min("lead").over(Window.partitionBy("month", "owner", "nth"))
    # The first new range of an owner begins where the owner began.
    low = F.when(F.col("nth") == 0, F.coalesce("from_key", F.lit(""))).otherwise(first)
    part = F.concat_ws("_", F.when(F.col("month") == "", "none").otherwise(F.col("month")), F.substring(F.md5(low), 1, 12))
    return cut.select("month", "lead", low.alias("low"), part.alias("part"))


def _replace(
    spark: SparkSession,
    table: str,
    rollup: Rollup,
    version: versions.Version,
    keys: DataFrame,
    renewed: Callable[[DataFrame], DataFrame],
    upto: int,
    rows_per_range: int,
    keep: int,
) -> int:
    """Replace the ranges that own ``keys`` by what ``renewed`` makes of their rows; returns the ranges written.

    The driver holds one entry per range.
    """
    schema, lead = versions.schema_of(spark, table), {"month": _month(), "lead": _lead(rollup)}
    ranges, touched = None, set()
    if version.segments:
        ranges, wanted = _ranges(spark, version.segments), keys.withColumns(lead).select("month", "lead").distinct()
        touched = {r[0] for r in _owned(wanted, ranges).select("owner").distinct().collect()}
    held = [s for s in version.segments if s["path"] in touched]
    owned = _owned(renewed(versions.read(spark, table, held, schema)).withColumns(lead), ranges)
    slices = written(_slices(owned, rows_per_range))
    name = versions.segment(f"_ranges/upto={upto}")
    rest = [F.col(c) for c in rollup.partition if c != "year_month"]
    order = [F.col("part"), *rest, *rollup.order()]
    # Slices hold a row per month and leading key. AQE cuts a range that is too large into several files.
    placed = owned.join(slices, ["month", "lead"]).select(*schema.names, "part").hint("rebalance", "part")
    placed.sortWithinPartitions(*order).write.options(**PACKED).partitionBy("part").parquet(f"{table}/{name}")
    made = slices.groupBy("month", "low", "part").count().collect()
    now = [{"path": f"{name}/part={r['part']}", "month": r["month"], "low": r["low"]} for r in made]
    versions.commit(spark, table, version, upto, [s for s in version.segments if s["path"] not in touched] + now, keep)
    return len(now)


def publish(
    spark: SparkSession, source: str, rollup: Rollup, table: str, rows_per_range: int = ROWS_PER_RANGE, keep: int = versions.KEEP
) -> int:
    """Bring the served table up to the last complete batch of the log ``source``; returns the ranges written.

    New state rows are added to the ranges that own their keys. A new version names the new ranges and the
    untouched ones, and the last batch in it; a replay of a batch it covers changes nothing. Batches covered by
    the version before are deleted.
    """
    version = versions.current(spark, table)
    new = [i for i in log.complete(spark, source) if i > version.upto]
    if not new:
        return 0
    versions.keep_schema(spark, table, versions.schema_of(spark, source))
    rows = log.batches(spark, source, new)
    # One batch has a row per key already.
    fresh = written(rollups.merge(rows, rollup)) if len(new) > 1 else rows.drop("batch_id")
    # Merged already where no range holds rows of the same keys.
    renewed = (lambda held: rollups.merge(held.unionByName(fresh), rollup)) if version.segments else (lambda _: fresh)
    made = _replace(spark, table, rollup, version, fresh, renewed, new[-1], rows_per_range, keep)
    log.forget(spark, source, version.upto if keep else new[-1])
    return made


def upsert(
    spark: SparkSession, table: str, rows: DataFrame, rollup: Rollup, rows_per_range: int = ROWS_PER_RANGE, keep: int = versions.KEEP
) -> int:
    """Insert state rows; a row whose primary key is already stored replaces it (a null part of a key meets a null).

    Makes the table if there is none. Only the ranges that own the rows' keys are read and written, and readers
    see all of the rows or none. Returns the ranges written.
    """
    version = versions.current(spark, table)
    versions.keep_schema(spark, table, rows.schema)
    fresh = written(rows.select(*versions.schema_of(spark, table).names))
    given = fresh.select(*[F.col(c).alias(f"new_{c}") for c in rollup.pk])
    replaced = reduce(and_, [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in rollup.pk])
    renewed = lambda held: held.join(given, replaced, "left_anti").unionByName(fresh)
    return _replace(spark, table, rollup, version, fresh, renewed, version.upto, rows_per_range, keep)


def delete(
    spark: SparkSession, table: str, doomed: Column, rollup: Rollup, month: str, rows_per_range: int = ROWS_PER_RANGE, keep: int = versions.KEEP
) -> int:
    """Delete the rows of a month for which ``doomed`` is true; only ranges that hold one are written anew."""
    version, schema = versions.current(spark, table), versions.schema_of(spark, table)
    keys = read(spark, table, schema, month).filter(doomed)
    left = lambda held: held.filter(~F.coalesce(doomed & (F.col("year_month") == month), F.lit(False)))
    if keys.isEmpty():
        return 0
    return _replace(spark, table, rollup, version, keys, left, version.upto, rows_per_range, keep)


def read(spark: SparkSession, table: str, schema: StructType, month: str | None = None) -> DataFrame:
    """The served rows; with ``month``, from the ranges of that month only."""
    segments = versions.current(spark, table).segments
    if month is not None:
        segments = [s for s in segments if s["month"] == month]
    rows = versions.read(spark, table, segments, schema)
    return rows if month is None else rows.filter(F.col("year_month") == month)


def state(spark: SparkSession, source: str, rollup: Rollup, table: str) -> DataFrame:
    """The rollup's state over all complete batches: the served ranges and what has come since."""
    version = versions.current(spark, table)
    new = [i for i in log.complete(spark, source) if i > version.upto]
    schema = versions.schema_of(spark, source)
    held = versions.read(spark, table, version.segments, schema)
    if not new:
        return held
    return rollups.merge(held.unionByName(log.batches(spark, source, new).drop("batch_id")), rollup)
