"""Window-style operators over a message sequence: last N, rolling, trailing rate, running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.operators.ordering import running_sums, with_position


def last_n(df: DataFrame, n: int, *newest_first) -> DataFrame:
    return df.orderBy(*newest_first).limit(n)


def rolling_stats(values: DataFrame, order: str, value: str, n: int) -> DataFrame:
    """Mean and maximum of the last ``n`` values at every row.

    The sequence is cut into blocks of n. The window that ends at a row is a tail of the block
    before it joined to a head of its own block, so two running passes per block replace n reads
    per row, and no task ever holds more than two blocks.
    """
    placed = with_position(values.select(order, F.col(value).alias("v")), order).withColumn(
        "block", F.floor(F.col("position") / n)
    )
    head = Window.partitionBy("block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    tail = (
        Window.partitionBy("block")
        .orderBy(F.desc("position"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    passes = placed.select(
        order,
        "position",
        "block",
        F.sum("v").over(head).alias("head_sum"),
        F.max("v").over(head).alias("head_max"),
        F.sum("v").over(tail).alias("tail_sum"),
        F.max("v").over(tail).alias("tail_max"),
    )
    # The row n-1 places earlier starts the window; it lies in the block before or starts this one.
    earlier = passes.select(
        (F.col("position") + (n - 1)).alias("position"),
        F.col("block").alias("from_block"),
        "tail_sum",
        "tail_max",
    )
    crosses = F.col("from_block") < F.col("block")
    joined = passes.drop("tail_sum", "tail_max").join(earlier, "position", "left")
    total = F.col("head_sum") + F.when(crosses, F.col("tail_sum")).otherwise(F.lit(0))
    count = F.least(F.col("position") + 1, F.lit(n))
    return joined.select(
        order,
        F.round(total.cast("double") / count, 2).alias("avg_value"),
        F.greatest("head_max", F.when(crosses, F.col("tail_max"))).cast("double").alias("max_value"),
    )


def trailing_rate(arrivals: DataFrame, ts: str, seconds: int = 60) -> DataFrame:
    """Messages of the last ``seconds`` at every second that has one.

    Messages are counted per second first. Each second is then handed to its own block and the next
    one, so a block's window is whole and holds at most two blocks of seconds.
    """
    per_second = (
        arrivals.groupBy(F.unix_timestamp(F.date_trunc("second", ts)).alias("second"))
        .agg(F.count("*").alias("n"))
        .withColumn("home", F.floor(F.col("second") / seconds))
    )
    spread = per_second.select(
        "second", "n", "home", F.explode(F.array("home", F.col("home") + 1)).alias("block")
    )
    trailing = Window.partitionBy("block").orderBy("second").rangeBetween(-(seconds - 1), 0)
    return (
        spread.withColumn("in_window", F.sum("n").over(trailing))
        .filter(F.col("block") == F.col("home"))
        .select("second", F.col("in_window").alias("trips_per_minute"))
    )


def running_totals(messages: DataFrame, order: str, amount: str) -> DataFrame:
    """Trips and revenue so far; a missing amount adds 0."""
    rows = messages.select(
        order, F.lit(1).alias("one"), F.coalesce(F.col(amount), F.lit(0)).alias("paid")
    )
    return running_sums(rows, [order], {"total_trips": "one", "total_revenue": "paid"}).select(
        order, "total_trips", F.col("total_revenue").cast("double").alias("total_revenue")
    )
