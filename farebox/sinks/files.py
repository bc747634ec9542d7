"""Batch sinks: record files, the topic, and the rollup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.functions.scalars import md5_bucket
from farebox.operators.rollups import Rollup, revenue_view, time_view
from farebox.session import shuffle_width, written
from farebox.sources.topic import KAFKA, TOPIC, TOPIC_PARTITIONS
from farebox.storage import PACKED

RECORDS_PER_FILE = 100_000
#: What Spark names the directory of rows without a partition value.
NO_STEM = "__HIVE_DEFAULT_PARTITION__"
#: Packed bytes in a row group of the file-backed topic, which no task reads less of: a micro-batch has few files.
TOPIC_ROW_GROUP = 4 << 20


def write_json_lines(
    records: DataFrame, path: str, per_file: int = RECORDS_PER_FILE, *by: str, compression: str = "none"
) -> None:
    """JSON Lines files of at most ``per_file`` records, split by the ``by`` columns if given."""
    writer = records.write.mode("overwrite").option("maxRecordsPerFile", per_file).option("compression", compression)
    (writer.partitionBy(*by) if by else writer).json(path)


def dealt(
    rows: DataFrame, stem: str, per_file: int = RECORDS_PER_FILE, near: tuple[str, ...] = ()
) -> DataFrame:
    """Rows shuffled to the files they are written to: ``slot`` numbers the files of a stem, ``at`` orders a slot.

    A stem has as many slots as leave about three quarters of ``per_file`` to each, and a task gets about one slot, so
    that none sorts more than it can hold. The place of a row is the hash of all its columns. What is made from a row,
    like its JSON text, is best made behind this: the text is several times as large. An empty or null stem gets the
    name its directory has: a column without nulls keeps its order for the writer, which then does not sort again.
    Rows of a slot that are equal in the ``near`` columns lie side by side, and pack better.
    """
    most = per_file * 0.75
    filled = F.coalesce(F.nullif(F.col(stem).cast("string"), F.lit("")), F.lit(NO_STEM))
    named = rows.withColumn(stem, filled)
    counted = written(named.groupBy(F.col(stem).alias("of")).agg(F.count("*").alias("n")))
    sizes = counted.select("of", (F.floor(F.col("n") / most) + 1).alias("slots"))
    tasks = max(shuffle_width(rows.sparkSession), int((counted.agg(F.sum("n")).first()[0] or 0) / most) + 1)
    at = F.xxhash64(*rows.columns)
    placed = named.join(sizes, F.col(stem) == F.col("of")).select(*rows.columns, F.pmod(at, "slots").alias("slot"))
    return placed.repartition(tasks, stem, "slot").withColumn("at", F.xxhash64(*(near or rows.columns)))


def write_json_arrays(
    records: DataFrame, path: str, stem: str, per_file: int = RECORDS_PER_FILE, compression: str = "none"
) -> None:
    """Files that each hold one JSON array of at most ``per_file`` records, one record on a line.

    ``records`` has the columns ``value`` (JSON text without line breaks) and ``stem``, and ``slot`` and ``at`` if
    it is made from rows that were ``dealt``. Every ``per_file`` records of a slot are a file, whose first line opens
    the array and whose last one closes it. Lines are written as they come, so no array is ever held in memory, and
    a slot that equal records overfill has several files.
    """
    rows = records if "slot" in records.columns else dealt(records.select(stem, "value"), stem, per_file)
    along = Window.partitionBy(stem, "slot").orderBy("at")
    placed = rows.select(
        *(stem, "slot", "at", "value"),
        (F.row_number().over(along) - 1).alias("row"),
        F.lead(F.lit(1)).over(along).isNull().alias("last"),
    )
    line = F.concat(
        F.when(F.col("row") % per_file == 0, "[").otherwise(""),
        "value",
        F.when((F.col("row") % per_file == per_file - 1) | F.col("last"), "]").otherwise(","),
    )
    (
        placed.sortWithinPartitions(stem, "slot", "at")
        .select(stem, "slot", line.alias("value"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", per_file)
        .option("compression", compression)
        .option("zlib.compress.level", "BEST_SPEED")
        .partitionBy(stem, "slot")
        .text(path)
    )


def partition_of(key: Column, partitions: int = TOPIC_PARTITIONS) -> Column:
    """Which topic partition a key goes to."""
    return md5_bucket(key, partitions).cast("int")


def envelope(messages: DataFrame, timestamp: Column, name: str = TOPIC) -> DataFrame:
    """Key and value as bytes with the topic's own columns.

    The partition is a column, not a file layout: a borough with a third of all trips would
    otherwise fill one file per table with a third of all bytes.
    """
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(name).alias("topic"),
        partition_of(F.col("key")).alias("partition"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def write_topic(
    records: DataFrame,
    path: str | None = None,
    brokers: str | None = None,
    mode: str = "append",
    name: str = TOPIC,
    connector: str = KAFKA,
) -> None:
    """Append keyed messages to Kafka, or to the file-backed topic."""
    if brokers:
        (
            records.select("key", "value")
            .write.format(connector)
            .option("kafka.bootstrap.servers", brokers)
            .option("topic", name)
            .mode("append")
            .save()
        )
    else:
        records.write.mode(mode).options(**PACKED, **{"parquet.block.size": TOPIC_ROW_GROUP}).parquet(path)


# ---- rollup tables ---------------------------------------------------------------------------
#
# One directory per month. The rest of the primary key is the sort order inside it, so a read of
# one borough prunes the directories by month and the row groups by their min/max. A directory
# per borough and month would only make many tiny files: a month of borough hours is 744 rows per
# borough.


def write_sorted(table: DataFrame, path: str, by: str, order: list[Column]) -> None:
    """(Over)write the ``by`` directories found in ``table``; the others stay as they are.

    Rows are ranged over the whole sort order, not hashed by directory: a directory with a large
    share of the rows is cut into several files, small ones share a task, and AQE picks the sizes.
    """
    (
        table.repartitionByRange(F.col(by), *order)
        .sortWithinPartitions(F.col(by), *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PACKED)
        .partitionBy(by)
        .parquet(path)
    )


def write_rollup(state: DataFrame, rollup: Rollup, path: str) -> None:
    """(Over)write the months found in ``state``."""
    inside = [F.col(c) for c in rollup.partition if c != "year_month"]
    write_sorted(state, path, "year_month", [*inside, *rollup.order()])


def write_views(borough_time: DataFrame, revenue_path: str, time_path: str) -> None:
    """Store both views of the borough rollup, each in the order its readers want: the best hours
    of a borough first, and the hours of a month in time order."""
    by_revenue = [F.desc("sum_total_amount"), *[F.col(c) for c in ("year_month", "pickup_date", "pickup_hour")]]
    write_sorted(revenue_view(borough_time), revenue_path, "borough", by_revenue)
    by_time = [F.col(c) for c in ("pickup_date", "pickup_hour", "borough")]
    write_sorted(time_view(borough_time), time_path, "year_month", by_time)


def read_rollup(spark: SparkSession, path: str, schema) -> DataFrame:
    """A declared schema keeps ``year_month`` text and saves the inference pass."""
    return spark.read.schema(schema).parquet(path)
