"""The trip topic: Kafka where its connector is on the class path, else an append-only file table
with the same envelope columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import ENVELOPE, FACT, FACT_NUMBERS, FACT_TEXTS, NUMBERS, WIRE
from farebox.storage import listed

TOPIC = "taxi_raw"
TOPIC_PARTITIONS = 6
#: The connector's name; a source of another name serves if it takes its options and has its columns.
KAFKA = "kafka"


def topic_stream(
    spark: SparkSession,
    path: str | None = None,
    brokers: str | None = None,
    starting: str = "earliest",
    per_trigger: int | None = None,
    max_bytes: int | None = None,
    backlog: DataFrame | None = None,
    name: str = TOPIC,
    connector: str = KAFKA,
) -> DataFrame:
    """Streaming read. Each consumer keeps its own checkpoint, which holds its offsets.

    ``per_trigger`` bounds one micro-batch: messages for Kafka, files for the file table. ``max_bytes`` bounds
    it by the size of the files instead; it has no meaning for Kafka. Starting from ``latest``, the file
    table skips the files of ``backlog``, which ``present_files`` gave when the consumer first started.
    """
    if brokers:
        reader = (
            spark.readStream.format(connector)
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", name)
            .option("startingOffsets", starting)
        )
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return reader.load().select(*[c.split()[0] for c in ENVELOPE.split(", ")])
    reader = spark.readStream.schema(ENVELOPE).format("parquet")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    messages = reader.load(path)
    if starting == "latest" and backlog is not None:
        marked = messages.select("*", F.col("_metadata.file_path").alias("of_file"))
        messages = marked.join(backlog, F.col("of_file") == F.col("file"), "left_anti").drop("of_file")
    return messages


def present_files(spark: SparkSession, path: str, manifest: str) -> DataFrame:
    """(file): the files of the file table when this was first called with ``manifest``, which keeps them.

    A start from latest skips exactly these, whatever the clock says: neither a file of the same instant
    nor one that is committed later under an earlier time is lost, and a restart skips the same ones.
    """
    if not listed(spark, f"{manifest}/_SUCCESS"):
        files = topic_batch(spark, path).select(F.col("_metadata.file_path").alias("file")).distinct()
        files.write.mode("overwrite").parquet(manifest)
    return spark.read.schema("file string").parquet(manifest)


def topic_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(path)


def key_text(key: Column) -> Column:
    """The key as text; bytes that are not UTF-8 become the replacement character."""
    return F.make_valid_utf8(key.cast("string"))


def top_keys(text: Column) -> Column:
    """Top-level keys of a JSON object. Strict JSON is the fast way; a bare NaN, which the writers
    may leave, needs the lenient parser."""
    return F.coalesce(
        F.json_object_keys(text), F.map_keys(F.from_json(text, "map<string,string>"))
    )


def decode_wire(envelope: DataFrame, schema: str = WIRE) -> DataFrame:
    """Typed message next to its envelope columns; ``schema`` names the fields to parse."""
    return envelope.select(
        key_text(F.col("key")).alias("key"),
        F.from_json(F.col("value").cast("string"), schema).alias("msg"),
        "timestamp",
    )


def decode_facts(envelope: DataFrame) -> DataFrame:
    """The narrow form the rollups read, plus the top-level keys present where a number is null: only there
    can a key be absent, so that most messages are parsed once."""
    text = F.col("value").cast("string")
    decoded = envelope.select(F.from_json(text, FACT).alias("msg"), text.alias("text"), "timestamp")
    missing = reduce(or_, [F.col(f"msg.{name}").isNull() for name in NUMBERS])
    return decoded.select("msg", F.when(missing, top_keys(F.col("text"))).alias("present"), "timestamp")


def decode_numbers(envelope: DataFrame) -> DataFrame:
    """As ``decode_facts``, with numbers as numbers: ``texts`` holds them as text where one is null, which are the
    only messages that are parsed again."""
    text = F.col("value").cast("string")
    decoded = envelope.select(F.from_json(text, FACT_NUMBERS).alias("msg"), text.alias("text"), "timestamp")
    missing = reduce(or_, [F.col(f"msg.{name}").isNull() for name in NUMBERS])
    again = {"present": top_keys(F.col("text")), "texts": F.from_json("text", FACT_TEXTS)}
    return decoded.select("msg", *[F.when(missing, c).alias(name) for name, c in again.items()], "timestamp")


def absent(name: str) -> Column:
    """Whether a decoded message has no such number at all; a null is there."""
    return F.col(f"msg.{name}").isNull() & ~F.coalesce(F.array_contains("present", name), F.lit(False))
