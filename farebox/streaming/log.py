"""Batch log: the sink behind every foreachBatch job.

Each micro-batch overwrites its own ``batch_id=N`` directory, so a batch that is replayed after a
failure leaves what it left before. Readers combine the batches that are complete: add them up, or take
the latest. Nothing is read, changed and written back, so a stream's cost per batch does not grow with what
it has stored. Folding merges old batches into one segment of a version, beside writers and readers.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import compilable
from farebox.storage import PACKED, delete, file_system
from farebox.streaming import versions

Merge = Callable[[DataFrame], DataFrame]
OnBatch = Callable[[DataFrame, int], None]
#: Batches after which a stream folds its logs.
FOLD_EVERY = 16


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    versions.keep_schema(rows.sparkSession, path, rows.schema)
    rows.write.mode("overwrite").options(**PACKED).parquet(f"{path}/batch_id={batch_id}")


def complete(spark: SparkSession, path: str) -> list[int]:
    """The batches that have been written whole and still lie there."""
    system, paths = file_system(spark, path)
    done = system.globStatus(paths(f"{path}/batch_id=*/_SUCCESS")) or []
    return sorted(int(f.getPath().getParent().getName().removeprefix("batch_id=")) for f in done)


def batches(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The rows of some batches, with their batch."""
    schema = versions.schema_of(spark, path).add("batch_id", "long")
    if not ids:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/batch_id={i}" for i in ids])


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Every logged row with its batch; rows of folded batches carry the last batch of the fold."""
    # The version first: batches it does not cover are there until a later one does.
    version = versions.current(spark, path)
    log = batches(spark, path, [i for i in complete(spark, path) if i > version.upto])
    if not version.segments:
        return log
    folded = versions.read(spark, path, version.segments, versions.schema_of(spark, path))
    return log.unionByName(folded.withColumn("batch_id", F.lit(version.upto).cast("long")))


def forget(spark: SparkSession, path: str, upto: int) -> None:
    """Delete the batches up to ``upto``."""
    for i in complete(spark, path):
        if i <= upto:
            delete(spark, f"{path}/batch_id={i}")


def fold(spark: SparkSession, path: str, merge: Merge, keep: int = versions.KEEP) -> None:
    """Merge all batches but the last, which may be replayed, into one segment, so that a log stays small.

    May run beside the stream and its readers, one fold of a log at a time: the segment counts once its
    version is committed, and with ``keep`` the batches it covers go only when the next fold commits.
    """
    version, done = versions.current(spark, path), complete(spark, path)
    upto = done[-1] - 1 if done else -1
    if not [i for i in done if version.upto < i <= upto]:
        return
    schema = versions.schema_of(spark, path)
    rows = merge(read_batches(spark, path).filter(F.col("batch_id") <= upto))
    name = versions.segment(f"_folded/upto={upto}")
    rows.select(*[F.col(c.name).cast(c.dataType) for c in schema]).write.options(**PACKED).parquet(f"{path}/{name}")
    versions.commit(spark, path, version, upto, [{"path": name}], keep)
    forget(spark, path, version.upto if keep else upto)


def fold_all(spark: SparkSession, home: str, logs: dict[str, Merge], keep: int = versions.KEEP) -> None:
    """Fold every log of a consumer; ``logs`` names them under ``home`` with their merge functions."""
    at_once(*[partial(fold, spark, f"{home}/{name}" if name else home, merge, keep) for name, merge in logs.items()])


def folding(on_batch: OnBatch, fold_logs: Callable[[SparkSession], None], every: int = FOLD_EVERY) -> OnBatch:
    """``on_batch`` that folds the logs after every so many batches, so that a stream needs no upkeep."""

    def run(batch: DataFrame, batch_id: int) -> None:
        on_batch(batch, batch_id)
        if batch_id % every == every - 1:
            fold_logs(batch.sparkSession)

    return run


def at_once(*jobs: Callable[[], None]) -> None:
    """Run jobs that do not depend on each other side by side; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def run(
    stream: DataFrame,
    on_batch: OnBatch,
    checkpoint: str,
    every: str | None = None,
) -> None:
    """Process what the source holds and stop; with ``every``, in batches started at that interval.

    The checkpoint holds the consumer's offsets: they move on only after ``on_batch`` returned.
    """
    compilable(stream.sparkSession)
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if not every:
        writer.trigger(availableNow=True).start().awaitTermination()
        return
    query = writer.trigger(processingTime=every).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def append_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append to a Parquet table through the file sink, which commits each batch once."""
    query = (
        stream.writeStream.format("parquet")
        .options(**PACKED)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
