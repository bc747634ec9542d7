"""The streaming jobs as named queries: each runs over what its source holds, then reads its sink."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators import documents, rollups
from farebox.operators.rollups import ROLLUPS
from farebox.plans.queries import Query, _text_dates
from farebox.plans.workspace import Workspace
from farebox.schemas import EVENT
from farebox.sinks import files
from farebox.sources import topic
from farebox.streaming import deliveries, live, log, served, versions
from farebox.streaming import rollups as rollup_stream

STREAMS: dict[str, Query] = {}
#: Packed bytes of messages in a micro-batch. A number of files would make batches as small as the files are, and
#: as many of them as the writer had tasks, each with its jobs, logs and folds: a batch logs nearly all keys of a rollup.
BYTES_PER_TRIGGER = 1 << 30


def stream(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    """Register under the function's name."""
    STREAMS[build.__name__] = lambda spark, sf_dir: build(Workspace(spark, sf_dir))
    return build


def _topic(ws: Workspace, path: str, max_bytes: int = BYTES_PER_TRIGGER, **options) -> DataFrame:
    return topic.topic_stream(ws.spark, path, max_bytes=max_bytes, **options)


def _events(ws: Workspace) -> DataFrame:
    """Arrivals, a file at a time."""
    # The pattern matches the table whether it is one file or a folder of files.
    arrivals = ws.spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1)
    return arrivals.parquet(f"{ws.sf_dir}/events.parquet*")


def _checkpoint(ws: Workspace, name: str) -> str:
    return ws.path(f"checkpoint_{name}")


# ---- documents and rollups -------------------------------------------------------------------


@stream
def stream_documents(ws: Workspace) -> DataFrame:
    source, dictionary = ws.topic_path(), ws.dictionary()

    def run(path: str) -> None:
        messages = topic.decode_wire(_topic(ws, source)).select("msg.*")
        log.append_table(
            documents.to_documents(messages, dictionary), path, _checkpoint(ws, "documents")
        )

    path = ws.once("stream_documents", run)
    return documents.flatten_documents(ws.spark.read.parquet(path))


def _trips_home(ws: Workspace) -> str:
    """The trip consumer: one run over the topic feeds rollups, outcomes and dictionary."""
    source = ws.topic_path()

    def run(home: str) -> None:
        on_batch = log.folding(rollup_stream.rollup_batch(home), partial(rollup_stream.publish, home=home))
        log.run(_topic(ws, source), on_batch, _checkpoint(ws, "rollups"))

    return ws.once("stream_rollups", run)


def _served(ws: Workspace, name: str) -> DataFrame:
    """The served table of a rollup, brought up to date with the log."""
    home, rollup = _trips_home(ws), ROLLUPS[name]
    publish = partial(served.publish, ws.spark, f"{home}/{name}", rollup)
    table = rollup_stream.served_table(home, rollup)
    ws.once(f"published_{name}", lambda _: publish(table))
    state = served.read(ws.spark, table, versions.schema_of(ws.spark, table))
    return _text_dates(rollups.present(state, rollup))


@stream
def stream_rollup_borough_time(ws: Workspace) -> DataFrame:
    return _served(ws, "borough_time")


@stream
def stream_rollup_pickup_zone(ws: Workspace) -> DataFrame:
    return _served(ws, "pickup_zone")


@stream
def stream_rollup_route(ws: Workspace) -> DataFrame:
    return _served(ws, "route")


@stream
def stream_rollup_vendor(ws: Workspace) -> DataFrame:
    return _served(ws, "vendor")


@stream
def stream_ingest_metrics(ws: Workspace) -> DataFrame:
    return rollup_stream.ingest_metrics(ws.spark, _trips_home(ws))


# ---- live view -------------------------------------------------------------------------------


def _live_home(ws: Workspace, every: str | None = None) -> str:
    """A consumer that starts from latest: messages with payment type 2 are there before it, the
    others come after."""

    def run(home: str) -> None:
        source = f"{home}/topic"
        early = F.get_json_object(F.col("value").cast("string"), "$.payment_type") == "2"
        files.write_topic(ws.topic().filter(early), source, mode="overwrite")
        backlog = topic.present_files(ws.spark, source, f"{home}/backlog")
        files.write_topic(ws.topic().filter(~early), source)
        messages = _topic(ws, source, starting="latest", backlog=backlog)
        on_batch = log.folding(live.live_batch(home), partial(log.fold_all, home=home, logs=live.LOGS))
        log.run(messages, on_batch, f"{home}/checkpoint", every=every)

    return ws.once("stream_live_timed" if every else "stream_live", run)


@stream
def stream_live_stats(ws: Workspace) -> DataFrame:
    return live.live_stats(ws.spark, _live_home(ws))


@stream
def stream_live_timed(ws: Workspace) -> DataFrame:
    """The same snapshot, from batches a timer starts."""
    return live.live_stats(ws.spark, _live_home(ws, every="1 second"))


@stream
def stream_latency(ws: Workspace) -> DataFrame:
    return live.live_latency(ws.spark, _live_home(ws))


@stream
def stream_recent_trips(ws: Workspace) -> DataFrame:
    return live.recent_trips(ws.spark, _live_home(ws))


@stream
def stream_borough_dictionary(ws: Workspace) -> DataFrame:
    return rollup_stream.dictionary(ws.spark, _trips_home(ws))


def _windowed(ws: Workspace, name: str, window: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    def run(home: str) -> None:
        merge = {"": live.sum_windows(keys)}
        on_batch = log.folding(live.window_batch(home, window), partial(log.fold_all, home=home, logs=merge))
        log.run(_events(ws), on_batch, _checkpoint(ws, name))

    return live.windows(ws.spark, ws.once(name, run), keys)


def _text_time(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


@stream
def stream_hourly_window(ws: Workspace) -> DataFrame:
    found = _windowed(ws, "stream_hourly", live.hourly_window, ["window_start", "event_type"])
    return found.select(
        _text_time("window_start"),
        "event_type",
        "trips",
        F.col("revenue").cast("double").alias("revenue"),
    )


@stream
def stream_trips_per_minute(ws: Workspace) -> DataFrame:
    found = _windowed(ws, "stream_minutes", live.minute_rate, ["window_start", "window_end"])
    return found.select(_text_time("window_start"), _text_time("window_end"), "trips")


@stream
def stream_dedup(ws: Workspace) -> DataFrame:
    """Redelivered messages are dropped: the topic twice over for some trips."""

    def send_again(path: str) -> None:
        sent = ws.sent()
        body = F.from_json("value", "VendorID INT, payment_type INT")
        again = sent.filter((body["payment_type"] == 2) & (body["VendorID"] == 1))
        both = sent.unionByName(again)
        files.write_topic(files.envelope(both, F.col("arrived")), path, mode="overwrite")

    source = ws.once("topic_redelivered", send_again)

    def run(home: str) -> None:
        on_batch = log.folding(deliveries.delivery_batch(home), partial(deliveries.fold, home=home))
        log.run(_topic(ws, source), on_batch, _checkpoint(ws, "dedup"))

    return deliveries.without_redeliveries(ws.spark, ws.once("stream_dedup", run))
