"""Stored tables of one input folder: each is written once per application, then only read.

Trips are ingested once and every analysis reads the stored table; the rollups are far smaller
and are what most analyses read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions.scalars import parse_time
from farebox.operators import documents, enrich, rollups
from farebox.operators.rollups import ROLLUPS
from farebox.schemas import TRIP_FILE
from farebox.session import compilable, shared_dir
from farebox.sinks import files
from farebox.sources import testbed, topic
from farebox.sources.zones import zone_dim
from farebox.storage import PACKED

TRIP_FIELDS = [field.split()[0] for field in TRIP_FILE.split(", ")]

_written: set[str] = set()
_schemas: dict = {}


def _arrival() -> Column:
    """When a trip's message reaches the topic: 0 to 4999 ms after the dropoff."""
    dropped_off = F.unix_millis(F.col("tpep_dropoff_datetime").cast("timestamp"))
    delay = F.abs(F.col("total_amount") * 100).cast("bigint") % 5000
    return F.timestamp_millis(dropped_off + delay)


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        compilable(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self._home = hashlib.md5(sf_dir.encode()).hexdigest()[:12]

    def path(self, name: str) -> str:
        return shared_dir(self.spark, self._home, name)

    def once(self, name: str, write: Callable[[str], None]) -> str:
        """Path of a stored table, written on first use."""
        path = self.path(name)
        if path not in _written:
            write(path)
            _written.add(path)
        return path

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        frame: list[DataFrame] = []

        def write(path: str) -> None:
            frame.append(build())
            frame[0].write.mode("overwrite").options(**PACKED).parquet(path)
            _schemas[path] = frame[0].schema

        path = self.once(name, write)
        return self.spark.read.schema(_schemas[path]).parquet(path)

    # ---- trips -------------------------------------------------------------------------------

    def zones(self) -> DataFrame:
        """The zone dimension: one row per id, the last of the table's rows for it."""

        def build() -> DataFrame:
            listed = testbed.zones(self.spark, self.sf_dir).withColumn("seq", F.col("OBJECTID"))
            return zone_dim(listed, "seq").drop("zone_key").coalesce(1)

        return self._table("zones", build)

    def ingested(self) -> DataFrame:
        """Every trip with the names of its zones, where known, and its times, where they parse."""
        return self._table("trips", self._ingest)

    def _ingest(self) -> DataFrame:
        names = self.zones().select("LocationID", "borough", "zone")
        trips = testbed.trips_raw(self.spark, self.sf_dir)
        pickup = names.toDF("PULocationID", "borough", "pickup_zone")
        dropoff = names.toDF("DOLocationID", "dropoff_borough", "dropoff_zone")
        return (
            trips.join(pickup, "PULocationID", "left")
            .join(dropoff, "DOLocationID", "left")
            .withColumn("pickup_ts", parse_time(F.col("tpep_pickup_datetime")))
            .withColumn("dropoff_ts", parse_time(F.col("tpep_dropoff_datetime")))
        )

    def trips_raw(self) -> DataFrame:
        """Trips as their files hold them."""
        return self.ingested().select(*TRIP_FIELDS, "trip_id", "stem")

    def resolved(self) -> DataFrame:
        """Trips with both zones known, whatever their times."""
        return self.ingested().filter("borough IS NOT NULL AND dropoff_borough IS NOT NULL")

    def trips(self) -> DataFrame:
        """Trips with parseable times and both zones known: what the analyses read."""
        return self.resolved().filter("pickup_ts IS NOT NULL")

    def events(self) -> DataFrame:
        return testbed.events(self.spark, self.sf_dir)

    # ---- messages ----------------------------------------------------------------------------

    def enriched(self) -> DataFrame:
        return enrich.enrich(self.trips_raw(), self.zones())

    def records(self) -> DataFrame:
        """Every enriched trip as the JSON text the converter writes, valid or not."""
        return enrich.to_messages(self.trips_raw(), self.zones(), ["trip_id", "stem"]).drop("reason")

    def sent(self) -> DataFrame:
        """Valid trips stamped and encoded, with the instant they reach the topic.

        The stamp is the dropoff time; a message arrives 0 to 4999 ms later.
        """
        dropped_off = F.unix_millis(F.col("tpep_dropoff_datetime").cast("timestamp"))
        stamped = self.trips_raw().withColumns(
            {"producer_timestamp": dropped_off.cast("double"), "arrived": _arrival()}
        )
        messages = enrich.to_messages(stamped, self.zones(), ["trip_id", "stem", "arrived"])
        return messages.filter("reason IS NULL")

    def topic_path(self) -> str:
        def write(path: str) -> None:
            files.write_topic(
                files.envelope(self.sent(), F.col("arrived")), path, mode="overwrite"
            )

        return self.once("topic", write)

    def topic(self) -> DataFrame:
        return topic.topic_batch(self.spark, self.topic_path())

    def dictionary(self) -> DataFrame:
        """Borough ids in order of first appearance by arrival."""
        return self._table("borough_dictionary", self.dictionary_of_trips)

    def dictionary_of_trips(self) -> DataFrame:
        arrival = F.unix_millis(_arrival())
        return documents.borough_dictionary(
            documents.first_seen(self.resolved(), arrival, F.col("borough"), F.col("dropoff_borough"))
        )

    def documents(self) -> DataFrame:
        """The topic's trip documents, written once."""

        def build() -> DataFrame:
            messages = topic.decode_wire(self.topic()).select("msg.*")
            return documents.to_documents(messages, self.dictionary())

        return self._table("documents", build)

    # ---- rollups -----------------------------------------------------------------------------

    def facts(self) -> DataFrame:
        return rollups.facts_from_trips(self.trips())

    def state(self, name: str) -> DataFrame:
        """Stored state of a rollup."""
        rollup = ROLLUPS[name]

        def write(path: str) -> None:
            state = rollups.aggregate(rollups.accepted(self.facts()), rollup)
            files.write_rollup(state, rollup, path)
            _schemas[path] = state.schema

        path = self.once(f"rollup_{name}", write)
        return files.read_rollup(self.spark, path, _schemas[path])

    def rollup(self, name: str) -> DataFrame:
        return rollups.present(self.state(name), ROLLUPS[name])
