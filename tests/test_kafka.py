"""The Kafka branches of the topic, through a local source with the connector's options and columns."""

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import local_kafka
from farebox.operators import rollups
from farebox.operators.rollups import ROLLUPS
from farebox.plans.workspace import Workspace
from farebox.schemas import ENVELOPE
from farebox.sinks import files
from farebox.sources import topic
from farebox.streaming import deliveries, log
from farebox.streaming import rollups as rollup_stream
from test_streams import same

LOCAL = {"connector": "local_kafka"}


@pytest.fixture(scope="module")
def ws(spark, sf_dir):
    cloudpickle.register_pickle_by_value(local_kafka)
    spark.dataSource.register(local_kafka.LocalKafka)
    return Workspace(spark, sf_dir)


@pytest.fixture
def brokers(tmp_path):
    return str(tmp_path / "brokers")


def test_messages_go_out_and_come_back(spark, ws, brokers, tmp_path):
    sent = ws.topic().limit(500).persist()
    files.write_topic(sent, brokers=brokers, name="trips", **LOCAL)
    stream = topic.topic_stream(spark, brokers=brokers, name="trips", **LOCAL)
    assert stream.isStreaming and stream.columns == [c.split()[0] for c in ENVELOPE.split(", ")]
    log.run(stream, lambda batch, i: log.write_batch(batch, str(tmp_path / "got"), i), str(tmp_path / "checkpoint"))
    got = log.read_batches(spark, str(tmp_path / "got"))
    assert same(got.select("key", "value"), sent.select("key", "value"))
    per = got.groupBy("partition").agg(F.count("*").alias("n"), F.max("offset").alias("last"), F.countDistinct("offset").alias("d"))
    assert all(r.n == r.d == r.last + 1 for r in per.collect()) and {r.topic for r in got.select("topic").collect()} == {"trips"}


def test_rollups_from_the_topic_equal_the_batch(spark, ws, brokers, tmp_path):
    home = str(tmp_path / "home")
    files.write_topic(ws.topic(), brokers=brokers, **LOCAL)
    on_batch = rollup_stream.rollup_batch(home)
    log.run(topic.topic_stream(spark, brokers=brokers, **LOCAL), on_batch, home + "/checkpoint")
    facts = rollups.accepted(rollups.facts_from_messages(topic.decode_facts(ws.topic())))
    for rollup in ROLLUPS.values():
        assert same(rollup_stream.stored_state(spark, home, rollup), rollups.aggregate(facts, rollup))


def test_bounded_batches(spark, ws, brokers, tmp_path):
    got = str(tmp_path / "got")
    files.write_topic(ws.topic().limit(300), brokers=brokers, **LOCAL)
    stream = topic.topic_stream(spark, brokers=brokers, per_trigger=90, **LOCAL)
    log.run(stream, lambda batch, i: log.write_batch(batch, got, i), str(tmp_path / "checkpoint"), every="0 seconds")
    read = log.read_batches(spark, got)
    assert read.count() == 300 == read.select("partition", "offset").distinct().count()
    assert read.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 90


def test_restart_goes_on_from_the_offsets(spark, ws, brokers, tmp_path):
    got = str(tmp_path / "got")
    for n in (200, 120):
        files.write_topic(ws.topic().limit(n), brokers=brokers, **LOCAL)
        stream = topic.topic_stream(spark, brokers=brokers, **LOCAL)
        log.run(stream, lambda batch, i: log.write_batch(batch, got, i), str(tmp_path / "checkpoint"))
    read = log.read_batches(spark, got)
    assert read.count() == 320 == read.select("partition", "offset").distinct().count()


def test_start_from_latest(spark, ws, brokers, tmp_path):
    checkpoint, got = str(tmp_path / "checkpoint"), str(tmp_path / "got")
    on_batch = lambda batch, i: log.write_batch(batch, got, i)
    files.write_topic(ws.topic().limit(40), brokers=brokers, **LOCAL)
    query = (
        topic.topic_stream(spark, brokers=brokers, starting="latest", **LOCAL)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .start()
    )
    try:
        query.processAllAvailable()
        files.write_topic(ws.topic().limit(25), brokers=brokers, **LOCAL)
        query.processAllAvailable()
    finally:
        query.stop()
    assert log.read_batches(spark, got).count() == 25


def test_first_delivery_by_offset(spark, ws, brokers, tmp_path):
    home = str(tmp_path / "home")
    message = lambda vendor: spark.range(1).select(
        F.lit("Q").cast("binary").alias("key"),
        F.lit(f'{{"trip_id": "t", "VendorID": {vendor}, "total_amount": 1.0}}').cast("binary").alias("value"),
    )
    for vendor in (2, 1):
        files.write_topic(message(vendor), brokers=brokers, **LOCAL)
    log.run(topic.topic_stream(spark, brokers=brokers, **LOCAL), deliveries.delivery_batch(home), home + "/checkpoint")
    assert [tuple(r) for r in deliveries.without_redeliveries(spark, home).collect()] == [("t", 2, 1.0)]
