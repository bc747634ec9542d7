"""Streams in several batches, replays, restarts."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from farebox.operators import rollups
from farebox.operators.rollups import ROLLUPS
from farebox.plans.workspace import Workspace
from farebox.sources import topic
from farebox.streaming import deliveries, live, log, served, versions
from farebox.streaming import rollups as rollup_stream


@pytest.fixture(scope="module")
def ws(spark, sf_dir):
    return Workspace(spark, sf_dir)


@pytest.fixture(scope="module")
def rollup_home(spark, ws, tmp_path_factory):
    """The whole topic through the rollup stream, three files at a time."""
    home = str(tmp_path_factory.mktemp("rollups"))
    source = topic.topic_stream(spark, ws.topic_path(), per_trigger=3)
    log.run(source, rollup_stream.rollup_batch(home), home + "/checkpoint")
    return home


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def whole_state(ws, rollup):
    facts = rollups.facts_from_messages(topic.decode_facts(ws.topic()))
    return rollups.aggregate(rollups.accepted(facts), rollup)


def test_stream_equals_batch(spark, ws, rollup_home):
    for rollup in ROLLUPS.values():
        parts = log.read_batches(spark, f"{rollup_home}/{rollup.name}")
        assert parts.select("batch_id").distinct().count() > 2
        assert same(rollup_stream.stored_state(spark, rollup_home, rollup), whole_state(ws, rollup))


def test_replayed_batch_changes_nothing(spark, ws, rollup_home):
    rollup = ROLLUPS["borough_time"]
    before = rollup_stream.stored_state(spark, rollup_home, rollup).checkpoint()
    # The same files under the same batch number, as after a failure between write and commit.
    used = json.loads(open(f"{rollup_home}/checkpoint/sources/0/1").read().splitlines()[1])
    again = [
        json.loads(line)["path"]
        for line in open(f"{rollup_home}/checkpoint/sources/0/1").read().splitlines()[1:]
    ]
    assert used["batchId"] == 1 and again
    batch = spark.read.schema(ws.topic().schema).parquet(*again)
    rollup_stream.rollup_batch(rollup_home)(batch, 1)
    assert same(rollup_stream.stored_state(spark, rollup_home, rollup), before)


def test_restart_reads_only_what_is_new(spark, ws, tmp_path):
    source, home = str(tmp_path / "topic"), str(tmp_path / "home")
    messages = ws.topic().withColumn("half", F.xxhash64("value") % 2 == 0).persist()
    stream = lambda: log.run(
        topic.topic_stream(spark, source), rollup_stream.rollup_batch(home), home + "/checkpoint"
    )
    messages.filter("half").drop("half").write.parquet(source)
    stream()
    messages.filter("NOT half").drop("half").write.mode("append").parquet(source)
    stream()
    rollup = ROLLUPS["vendor"]
    assert same(rollup_stream.stored_state(spark, home, rollup), whole_state(ws, rollup))
    got = rollup_stream.ingest_metrics(spark, home).first()
    assert got.received == messages.count() and got.received == got.processed + got.rejected


def files_of(table):
    return {str(f) for f in table.rglob("*.parquet")}


def live_files(spark, table):
    """The data files of the current version."""
    return {f for s in versions.current(spark, str(table)).segments for f in files_of(table / s["path"])}


def test_publish_serves_the_state_and_nothing_new_changes_no_file(spark, ws, tmp_path):
    home = str(tmp_path / "home")
    log.run(topic.topic_stream(spark, ws.topic_path(), per_trigger=3), rollup_stream.rollup_batch(home), home + "/checkpoint")
    rollup_stream.publish(spark, home)
    held = files_of(tmp_path / "home")
    for rollup in ROLLUPS.values():
        state = rollup_stream.stored_state(spark, home, rollup)
        assert same(state, whole_state(ws, rollup)) and same(served.read(spark, rollup_stream.served_table(home, rollup), state.schema), state)
        months = [r[0] for r in state.select("year_month").distinct().limit(2).collect()]
        for m in months:
            part = served.read(spark, rollup_stream.served_table(home, rollup), state.schema, month=m)
            assert same(part, state.filter(F.col("year_month") == m))
    rollup_stream.publish(spark, home)
    assert {f for f in files_of(tmp_path / "home") if "served" in f} == {f for f in held if "served" in f}
    got = rollup_stream.ingest_metrics(spark, home).first()
    assert got.received == ws.topic().count() and got.received == got.processed + got.rejected


@pytest.mark.parametrize("rows_per_range", [1, 50, 100_000])
def test_a_batch_of_one_borough_rewrites_its_range_only(spark, ws, tmp_path, rows_per_range):
    rollup, source, table = ROLLUPS["pickup_zone"], str(tmp_path / "log"), tmp_path / "table"
    state = whole_state(ws, rollup).persist()
    month, borough = state.groupBy("year_month", "borough").count().orderBy(F.desc("count")).first()[:2]
    log.write_batch(state, source, 0)
    made = served.publish(spark, source, rollup, str(table), rows_per_range)
    before, pairs = live_files(spark, table), state.select("year_month", "borough").distinct().count()
    assert made == (pairs if rows_per_range == 1 else made) and len(before) >= made
    one = state.filter((F.col("year_month") == month) & (F.col("borough") == borough))
    log.write_batch(one, source, 1)
    written = served.publish(spark, source, rollup, str(table), rows_per_range)
    after = live_files(spark, table)
    assert written == 1 or rows_per_range == 50
    assert before - after and len(before & after) >= made - 1 if rows_per_range == 1 else before & after
    expected = rollups.merge(state.unionByName(one), rollup)
    assert same(served.read(spark, str(table), state.schema), expected)
    # A borough nobody has seen, and a month nobody has seen.
    odd = one.limit(3).withColumn("borough", F.lit("ZZ")).unionByName(one.limit(2).withColumn("year_month", F.lit("2031-01")))
    odd = odd.unionByName(one.limit(1).withColumn("borough", F.lit(None).cast("string")).withColumn("year_month", F.lit(None).cast("string")))
    log.write_batch(odd, source, 2)
    served.publish(spark, source, rollup, str(table), rows_per_range)
    assert same(served.read(spark, str(table), state.schema), rollups.merge(expected.unionByName(odd), rollup))


def test_a_publish_that_stopped_half_way_is_done_again(spark, ws, tmp_path, monkeypatch):
    rollup, source, table = ROLLUPS["vendor"], str(tmp_path / "log"), str(tmp_path / "table")
    state = whole_state(ws, rollup)
    log.write_batch(state, source, 0)
    with monkeypatch.context() as broken:
        broken.setattr(versions, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            served.publish(spark, source, rollup, table)
    assert same(served.state(spark, source, rollup, table), state)
    served.publish(spark, source, rollup, table)
    assert same(served.read(spark, table, state.schema), state)


def test_two_writers_of_one_version(spark, tmp_path):
    table = str(tmp_path)
    was = versions.current(spark, table)
    versions.commit(spark, table, was, 0, [{"path": "a"}])
    with pytest.raises(RuntimeError):
        versions.commit(spark, table, was, 0, [{"path": "b"}])
    assert versions.current(spark, table).segments == [{"path": "a"}]


def directories(path):
    return [d for d in path.rglob("*") if d.is_dir() and ("batch_id=" in d.name or "upto=" in d.name)]


def test_every_log_stays_small_and_keeps_its_result(spark, ws, tmp_path):
    """Twelve batches folded after every second: readers see the same rows, few directories are left."""
    messages, events, n = ws.topic(), ws.events(), 12
    trips, shown, hours, once = (str(tmp_path / x) for x in ("trips", "live", "hours", "once"))
    keys = ["window_start", "event_type"]
    folds = {
        trips: (rollup_stream.rollup_batch(trips), lambda s: rollup_stream.publish(s, trips)),
        shown: (live.live_batch(shown), lambda s: log.fold_all(s, shown, live.LOGS)),
        once: (deliveries.delivery_batch(once, 4), lambda s: deliveries.fold(s, once)),
    }
    for on_batch, fold in folds.values():
        in_batches(messages, n, log.folding(on_batch, fold, every=2))
    merge = {"": live.sum_windows(keys)}
    on_batch = live.window_batch(hours, live.hourly_window)
    in_batches(events, n, log.folding(on_batch, lambda s: log.fold_all(s, hours, merge), every=2))
    logs = [tmp_path / "trips" / x for x in (*rollup_stream.LOGS, *ROLLUPS)] + [tmp_path / "trips" / f"served_{x}" for x in ROLLUPS]
    logs += [tmp_path / "live" / x for x in live.LOGS] + [tmp_path / "hours", tmp_path / "once"]
    # The last two folds' batches, and what the last two versions list.
    assert all(len(directories(x)) <= 8 for x in logs), [(str(x), len(directories(x))) for x in logs]
    for rollup in ROLLUPS.values():
        assert same(rollup_stream.stored_state(spark, trips, rollup), whole_state(ws, rollup))
    assert same(rollup_stream.dictionary(spark, trips), ws.dictionary())
    got = rollup_stream.ingest_metrics(spark, trips).first()
    assert got.received == messages.count() and got.received == got.processed + got.rejected
    whole = str(tmp_path / "whole")
    in_batches(messages, 1, live.live_batch(whole))
    for read in (live.live_stats, live.live_latency, live.recent_trips):
        assert same(read(spark, shown), read(spark, whole))
    assert same(live.windows(spark, hours, keys), live.hourly_window(events))
    assert deliveries.without_redeliveries(spark, once).count() == messages.count()


def test_folding_beside_a_reader(spark, ws, tmp_path):
    """What a reader has begun to read stays until a later fold."""
    home = str(tmp_path / "hours")
    keys = ["window_start", "event_type"]
    events = ws.events().withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(4))).persist()
    for k in range(3):
        live.window_batch(home, live.hourly_window)(events.filter(F.col("part") == k).drop("part"), k)
        if k == 1:
            log.fold(spark, home, live.sum_windows(keys))
    begun = live.windows(spark, home, keys)
    log.fold(spark, home, live.sum_windows(keys))
    live.window_batch(home, live.hourly_window)(events.filter("part = 3").drop("part"), 3)
    assert same(begun, live.hourly_window(events.filter("part < 3")))
    assert same(live.windows(spark, home, keys), live.hourly_window(events))


def test_a_batch_that_is_not_complete_is_not_read(spark, tmp_path):
    home = str(tmp_path / "log")
    log.write_batch(spark.range(3), home, 0)
    log.write_batch(spark.range(5), home, 1)
    os.remove(f"{home}/batch_id=1/_SUCCESS")
    assert log.read_batches(spark, home).count() == 3


def in_batches(rows, n, on_batch):
    """Feed the rows in ``n`` batches, out of time order."""
    marked = rows.withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.lit(n))).persist()
    for k in range(n):
        on_batch(marked.filter(F.col("part") == k).drop("part"), k)
    marked.unpersist()


@pytest.mark.parametrize("n", [1, 2, 4])
def test_same_results_in_any_batches(spark, ws, tmp_path, n):
    home = str(tmp_path)
    events = ws.events()
    in_batches(events, n, live.window_batch(f"{home}/hours", live.hourly_window))
    in_batches(events, n, live.window_batch(f"{home}/minutes", live.minute_rate))
    assert same(live.windows(spark, f"{home}/hours", ["window_start", "event_type"]), live.hourly_window(events))
    assert same(live.windows(spark, f"{home}/minutes", ["window_start", "window_end"]), live.minute_rate(events))
    messages = ws.topic()
    in_batches(messages.unionByName(messages), n, deliveries.delivery_batch(f"{home}/once"))
    once = deliveries.without_redeliveries(spark, f"{home}/once")
    assert once.count() == messages.count() == once.select("trip_id").distinct().count()
    in_batches(messages, n, rollup_stream.rollup_batch(f"{home}/trips"))
    assert same(rollup_stream.dictionary(spark, f"{home}/trips"), ws.dictionary())


def test_start_from_latest_skips_the_backlog_also_after_a_restart(spark, ws, tmp_path):
    source, home = str(tmp_path / "topic"), str(tmp_path / "home")
    third = F.pmod(F.xxhash64("value"), F.lit(3))
    send = lambda k: ws.topic().filter(third == k).write.mode("append").parquet(source)
    send(0)
    for k in (1, 2):
        backlog = topic.present_files(spark, source, home + "/backlog")
        send(k)
        # All files of one instant, some committed under an earlier time.
        for file in files_of(tmp_path / "topic"):
            os.utime(file, (1.7e9 - k, 1.7e9 - k))
        stream = topic.topic_stream(spark, source, starting="latest", backlog=backlog, per_trigger=2)
        log.run(stream, live.live_batch(home), home + "/checkpoint")
    assert live.live_stats(spark, home).first().total_trips == ws.topic().filter(third != 0).count()


def test_dictionary_grows_over_batches(spark, tmp_path):
    def messages(*pairs):
        rows = [
            (bytearray(json.dumps({"trip_id": str(i), "PULocationID": {"borough": p}, "DOLocationID": {"borough": d}}).encode()),)
            for i, (p, d) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, "value binary").withColumns(
            {"key": F.lit(None).cast("binary"), "timestamp": F.current_timestamp()}
        )

    home = str(tmp_path / "dict")
    on_batch = rollup_stream.rollup_batch(home)
    at = lambda ms, *pairs: messages(*pairs).withColumn("timestamp", F.timestamp_millis(F.lit(ms)))
    on_batch(at(2000, ("C", "A")), 0)
    on_batch(at(1000, ("B", "A")), 1)  # earlier, though it comes later
    for _ in range(2):
        on_batch(at(3000, ("E", "B"), (None, "D")), 2)
    got = {r.borough: r.borough_id for r in rollup_stream.dictionary(spark, home).collect()}
    assert got == {"B": 1, "A": 2, "C": 3, "E": 4, "D": 5}


def test_recent_trips_over_batches(spark, ws, tmp_path):
    home = str(tmp_path / "live")
    source = topic.topic_stream(spark, ws.topic_path(), per_trigger=4)
    log.run(source, live.live_batch(home), home + "/checkpoint")
    decoded = topic.decode_wire(ws.topic())
    newest = decoded.orderBy(F.desc("timestamp"), F.desc("msg.trip_id")).limit(15).select("msg.trip_id")
    assert [r.trip_id for r in live.recent_trips(spark, home).collect()] == [r.trip_id for r in newest.collect()]
    total = live.live_stats(spark, home).first()
    assert total.total_trips == ws.topic().count()


def test_recent_trips_first_of_each_poll(spark, ws, tmp_path):
    home = str(tmp_path / "polls")
    parts = ws.topic().randomSplit([0.5, 0.5], seed=1)
    for n, part in enumerate(parts):
        live.live_batch(home, per_poll=5)(part, n)
    assert log.read_batches(spark, f"{home}/recent").groupBy("batch_id").count().filter("count = 5").count() == 2
    assert live.recent_trips(spark, home).count() == 10


def test_cards_fill_in_what_is_unknown(spark):
    rows = [(bytearray(b'{"PULocationID": 5, "total_amount": null, "trip_distance": "2"}'),)]
    df = spark.createDataFrame(rows, "value binary").withColumn("timestamp", F.current_timestamp())
    row = topic.decode_facts(df).select(*live.card(), *live.measures()).first()
    assert (row.trip_id, row.pickup_zone, row.dropoff_zone, row.borough) == ("N/A", "Unknown", "Unknown", "Unknown")
    assert (row.amount, row.distance, row.broken, row.latency_ms) == (0.0, 2.0, False, None)


def test_redeliveries_across_batches(spark, ws, tmp_path):
    source, home = str(tmp_path / "topic"), str(tmp_path / "out")
    for _ in range(2):
        ws.topic().write.mode("append").parquet(source)
        stream = topic.topic_stream(spark, source, per_trigger=1)
        log.run(stream, deliveries.delivery_batch(home), str(tmp_path / "checkpoint"))
    out = deliveries.without_redeliveries(spark, home)
    assert out.count() == out.select("trip_id").distinct().count() == ws.topic().count()


ENVELOPE = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def deliveries_of(spark, rows):
    """(trip_id, arrival in ms, vendor, amount, partition, offset) as messages."""
    made = [
        (None, bytearray(json.dumps({"trip_id": t, "VendorID": v, "total_amount": a}).encode()), "t", p, o, at)
        for t, at, v, a, p, o in rows
    ]
    df = spark.createDataFrame(made, ENVELOPE.replace("timestamp timestamp", "at long"))
    return df.withColumn("timestamp", F.timestamp_millis("at")).drop("at")


@pytest.mark.parametrize("n", [1, 2, 4])
def test_ties_give_one_whole_message_in_any_batches(spark, tmp_path, n):
    rows = [("a", 5, 2, 1.0, None, None), ("a", 5, 1, 9.0, None, None), ("a", 6, 1, 0.0, None, None)]
    rows += [("b", 5, 1, 7.0, 3, 9), ("b", 5, 2, 8.0, 3, 4), ("b", 5, 0, 0.0, 4, 1)]
    rows += [("c", 5, None, 3.0, None, None), ("c", 5, 1, None, None, None), (None, 1, 1, 1.0, None, None), (None, 1, 1, 2.0, None, None)]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        home = str(tmp_path / f"{n}_{seed}")
        on_batch = log.folding(deliveries.delivery_batch(home, 3), lambda s, home=home: deliveries.fold(s, home), every=2)
        for k in range(n):
            on_batch(deliveries_of(spark, rows[k::n]), k)
        got = {r.trip_id: (r.vendor_id, r.total_amount) for r in deliveries.without_redeliveries(spark, home).collect()}
        assert got == {"a": (1, 9.0), "b": (2, 8.0), "c": (None, 3.0), None: (1, 1.0)}


def test_only_touched_buckets_of_the_index_are_replaced(spark, tmp_path):
    home = str(tmp_path / "index")
    on_batch = deliveries.delivery_batch(home, 16)
    on_batch(deliveries_of(spark, [(f"t{i}", 100, 1, 1.0, None, None) for i in range(400)]), 0)
    on_batch(deliveries_of(spark, [("t0", 90, 2, 5.0, None, None), ("t0", 95, 3, 6.0, None, None)]), 1)
    assert deliveries.fold(spark, home) == 16
    before = live_files(spark, tmp_path / "index")
    on_batch(deliveries_of(spark, [("t1", 200, 4, 4.0, None, None)]), 2)
    # Batch 1 is folded now: one bucket is read and written, the others stay.
    assert deliveries.fold(spark, home) == 1
    after = live_files(spark, tmp_path / "index")
    assert len(before - after) == len(after - before) == 1
    read = deliveries.without_redeliveries(spark, home)
    assert read.count() == 400 and tuple(read.filter("trip_id = 't0'").first()) == ("t0", 2, 5.0)
    # A reader groups the touched bucket only: its files and one batch.
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Union" in plan


def test_late_rows_still_count(spark, tmp_path):
    source, home = str(tmp_path / "events"), str(tmp_path / "home")
    schema = "event_id bigint, ts timestamp, event_type string, value double"

    def send(*times):
        rows = [(i, t, "view", 1.0) for i, t in enumerate(times)]
        df = spark.createDataFrame(rows, "event_id bigint, t string, event_type string, value double")
        df.withColumn("ts", F.col("t").cast("timestamp")).drop("t").coalesce(1).write.mode("append").parquet(source)
        log.run(
            spark.readStream.schema(schema).parquet(source),
            live.window_batch(home, live.hourly_window),
            str(tmp_path / "checkpoint"),
        )

    send("2024-01-01 10:05:00", "2024-01-01 10:59:59", "2024-01-01 12:30:00")
    send("2024-01-01 10:30:00", "2024-01-01 12:31:00")
    send("2024-01-01 12:25:00")
    found = live.windows(spark, home, ["window_start", "event_type"])
    got = {str(r.window_start)[11:16]: r.trips for r in found.collect()}
    assert got == {"10:00": 3, "12:00": 3}
