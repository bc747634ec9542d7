"""How the ingest joins and the stored tables stand at scale."""

import datetime as dt

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from farebox.operators import rollups
from farebox.operators.rollups import ROLLUPS
from farebox.plans import streams
from farebox.plans.workspace import Workspace
from farebox.session import compilable
from farebox.sinks import files
from farebox.sources import testbed, topic
from farebox.streaming import log, served
from farebox.streaming import rollups as rollup_stream


def codecs(folder):
    return {
        meta.row_group(0).column(0).compression
        for meta in (pq.ParquetFile(f).metadata for f in folder.rglob("*.parquet"))
        if meta.num_row_groups
    }


def test_line_items_are_shuffled_by_order_only_once(spark, sf_dir):
    """Where nothing is broadcast, line items go to their order and to their supplier, and not to the customer too."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = testbed.trips_raw(spark, sf_dir)
        plan = trips._jdf.queryExecution().executedPlan().toString()
        rows = trips.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(o_custkey" not in plan
    assert rows == testbed.table(spark, sf_dir, "lineitem").count()


def test_ingest_keeps_repeated_keys_and_drops_null_ones(spark, tmp_path):
    """Every line item meets each order, customer and supplier with its keys."""
    def put(name, rows, ddl):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    put("customer", [(1, 3), (1, 4), (None, 5)], "c_custkey BIGINT, c_nationkey INT")
    put("supplier", [(1, "s", 2, 0.0), (1, "t", 6, 0.0)], "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")
    put("orders", [(10, 1), (10, 1), (11, None), (12, 9), (None, 1)], "o_orderkey BIGINT, o_custkey BIGINT")
    line = [(k, 7, s, 1, 3.0, 10.0, 0.1, "N", "O", None) for k, s in ((10, 1), (10, 2), (11, 1), (12, 1), (None, 1))]
    put("lineitem", line, testbed._DDL["lineitem"])
    got = testbed.trips_raw(spark, str(tmp_path)).select("PULocationID", "DOLocationID").collect()
    assert sorted(map(tuple, got)) == sorted(2 * [(3, 4), (3, 5), (7, 4), (7, 5)])


def test_stored_tables_are_packed(spark, sf_dir, tmp_path):
    for name, table in (("trips", Workspace.ingested), ("documents", Workspace.documents), ("topic", Workspace.topic)):
        table(Workspace(spark, sf_dir)).limit(5).count()
        kept = Workspace(spark, sf_dir).path(name)
        assert codecs(type(tmp_path)(kept)) == {"ZSTD"}, name
    log.write_batch(spark.range(5), str(tmp_path / "log"), 0)
    assert codecs(tmp_path / "log") == {"ZSTD"}


def test_a_topic_file_is_cut_into_row_groups(spark, tmp_path):
    """A micro-batch of few files still spreads: no row group holds much more than its share of packed bytes."""
    parts = [F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(8)]
    sent = spark.range(60_000).coalesce(1).select(
        F.lit("k").alias("key"), F.concat(*parts).alias("value"), F.timestamp_seconds("id").alias("at")
    )
    files.write_topic(files.envelope(sent, F.col("at")), str(tmp_path / "topic"))
    (file,) = (tmp_path / "topic").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 2 and meta.num_rows == 60_000
    assert topic.topic_batch(spark, str(tmp_path / "topic")).select("value").distinct().count() == 60_000


def test_batches_go_by_bytes_and_not_by_files(spark, sf_dir, tmp_path):
    """Many small files are one batch; files beyond the bound are left to the next one."""
    ws, source = Workspace(spark, sf_dir), str(tmp_path / "topic")
    files.write_topic(ws.topic().limit(60).repartition(9), source)
    most = 1 + max(f.stat().st_size for f in tmp_path.rglob("topic/*.parquet"))
    for name, bound, batches in (("all", {}, [60]), ("cut", {"max_bytes": 3 * most}, None)):
        seen = []
        log.run(streams._topic(ws, source, **bound), lambda batch, _: seen.append(batch.count()), str(tmp_path / name))
        assert sum(seen) == 60 and (seen == batches if batches else len(seen) > 1)


def test_no_stage_is_one_method_too_long_to_compile(spark, sf_dir):
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "65535")
        Workspace(spark, sf_dir)
        assert int(spark.conf.get(key)) <= 8000
        spark.conf.set(key, "12345")
        compilable(spark)
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.set(key, old)


def test_a_batch_is_held_without_what_nothing_reads(spark, sf_dir):
    held = rollup_stream.batch_facts(Workspace(spark, sf_dir).topic())
    assert not {"trip_id", "pickup_ts", "dropoff_ts"} & set(held.columns)
    for rollup in ROLLUPS.values():
        assert set(rollup.keys) <= set(held.columns)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trips_of_a_batch_are_shuffled_once_for_two_rollups(spark, sf_dir):
    facts = rollups.accepted(rollup_stream.batch_facts(Workspace(spark, sf_dir).topic()))
    for name, shuffles in (("route", 1), ("vendor", 1), ("pickup_zone", 2), ("borough_time", 2)):
        plan = _plan(rollups.aggregate(facts, ROLLUPS[name]))
        assert "REPARTITION_BY_COL" in plan and plan.count("Exchange hashpartitioning") == shuffles


def test_ranges_of_a_served_table_have_a_known_size(spark):
    segments = [{"path": f"p{i}", "month": "2024-01", "low": str(i)} for i in range(3)]
    ranges = served._ranges(spark, segments)
    assert ranges._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 20
    assert [(r.from_key, r.to_key) for r in ranges.orderBy("owner").collect()] == [("", "1"), ("1", "2"), ("2", None)]


def test_numbers_parsed_as_numbers_give_the_same_facts(spark):
    head = '{"trip_id": "t", "tpep_pickup_datetime": "2024-01-05 07:00:00", "tpep_dropoff_datetime": "2024-01-05 07:10:00"'
    odd = ["1.5", '"2.25"', "null", '"abc"', "NaN", '"NaN"', "true", "1e300", "-0.0", "123456789012345678901", "[1]", "0.0009765625"]
    texts = [head + f', "fare_amount": {v}, "passenger_count": 1, "VendorID": 2}}' for v in odd]
    texts += [head + "}", head + ', "mta_tax": 0.5, "tip_amount": "x"}', "no json", head]
    rows = [(bytearray(t.encode()), dt.datetime(2024, 1, 5)) for t in texts]
    envelope = spark.createDataFrame(rows, "value binary, timestamp timestamp")
    quick, slow = (
        sorted(rollups.facts_from_messages(d(envelope)).toJSON().collect()) for d in (topic.decode_numbers, topic.decode_facts)
    )
    assert quick == slow and len(quick) == len(texts)
