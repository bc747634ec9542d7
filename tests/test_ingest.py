"""Enrichment, validation, encoding, record files and the zone table."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from farebox.operators import enrich
from farebox.sinks import files
from farebox.sources import tables, topic, zones
from farebox.plans.workspace import Workspace

FULL = {
    "PULocationID": {"borough": "Queens", "zone": "Astoria", "LocationID": 7},
    "DOLocationID": {"zone": "Midtown", "LocationID": 9},
    "tpep_pickup_datetime": "2024-01-01 00:00:00",
    "tpep_dropoff_datetime": "2024-01-01 00:10:00",
    "VendorID": 1,
}


def without(*path):
    record = json.loads(json.dumps(FULL))
    inner = record
    for step in path[:-1]:
        inner = inner[step]
    del inner[path[-1]]
    return record


def put(name, value):
    return {**FULL, name: value}


CASES = [
    (FULL, None),
    ({}, "Missing or invalid PULocationID"),
    (put("PULocationID", None), "Missing or invalid PULocationID"),
    (put("PULocationID", 7), "Missing or invalid PULocationID"),
    (put("PULocationID", "7"), "Missing or invalid PULocationID"),
    (put("PULocationID", [1]), "Missing or invalid PULocationID"),
    (put("DOLocationID", None), "Missing or invalid DOLocationID"),
    (without("PULocationID", "borough"), "Missing PULocationID.borough"),
    (without("PULocationID", "zone"), "Missing PULocationID.zone"),
    (without("PULocationID", "LocationID"), "Missing PULocationID.LocationID"),
    (without("DOLocationID", "zone"), "Missing DOLocationID.zone"),
    (without("DOLocationID", "LocationID"), "Missing DOLocationID.LocationID"),
    (without("tpep_pickup_datetime"), "Missing field: tpep_pickup_datetime"),
    (without("tpep_dropoff_datetime"), "Missing field: tpep_dropoff_datetime"),
    (without("VendorID"), "Missing field: VendorID"),
    # A key with a null value is present.
    (put("VendorID", None), None),
    (put("tpep_pickup_datetime", None), None),
    (put("PULocationID", {"borough": None, "zone": None, "LocationID": None}), None),
    # The first broken rule names the reason.
    ({"PULocationID": {}, "DOLocationID": 3}, "Missing or invalid DOLocationID"),
    ({"PULocationID": {}, "DOLocationID": {}}, "Missing PULocationID.borough"),
]


def test_reject_reasons(spark):
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, value string")
    got = {r.i: r.reason for r in enrich.validate(df).collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}


ZONES = "LocationID int, zone string, borough string, Shape_Leng double"


@pytest.fixture()
def small(spark):
    z = spark.createDataFrame([(1, "A", "X", 1.5), (2, "B", "Y", None)], ZONES)
    t = spark.createDataFrame(
        [("t1", 1, 2, None, "p"), ("t2", 99, 1, 2.0, "p"), ("t3", 1, None, 3.0, "p"), ("t4", 2, 98, 1.0, None)],
        "trip_id string, PULocationID int, DOLocationID int, passenger_count double, tpep_pickup_datetime string",
    ).withColumns({"tpep_dropoff_datetime": F.lit("d"), "VendorID": F.lit(1)})
    return t, z


def test_enrich_hit_miss_null(small):
    got = {r.trip_id: r for r in enrich.enrich(*small).collect()}
    assert got["t1"].PULocationID.asDict() == {"LocationID": 1, "zone": "A", "borough": "X", "Shape_Leng": 1.5}
    assert got["t2"].PULocationID.asDict() == {"LocationID": 99, "zone": None, "borough": None, "Shape_Leng": None}
    assert got["t3"].DOLocationID is None


def test_unresolved(small):
    got = {(r.trip_id, r.side, r.location_id) for r in enrich.unresolved(*small).collect()}
    assert got == {("t2", "pickup", 99), ("t4", "dropoff", 98)}


def test_messages_keep_nulls_and_bare_ids(small):
    rows = {r.trip_id: r for r in enrich.to_messages(*small, ["trip_id"]).collect()}
    first = json.loads(rows["t1"].value)
    assert rows["t1"].key == "X" and rows["t1"].reason is None
    assert first["passenger_count"] is None and "passenger_count" in first
    assert first["DOLocationID"] == {"LocationID": 2, "zone": "B", "borough": "Y", "Shape_Leng": None}
    assert json.loads(rows["t2"].value)["PULocationID"] == {"LocationID": 99}
    assert json.loads(rows["t3"].value)["DOLocationID"] is None


def test_both_ways_to_judge_a_record_agree(spark, sf_dir, small):
    ws = Workspace(spark, sf_dir)
    for trips, zone_table in (small, (ws.trips_raw(), ws.zones())):
        messages = enrich.to_messages(trips, zone_table, ["trip_id"])
        both = messages.withColumn("again", enrich.reject_reason(F.col("value")))
        assert both.filter(~F.col("reason").eqNullSafe(F.col("again"))).count() == 0
        assert both.filter("reason IS NOT NULL").count() > 0


def test_stamp(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "k string")
    live = enrich.stamp(rows).collect()
    assert len({r.trip_id for r in live}) == 2 and all(len(r.trip_id) == 32 for r in live)
    assert all(r.producer_timestamp > 1.7e12 for r in live)
    again = [sorted(r.trip_id for r in enrich.stamp(rows, ["k"]).collect()) for _ in range(2)]
    assert again[0] == again[1]


def test_record_files(spark, tmp_path):
    rows = [(f"s{i % 2}", json.dumps({"VendorID": i, "trip_id": str(i)})) for i in range(25)]
    df = spark.createDataFrame(rows, "stem string, value string").coalesce(1)
    path = str(tmp_path / "arrays")
    files.write_json_arrays(df, path, "stem", per_file=4)
    (tmp_path / "arrays" / "stem=s0" / "broken.txt").write_text('[{"VendorID": 1}, {"Vend')
    sizes = []
    for file in (tmp_path / "arrays").rglob("*.txt"):
        if file.name != "broken.txt":
            sizes.append(len(json.loads(file.read_text())))
    assert sum(sizes) == 25 and max(sizes) <= 4

    typed = tables.scan_json_arrays(spark, path)
    assert typed.count() == typed.filter("VendorID IS NOT NULL").count() == 25
    records = tables.json_records(spark, path)
    assert records.filter("record IS NOT NULL").count() == 25
    # The line that is cut off, and the array that never closes.
    assert records.filter("record IS NULL").count() == 2

    checked = records.withColumns({"is_valid": F.get_json_object("record", "$.VendorID").cast("int") < 5})
    stem = F.regexp_extract("file", r"([^/]+)$", 1) == "broken.txt"
    stats = enrich.ingest_stats(checked.withColumn("f", F.when(stem, "bad").otherwise("good")), "f")
    got = {r.source_file: r for r in stats.collect()}
    assert (got["ALL"].total_records, got["ALL"].sent_records, got["ALL"].skipped_records) == (25, 5, 20)
    assert (got["ALL"].files_processed, got["ALL"].success_rate) == (1, 20.0)
    assert (got["bad"].files_processed, got["bad"].success_rate) == (0, None)


def _bytes_under(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(path) for f in names)


def test_record_files_leave_no_copy_of_the_records(spark, tmp_path):
    """Equal records overfill a slot; files are packed, and nothing as large as the records stays beside them."""
    rows = [(f"s{i % 3}", json.dumps({"trip_id": str(i), "VendorID": i, "pad": "x" * 2000})) for i in range(300)]
    rows += [("s1", '{"trip_id": "same", "VendorID": 1}')] * 50 + [(None, '{"trip_id": "none", "VendorID": 2}')]
    df = spark.createDataFrame(rows, "stem string, value string").repartition(5)
    kept, path = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir"), tmp_path / "arrays"
    before = _bytes_under(kept)
    files.write_json_arrays(df, str(path), "stem", per_file=20, compression="gzip")
    assert _bytes_under(kept) - before < 100_000
    arrays = [json.loads(gzip.decompress(f.read_bytes())) for f in path.rglob("*.txt.gz")]
    assert not list(path.rglob("*.txt")) and max(map(len, arrays)) <= 20 and min(map(len, arrays)) > 0
    assert sorted(r["trip_id"] for a in arrays for r in a) == sorted(json.loads(v)["trip_id"] for _, v in rows)
    typed = tables.scan_json_arrays(spark, str(path), "trip_id STRING, VendorID INT")
    assert typed.count() == typed.filter("VendorID IS NOT NULL").count() == len(rows)
    records = tables.json_records(spark, str(path))
    assert records.filter("record IS NOT NULL").count() == records.count() == len(rows)


def test_json_lines_packed(spark, tmp_path):
    path = str(tmp_path / "packed")
    files.write_json_lines(spark.range(25).coalesce(1), path, 10, compression="gzip")
    packed = [gzip.decompress(f.read_bytes()).splitlines() for f in (tmp_path / "packed").glob("*.json.gz")]
    assert sorted(map(len, packed)) == [5, 10, 10]
    assert tables.json_records(spark, path, layout="lines").filter("record IS NOT NULL").count() == 25


def test_json_lines_cap(spark, tmp_path):
    path = str(tmp_path / "lines")
    files.write_json_lines(spark.range(25).coalesce(1), path, 10)
    counts = [len(f.read_text().splitlines()) for f in (tmp_path / "lines").glob("*.json")]
    assert sorted(counts) == [5, 10, 10]
    lines = tables.json_records(spark, path, layout="lines")
    assert lines.filter("record IS NOT NULL").count() == 25


def test_zone_dim(spark):
    rows = [
        (5, 50, "old", "g", 1),
        (5, 50, "new", "g", 2),
        (0, 6, "by object id", "g", 3),
        (None, 7, "null id", "g", 4),
        (0, 0, "none", "g", 5),
        (None, None, "none", "g", 6),
    ]
    df = spark.createDataFrame(rows, "LocationID int, OBJECTID int, zone string, geometry string, seq int")
    got = zones.zone_dim(df, "seq")
    assert "geometry" not in got.columns and "geometry_type" in got.columns
    assert {(r.zone_key, r.zone) for r in got.collect()} == {(5, "new"), (6, "by object id"), (7, "null id")}


def test_bad_key_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"Qu\xffens"),), (None,)], "key binary")
    got = [r.k for r in df.select(topic.key_text(F.col("key")).alias("k")).collect()]
    assert got == ["Qu�ens", None]


def test_geometry_types(spark):
    texts = ['{"type": "MultiPolygon", "coordinates": []}', "POLYGON ((0 0, 1 1))", "srid=4326; MultiPoint EMPTY", "ALGERIA", None]
    df = spark.createDataFrame([(t,) for t in texts], "g string").select(zones.geometry_type(F.col("g")).alias("k"))
    assert [r.k for r in df.collect()] == ["MultiPolygon", "Polygon", "MultiPoint", None, None]


def test_a_repeated_zone_id_multiplies_no_trip(spark):
    dim = spark.createDataFrame(
        [(1, "a", "Q"), (1, "b", "Q"), (2, "c", "Q"), (None, "d", "Q")], "LocationID int, zone string, borough string"
    )
    trips = spark.createDataFrame([("t", 1, 2), ("u", 9, None)], "trip_id string, PULocationID int, DOLocationID int")
    assert enrich.enrich(trips, dim).count() == 2
    assert enrich.to_messages(trips, dim).count() == 2
    row = enrich.enrich(trips, dim).filter("trip_id = 't'").first()
    assert (row.PULocationID.zone, row.DOLocationID.zone) == ("b", "c")


def test_arrays_on_one_line_and_arrays_cut_off(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"VendorID": 1}, {"VendorID": 2}]')
    (tmp_path / "b.json").write_text('[{"VendorID": 1},\n{"VendorID": 2},\n')
    got = tables.json_records(spark, str(tmp_path)).groupBy(F.regexp_extract("file", r"(\w)\.json", 1).alias("f"))
    rows = got.agg(F.count("record").alias("n"), F.count_if(F.col("record").isNull()).alias("bad")).collect()
    assert sorted(map(tuple, rows)) == [("a", 2, 0), ("b", 2, 1)]


def test_arrays_of_indented_records(spark, tmp_path):
    odd = 'a "quoted", {brace] \\ and \\" é'
    rows = [{"VendorID": i, "zone": {"name": odd, "at": [1, {"x": [i]}]}, "count": float("nan"), "none": None} for i in range(300)]
    del rows[7]["none"]
    # A bracket, then records of many lines with a comma behind each.
    whole = "[\n" + ",\n".join(json.dumps(r, indent=2) for r in rows) + "\n]"
    (tmp_path / "a.json").write_text(whole)
    (tmp_path / "b.json").write_text(whole[:-5])
    (tmp_path / "c.json").write_text(json.dumps(rows[:20], indent="\t").replace("},\n\t{", "}, {"))
    (tmp_path / "d.json").write_text(whole.replace('"none": null', '"none": nul', 1))
    (tmp_path / "e.json").write_text("[" + ",\n".join(json.dumps(r) for r in rows) + "]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = tables.json_records(spark, str(tmp_path)).select(F.regexp_extract("file", r"(\w)\.json", 1).alias("f"), "record").collect()
        lines = tables._array_lines(spark, str(tmp_path)).filter(F.col("file").endswith("a.json"))
        assert lines.select("start").distinct().count() > 3 and lines.rdd.getNumPartitions() > 3
        typed = tables.scan_json_arrays(spark, str(tmp_path), "VendorID INT, zone STRUCT<name STRING>").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    texts = {f: [r.record for r in got if r.f == f] for f in "abcde"}
    want = {r["VendorID"]: r for r in rows}
    for f, n in (("a", 300), ("c", 20), ("e", 300)):
        back = {r["VendorID"]: r for r in map(json.loads, texts[f])}
        assert len(texts[f]) == len(back) == n
        for i, r in back.items():
            assert r.keys() == want[i].keys() and r["zone"] == want[i]["zone"]
    assert texts["b"] and texts["d"] and not any(texts["b"] + texts["d"])
    assert sorted(r.VendorID for r in typed) == sorted([*range(300), *range(20), *range(300)])
    assert {r.zone.name for r in typed} == {odd}
    checked = enrich.validate(tables.json_records(spark, str(tmp_path)), "record").withColumn("f", F.regexp_extract("file", r"(\w)\.json", 1))
    stats = {r.source_file: (r.total_records, r.files_processed) for r in enrich.ingest_stats(checked, "f").collect()}
    assert stats == {"a": (300, 1), "b": (0, 0), "c": (20, 1), "d": (0, 0), "e": (300, 1), "ALL": (620, 3)}


def test_a_record_alone_on_its_line_is_taken_as_written(spark, tmp_path):
    """Its text is not written anew; single quotes, several records and arrays on a line are decoded as before."""
    lines = {
        "a": ['{"VendorID": 1, "fare": 1.50}', '{"VendorID":2,"zone":"O\'Hare, \\"x\\" é"}'],
        "b": ["{'VendorID': 3}"],
        "c": ['{"VendorID": 4}, {"VendorID": 5}', '{"VendorID": 6, "at": [1, {"x": "]"}]}'],
        "d": ['{"VendorID": 7, "count": NaN}', '{"VendorID": 8}'],
        "e": ['{"VendorID": 9}', '{"VendorID": 10}],[{"VendorID": 11}'],
        "f": ['{"VendorID": 12}', '{"VendorID": 13} x'],
    }
    for name, rows in lines.items():
        (tmp_path / f"{name}.json").write_text("[" + ",\n".join(rows) + "]")
    found = tables.json_records(spark, str(tmp_path)).select(F.regexp_extract("file", r"(\w)\.json", 1).alias("f"), "record").collect()
    got = {f: sorted((r.record for r in found if r.f == f), key=str) for f in lines}
    assert got["a"] == sorted(lines["a"]) and got["b"] == ['{"VendorID":3}']
    assert [json.loads(r)["VendorID"] for r in got["c"]] == [4, 5, 6] and json.loads(got["d"][0])["count"] == "NaN"
    assert [json.loads(r)["VendorID"] for r in got["e"]] == [10, 9] and got["f"] == [None]
    typed = tables.scan_json_arrays(spark, str(tmp_path), "VendorID INT").collect()
    assert sorted(r.VendorID for r in typed) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]


def test_files_that_are_not_asked_for_are_not_opened(spark, tmp_path):
    odd = tmp_path / "a b%#"
    odd.mkdir()
    for i in range(20):
        (odd / f"{i}.json").write_text('[{"VendorID": 1}]')
    names = sorted(r.file for r in tables._array_lines(spark, str(tmp_path)).select("file").collect())

    def opened(lines):
        scan = lines._jdf.queryExecution().executedPlan().collectLeaves().head()
        return lines.collect(), scan.metrics().apply("numFiles").value()

    rows, files_opened = opened(tables._array_lines(spark, str(tmp_path), only=names[:1]))
    assert [r.file for r in rows] == names[:1] and files_opened == 1
    rows, files_opened = opened(tables._array_lines(spark, str(tmp_path), without=names[:1]))
    assert sorted(r.file for r in rows) == names[1:] and files_opened == 19


def test_records_that_only_look_valid_are_judged_by_their_keys(spark):
    """A zone's key that comes twice counts as it stands first, however the second one is written."""
    full = json.dumps(FULL)
    zone, end = json.dumps(FULL["PULocationID"]), json.dumps(FULL["DOLocationID"])
    cases = [
        (full, None),
        ('{"PULocationID": 5, ' + full[1:], "Missing or invalid PULocationID"),
        ('{"DOLocationID": 5, ' + full[1:], "Missing or invalid DOLocationID"),
        ('{"PU\\u004cocationID": 5, ' + full[1:], "Missing or invalid PULocationID"),
        (full[:-1] + ', "PULocationID": null}', None),
        (full.replace(zone, json.dumps(zone)), None),
        (full.replace(end, json.dumps(end)), None),
        (full.replace('"VendorID"', "'VendorID'").replace("1}", "NaN}"), None),
        (full.replace('"Astoria"', '"LocationID \\\\ LocationID"'), None),
        (full[:-1], "Missing or invalid PULocationID"),
        (full + "}", None),
        (None, "Missing or invalid PULocationID"),
    ]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "i int, value string")
    rows = enrich.validate(df).withColumn("again", enrich.reject_reason(F.col("value"))).collect()
    assert {r.i: r.reason for r in rows} == {i: reason for i, (_, reason) in enumerate(cases)}
    assert all(r.reason == r.again and r.is_valid == (r.reason is None) for r in rows)
    plan = enrich.validate(df).select("is_valid")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "VendorID,StringType" in plan


def test_rows_are_dealt_before_their_text_is_made(spark, tmp_path):
    """Rows go to their files without the text; a task has about a file, and rows without a stem share a folder."""
    rows = [(f"s{i % 2}", i) for i in range(300)] + [("s1", 7)] * 50 + [(None, 400 + i) for i in range(30)] + [("", 500)]
    df = spark.createDataFrame(rows, "stem string, id int").repartition(3)
    near = files.dealt(df.withColumn("half", F.col("id") % 2), "stem", 20, ("half",))
    assert sorted(near.groupBy("half").agg(F.count_distinct("at").alias("n")).collect()) == [(0, 1), (1, 1)]
    dealt = near.drop("half")
    assert set(dealt.columns) == {"stem", "id", "slot", "at"} and dealt.rdd.getNumPartitions() >= len(rows) // 15
    records = dealt.withColumn("value", F.to_json(F.struct("id", F.lit("x" * 100).alias("pad"))))
    path = tmp_path / "arrays"
    files.write_json_arrays(records, str(path), "stem", per_file=20, compression="gzip")
    arrays = {f: json.loads(gzip.decompress(f.read_bytes())) for f in path.rglob("*.txt.gz")}
    assert max(map(len, arrays.values())) <= 20 and min(map(len, arrays.values())) > 0
    got = {}
    for f, found in arrays.items():
        got.setdefault(f.relative_to(path).parts[0], []).extend(r["id"] for r in found)
    want = {}
    for stem, i in rows:
        want.setdefault(f"stem={stem or files.NO_STEM}", []).append(i)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert tables.json_records(spark, str(path)).filter("record IS NOT NULL").count() == len(rows)
