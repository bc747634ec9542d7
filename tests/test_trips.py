"""Trip documents, metrics and trip-level anomaly rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farebox.functions import scalars as fn
from farebox.operators import anomalies, documents
from farebox.plans import analytics


def metrics(spark, pickup, dropoff, distance, fare, **kw):
    df = spark.createDataFrame([(pickup, dropoff, distance, fare)], "p string, d string, km double, fare double")
    m = documents.trip_metrics(F.col("p"), F.col("d"), F.col("km"), F.col("fare"), **kw)
    return df.select(m.alias("m")).first().m.asDict()


T0, T1 = "2024-01-01 00:00:00", "2024-01-01 00:30:00"


def test_metrics(spark):
    assert metrics(spark, T0, T1, 10.0, 25.0) == {
        "distance_km": 10.0, "duration_h": 0.5, "speed_kmh": 20.0, "price_per_km": 2.5
    }
    assert metrics(spark, T0, T1, 10.0, 25.0, hour_divisor=360.0)["duration_h"] == 5.0


@pytest.mark.parametrize(
    "args, speed, price",
    [
        ((T0, T1, 0.0, 25.0), None, None),
        ((T0, T1, None, 25.0), None, None),
        ((T0, T0, 10.0, 25.0), None, 2.5),
        (("bad", T1, 10.0, 25.0), None, 2.5),
        ((None, T1, 10.0, None), None, None),
        ((T1, T0, 10.0, 5.0), -20.0, 0.5),
        ((T0, T1, -2.0, 5.0), -4.0, 0.0),
    ],
)
def test_metrics_edges(spark, args, speed, price):
    got = metrics(spark, *args)
    assert (got["speed_kmh"], got["price_per_km"]) == (speed, price)


def test_dictionary_numbers_in_order_of_appearance(spark):
    df = spark.createDataFrame(
        [("t2", "C", "A"), ("t1", "B", "C"), ("t3", None, "D")], "trip_id string, p string, d string"
    )
    arrival = F.substring("trip_id", 2, 1).cast("bigint")
    first = documents.first_seen(df, arrival, F.col("p"), F.col("d"))
    got = {r.borough: r.borough_id for r in documents.borough_dictionary(first).collect()}
    assert got == {"B": 1, "C": 2, "A": 3, "D": 4}
    stored = spark.createDataFrame(list(got.items()), "borough string, borough_id int")
    ids = documents.add_borough_ids(df, stored, F.col("p"), F.col("d")).orderBy("trip_id").collect()
    assert [(r.pickup_borough_id, r.dropoff_borough_id) for r in ids] == [(1, 2), (2, 3), (None, 4)]


NAN = float("nan")


def anomaly(spark, distance=10.0, minutes=30, total=20.0, fare=15.0, tip=1.0, pickup=T0):
    end = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    df = spark.createDataFrame(
        [("t", "z", "w", "b", pickup, str(end), distance, total, fare, tip, 1.0)],
        "trip_id string, pickup_zone string, dropoff_zone string, borough string, "
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, trip_distance double, "
        "total_amount double, fare_amount double, tip_amount double, passenger_count double",
    )
    rows = anomalies.trip_anomalies(df).collect()
    return rows[0].anomaly_type if rows else None


@pytest.mark.parametrize(
    "change, label",
    [
        ({}, None),
        ({"distance": 0.0}, "zero_distance"),
        ({"distance": -1.0}, "zero_distance"),
        ({"distance": 0.0, "total": 0.0}, "invalid_amount"),
        ({"minutes": 0}, "invalid_duration"),
        ({"minutes": -5, "fare": -1.0}, "invalid_duration"),
        ({"pickup": "bad-date"}, "invalid_duration"),
        ({"pickup": None}, "invalid_duration"),
        ({"total": 0.0}, "invalid_amount"),
        ({"fare": -0.01}, "invalid_amount"),
        ({"tip": -1.0}, "other"),
        ({"distance": 75.5}, "high_speed"),
        ({"distance": 75.0}, None),
        # Null matches none of the conditions, so the trip is not found ...
        ({"total": None}, None),
        ({"distance": None}, None),
        ({"fare": None, "tip": None}, None),
        # ... but once it is found for another reason, null ranks below every number.
        ({"distance": None, "tip": -1.0}, "zero_distance"),
        ({"total": None, "tip": -1.0}, "invalid_amount"),
        ({"fare": None, "tip": -1.0}, "invalid_amount"),
        ({"distance": NAN}, None),
        ({"total": NAN}, None),
    ],
)
def test_anomaly_rules(spark, change, label):
    assert anomaly(spark, **change) == label


def test_card_labels(spark):
    rows = [(0.0, 5.0, 9.0), (1.0, -1.0, 9.0), (1.0, 0.0, -2.0), (1.0, 0.0, 0.0), (1.0, None, None)]
    df = spark.createDataFrame(rows, "km double, m double, t double")
    got = [r[0] for r in df.select(anomalies.card_label(F.col("km"), F.col("m"), F.col("t"))).collect()]
    assert got == ["Zero distance", "Invalid duration", "Invalid amount", "High speed", "High speed"]


def test_strict_time_fails_the_query(spark):
    good = spark.createDataFrame([(T0,), (None,)], "t string")
    assert good.select(fn.parse_time_strict(F.col("t")).alias("t")).first().t == dt.datetime(2024, 1, 1)
    bad = spark.createDataFrame([("bad-date",)], "tpep_pickup_datetime string").withColumns(
        {c: F.lit(1.0) for c in ("total_amount", "fare_amount", "trip_distance")}
    )
    with pytest.raises(Exception, match="not a timestamp"):
        analytics.hourly_stats(bad).collect()


@pytest.mark.parametrize(
    "size, text",
    [(0, "0 Bytes"), (1, "1 Bytes"), (1023, "1023 Bytes"), (1024, "1 KB"), (1536, "1.5 KB"),
     (1234567, "1.18 MB"), (1 << 30, "1 GB"), (1 << 40, "1 TB"), (1 << 50, "1024 TB")],
)
def test_format_bytes(spark, size, text):
    df = spark.createDataFrame([(float(size),)], "n double")
    assert df.select(fn.format_bytes(F.col("n"))).first()[0] == text


def test_small_strings(spark):
    df = spark.createDataFrame([("hello", "12.5%"), ("", " 3 % "), ("x", ""), (None, "n/a")], "s string, p string")
    got = df.select(fn.capitalize(F.col("s")), fn.strip_percent(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("Hello", 12.5), ("", 3.0), ("X", 0.0), ("", None)]
