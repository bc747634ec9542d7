"""Schemas of the stored and exchanged records (DDL text), and the domain code tables."""

from __future__ import annotations

# Code meanings. Codes outside these tables are not counted.
RATE_CODES = {"standard": 1, "jfk": 2, "newark": 3, "nassau": 4, "negotiated": 5, "group": 6}
PAYMENT_CODES = {"card": 1, "cash": 2, "free": 3, "dispute": 4, "unknown": 5, "voided": 6}
VENDOR_CODES = {"cmt": 1, "verifone": 2}

# Unit factors and detector thresholds.
KM_TO_MILES = 0.621371
MILES_TO_KM = 1.60934
MAX_SPEED_KMH = 150
MAX_SPEED_MPH = 90

# Anomaly labels, in reporting order.
ANOMALY_LABELS = ["zero_distance", "invalid_duration", "invalid_amount", "high_speed", "other"]
CARD_LABELS = ["Zero distance", "Invalid duration", "Invalid amount", "High speed"]

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

_TRIP_HEAD = "VendorID INT, tpep_pickup_datetime STRING, tpep_dropoff_datetime STRING, "
_TRIP_TAIL = (
    "passenger_count DOUBLE, trip_distance DOUBLE, RatecodeID INT, store_and_fwd_flag STRING, "
    "{pickup}, {dropoff}, payment_type INT, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, "
    "tip_amount DOUBLE, tolls_amount DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE, "
    "congestion_surcharge DOUBLE, Airport_fee DOUBLE"
)

ZONE_DDL = (
    "OBJECTID INT, Shape_Leng DOUBLE, Shape_Area DOUBLE, zone STRING, LocationID INT, "
    "borough STRING, geometry_type STRING"
)

# A raw trip file: zone ids are plain ints.
TRIP_FILE = (
    _TRIP_HEAD + _TRIP_TAIL.format(pickup="PULocationID INT", dropoff="DOLocationID INT")
)

# The message on the topic: zone ids are replaced by the zone's own record.
WIRE = (
    _TRIP_HEAD
    + _TRIP_TAIL.format(
        pickup=f"PULocationID STRUCT<{ZONE_DDL}>", dropoff=f"DOLocationID STRUCT<{ZONE_DDL}>"
    )
    + ", producer_timestamp DOUBLE, trip_id STRING"
)

# The numbers of a trip that the rollups add up.
NUMBERS = ["passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount", "mta_tax"]

# What the rollups need from a message. Numbers arrive as text so that a value that does not
# convert can be told from a value that is absent.
FACT = (
    "trip_id STRING, producer_timestamp DOUBLE, VendorID DOUBLE, RatecodeID DOUBLE, payment_type DOUBLE, "
    "tpep_pickup_datetime STRING, tpep_dropoff_datetime STRING, passenger_count STRING, "
    "trip_distance STRING, fare_amount STRING, tip_amount STRING, total_amount STRING, "
    "mta_tax STRING, PULocationID STRUCT<borough: STRING, zone: STRING, LocationID: INT>, "
    "DOLocationID STRUCT<borough: STRING, zone: STRING, LocationID: INT>"
)

# The same with numbers as numbers, which parse faster; one that is null may be absent, or be no number.
FACT_NUMBERS = FACT
for _name in NUMBERS:
    FACT_NUMBERS = FACT_NUMBERS.replace(f"{_name} STRING", f"{_name} DOUBLE")
# What is looked at again then.
FACT_TEXTS = ", ".join(f"{_name} STRING" for _name in NUMBERS)

# One record of a topic: columns a Kafka source gives. A file-backed topic has no offsets.
ENVELOPE = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# The event table used for the live view.
EVENT = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

# A measurement file as the load and consistency scripts write it.
_SIDE = "total_operations: BIGINT, total_time_seconds: DOUBLE, throughput_ops_per_sec: DOUBLE, " \
        "avg_latency_ms: DOUBLE, p95_latency_ms: DOUBLE, p99_latency_ms: DOUBLE"
SCALING_RESULT = (
    f"results STRUCT<write_test: STRUCT<{_SIDE}>, read_test: STRUCT<{_SIDE}>>, success BOOLEAN"
)
CONSISTENCY_RESULT = (
    "results STRUCT<"
    "write_performance: STRUCT<total_writes: BIGINT, failed_writes: BIGINT, "
    "write_time_seconds: DOUBLE, avg_write_latency_ms: DOUBLE, p95_write_latency_ms: DOUBLE>, "
    "read_performance: STRUCT<avg_read_latency_ms: DOUBLE, read_error: BOOLEAN>, "
    "consistency_check: STRUCT<data_integrity: STRING, found_records: BIGINT, "
    "expected_records: BIGINT, duplicate_records: BIGINT, missing_records: BIGINT>>, "
    "run_id STRING, success BOOLEAN"
)
