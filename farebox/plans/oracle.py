"""The same results as plain SQL over the given tables, one statement per query."""

from __future__ import annotations

from farebox.functions.counts import FAMILIES
from farebox.operators.rollups import ROLLUPS, Rollup

BOROUGH, MONTH, LOCATION, VENDOR = "ASIA", "1998-03", 13, 1
HERE = f"borough = '{BOROUGH}' AND year_month = '{MONTH}'"

ORACLE: dict[str, str] = {}

_SECOND = "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709) % 86400"
_RIDE = "(l_partkey * 31 + l_orderkey * 17) % 3600 - 20"


def r2(x: str, digits: int = 2) -> str:
    """Round half away from zero on the printed value, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


def avg(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / count({x})"


def money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(28,2)) AS DOUBLE)"


_BASE = f"""
zones AS (
  SELECT CAST(n_nationkey + 1 AS INT) AS LocationID, n_name AS zone, r_name AS borough,
         CAST((n_nationkey + 1) * 10 AS DOUBLE) AS Shape_Leng,
         CAST((n_nationkey + 1) * 7 AS DOUBLE) AS Shape_Area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
trips_raw AS (
  SELECT x.*, CAST(fare_amount + extra + mta_tax + tip_amount + tolls_amount AS DECIMAL(14,2)) AS total_amount
  FROM (
    SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                     CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                     CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS trip_id,
      CASE WHEN l_partkey % 101 = 0 THEN 'bad-date'
           ELSE CAST(l_shipdate + to_seconds({_SECOND}) AS VARCHAR) END AS tpep_pickup_datetime,
      CAST(l_shipdate + to_seconds({_SECOND} + {_RIDE}) AS VARCHAR) AS tpep_dropoff_datetime,
      CAST(CASE WHEN (l_orderkey + l_partkey) % 199 = 0 THEN 999 ELSE s_nationkey + 1 END AS INT) AS PULocationID,
      CAST(CASE WHEN (l_orderkey + l_partkey) % 211 = 0 THEN NULL ELSE c_nationkey + 1 END AS INT) AS DOLocationID,
      CAST(1 + l_linenumber % 2 AS INT) AS VendorID,
      CAST(1 + l_suppkey % 6 AS INT) AS RatecodeID,
      CAST(1 + l_partkey % 6 AS INT) AS payment_type,
      CASE WHEN l_partkey % 97 = 0 THEN NULL
           ELSE CAST((l_orderkey + l_linenumber) % 7 AS DOUBLE) END AS passenger_count,
      (l_quantity - 1) / 2.0 AS trip_distance,
      CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 ELSE 1 END
           * CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS fare_amount,
      CAST(CASE WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN -1 ELSE 1 END
           * CAST(l_discount AS DECIMAL(4,2)) * CAST(l_quantity AS DECIMAL(4,0)) AS DECIMAL(12,2)) AS tip_amount,
      CAST(1.0 AS DECIMAL(12,2)) AS extra, CAST(0.5 AS DECIMAL(12,2)) AS mta_tax,
      CAST(l_linenumber AS DECIMAL(12,2)) AS tolls_amount,
      CAST(0.3 AS DECIMAL(12,2)) AS improvement_surcharge,
      CAST(CASE WHEN l_linenumber = 2 THEN 2.5 ELSE 0 END AS DECIMAL(12,2)) AS congestion_surcharge,
      CAST(CASE WHEN l_suppkey % 10 = 0 THEN 1.75 END AS DECIMAL(12,2)) AS Airport_fee,
      CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
      concat('trips_', CAST(year(l_shipdate) AS VARCHAR)) AS stem
    FROM lineitem
    JOIN orders   ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey  = c_custkey
    JOIN supplier ON l_suppkey  = s_suppkey) x),
resolved AS (
  SELECT t.*, p.borough, p.zone AS pickup_zone, p.Shape_Leng AS pickup_shape_leng, p.Shape_Area AS pickup_shape_area,
         d.borough AS dropoff_borough, d.zone AS dropoff_zone, d.Shape_Leng AS dropoff_shape_leng, d.Shape_Area AS dropoff_shape_area,
         TRY_CAST(t.tpep_pickup_datetime AS TIMESTAMP) AS pickup_ts,
         CAST(t.tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_ts
  FROM trips_raw t JOIN zones p ON t.PULocationID = p.LocationID
  JOIN zones d ON t.DOLocationID = d.LocationID),
trips AS (SELECT * FROM resolved WHERE tpep_pickup_datetime <> 'bad-date')"""

_FACTS = """,
facts AS (
  SELECT *, strftime(pickup_ts, '%Y-%m') AS year_month,
         CAST(CAST(pickup_ts AS DATE) AS VARCHAR) AS pickup_date,
         CAST(hour(pickup_ts) AS INT) AS pickup_hour,
         date_diff('second', pickup_ts, dropoff_ts) AS duration,
         PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
         VendorID AS vendor_id, RatecodeID AS rate_code
  FROM trips WHERE passenger_count IS NOT NULL)"""

_DICT = """,
seen AS (
  SELECT borough, (epoch_ms(dropoff_ts) + CAST(abs(total_amount * 100) AS BIGINT) % 5000) * 2 AS place FROM resolved
  UNION ALL SELECT dropoff_borough, (epoch_ms(dropoff_ts) + CAST(abs(total_amount * 100) AS BIGINT) % 5000) * 2 + 1 FROM resolved),
firsts AS (SELECT borough, min(place) AS first FROM seen GROUP BY borough),
dict AS (SELECT borough, CAST(row_number() OVER (ORDER BY first, borough) AS INT) AS borough_id FROM firsts)"""


def _rollup_select(rollup: Rollup, source: str = "facts") -> str:
    counts = [
        f"count(*) FILTER (WHERE {FAMILIES[f][0]} = {code}) AS count_{f}_{name}"
        for f in rollup.families
        for name, code in FAMILIES[f][1].items()
    ]
    sums = [f"{money(f'sum({m})')} AS sum_{m}" for m in rollup.sums]
    averages = [
        f"CAST(trunc(CAST(sum({m}) AS DOUBLE) / count(*)) AS INT) AS avg_{m}"
        if m == "duration"
        else f"CAST(sum({m}) AS DOUBLE) / count(*) AS avg_{m}"
        for m in rollup.averages
    ]
    keys = ", ".join(rollup.keys)
    measures = ", ".join([*sums, *averages, *counts, "count(*) AS trip_count"])
    return f"SELECT {keys}, {measures} FROM {source} GROUP BY {keys}"


_ROLLUPS = _FACTS + "".join(f",\nr_{r.name} AS ({_rollup_select(r)})" for r in ROLLUPS.values())

_MESSAGE_REASON = """CASE WHEN t.DOLocationID IS NULL THEN 'Missing or invalid DOLocationID'
       WHEN p.LocationID IS NULL THEN 'Missing PULocationID.borough'
       WHEN d.LocationID IS NULL THEN 'Missing DOLocationID.zone' END"""
_CHECKED = f""",
checked AS (
  SELECT t.*, {_MESSAGE_REASON} AS reason
  FROM trips_raw t LEFT JOIN zones p ON t.PULocationID = p.LocationID
  LEFT JOIN zones d ON t.DOLocationID = d.LocationID)"""

_ANOMALIES = """,
measured AS (
  SELECT t.*, p.borough, p.zone AS pickup_zone, d.zone AS dropoff_zone,
         date_diff('second', TRY_CAST(tpep_pickup_datetime AS TIMESTAMP),
                   TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP)) / 60.0::DOUBLE AS minutes
  FROM trips_raw t LEFT JOIN zones p ON t.PULocationID = p.LocationID
  LEFT JOIN zones d ON t.DOLocationID = d.LocationID),
speeds AS (
  SELECT *, CASE WHEN trip_distance > 0 AND minutes > 0 THEN trip_distance / (minutes / 60.0::DOUBLE)
            ELSE 0::DOUBLE END AS speed FROM measured),
anomalies AS (
  SELECT *, CASE
      WHEN (trip_distance <= 0 OR trip_distance IS NULL) AND total_amount > 0 THEN 'zero_distance'
      WHEN minutes <= 0 OR minutes IS NULL THEN 'invalid_duration'
      WHEN total_amount <= 0 OR total_amount IS NULL OR fare_amount < 0 OR fare_amount IS NULL THEN 'invalid_amount'
      WHEN speed > 150 THEN 'high_speed' ELSE 'other' END AS label
  FROM speeds
  WHERE (trip_distance <= 0 AND total_amount > 0) OR minutes <= 0 OR minutes IS NULL
     OR total_amount <= 0 OR fare_amount < 0 OR tip_amount < 0 OR speed > 150)"""

_RECENT_AGAIN = """,
again AS (SELECT trip_id, PULocationID FROM trips
          UNION ALL SELECT trip_id, PULocationID FROM trips WHERE payment_type = 2 AND VendorID = 1),
back AS (SELECT * FROM again WHERE PULocationID <> 7)"""

_ARRIVED = """,
sent AS (
  SELECT *, epoch_ms(dropoff_ts) AS stamp,
         epoch_ms(dropoff_ts) + CAST(abs(total_amount * 100) AS BIGINT) % 5000 AS arrived
  FROM resolved)"""

def _put(name: str, select: str, *parts: str) -> None:
    ORACLE[name] = f"WITH {''.join(parts) or _BASE}\n{select}"


def _base(name: str, select: str, *more: str) -> None:
    _put(name, select, _BASE, *more)


def _latency(group: str, source: str, value: str) -> str:
    """Sorted value at place int(n * p), per group."""

    def at(p: str) -> str:
        return f"max(v) FILTER (WHERE rn = least(CAST(floor(n * {p}::DOUBLE) AS BIGINT), n - 1))"

    return (
        f"SELECT {group}, count(*) AS samples, "
        f"{r2('CAST(sum(CAST(v AS DECIMAL(28,6))) AS DOUBLE) / count(*)')} AS avg_latency_ms, "
        f"{r2('max(v)')} AS max_latency_ms, {r2(at('0.95'))} AS p95_latency_ms, "
        f"{r2(at('0.99'))} AS p99_latency_ms FROM (SELECT {group}, {value} AS v, "
        f"row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS rn, "
        f"count(*) OVER (PARTITION BY {group}) AS n FROM {source}) GROUP BY {group}"
    )


# ---- sources ---------------------------------------------------------------------------------

_base(
    "scan_trips",
    """SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
  RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type,
  CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra,
  CAST(mta_tax AS DOUBLE) AS mta_tax, CAST(tip_amount AS DOUBLE) AS tip_amount,
  CAST(tolls_amount AS DOUBLE) AS tolls_amount,
  CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
  CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge, CAST(Airport_fee AS DOUBLE) AS Airport_fee,
  CAST(total_amount AS DOUBLE) AS total_amount
FROM trips_raw""",
)
ORACLE["zone_dim"] = """WITH source AS (
  SELECT CAST(s_suppkey AS INT) AS seq, s_name AS zone, r_name AS borough,
         CASE WHEN s_suppkey % 5 = 0 THEN 0 WHEN s_suppkey % 5 = 1 THEN s_suppkey + 1 ELSE s_suppkey END AS a,
         CASE WHEN s_suppkey % 15 = 0 THEN 0 ELSE s_suppkey END AS b
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
keyed AS (SELECT *, CAST(coalesce(nullif(a, 0), nullif(b, 0)) AS INT) AS location_id FROM source)
SELECT location_id, zone, borough FROM keyed WHERE location_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY seq DESC) = 1"""
_base(
    "scan_json_files",
    """SELECT trip_id, VendorID AS vendor_id, PULocationID AS pickup_location_id, zone AS pickup_zone,
  DOLocationID AS dropoff_location_id, passenger_count, CAST(total_amount AS DOUBLE) AS total_amount
FROM trips_raw LEFT JOIN zones ON PULocationID = LocationID""",
)
_base(
    "ingest_stats_by_file",
    f"""SELECT coalesce(stem, 'ALL') AS source_file, CAST(sum(n) AS BIGINT) AS total_records,
  CAST(sum(sent) AS BIGINT) AS sent_records, CAST(sum(n - sent) AS BIGINT) AS skipped_records,
  CAST(sum(processed) AS BIGINT) AS files_processed,
  {r2('CASE WHEN sum(n) > 0 THEN CAST(sum(sent) AS DOUBLE) * 100 / sum(n) END')} AS success_rate
FROM (SELECT stem, count(*) AS n, count(*) FILTER (WHERE reason IS NULL) AS sent, 1 AS processed
      FROM checked GROUP BY stem UNION ALL SELECT 'trips_broken', 0, 0, 0)
GROUP BY ROLLUP (stem)""",
    _CHECKED,
)
_base(
    "decode_envelope",
    """SELECT borough AS key, trip_id, VendorID AS vendor_id, payment_type, passenger_count,
  CAST(total_amount AS DOUBLE) AS total_amount, PULocationID AS pickup_location_id, borough,
  dropoff_zone, epoch_ms(dropoff_ts) AS producer_timestamp FROM resolved""",
)

_DOCUMENTS = f"""SELECT trip_id, tpep_pickup_datetime AS pickup_datetime, PULocationID AS pickup_location_id,
  pickup_shape_leng, pickup_shape_area, t.borough AS pickup_borough, pickup_zone, p.borough_id AS pickup_borough_id,
  tpep_dropoff_datetime AS dropoff_datetime, DOLocationID AS dropoff_location_id, dropoff_shape_leng, dropoff_shape_area,
  dropoff_borough, dropoff_zone, d.borough_id AS dropoff_borough_id, passenger_count, payment_type,
  CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra,
  CAST(mta_tax AS DOUBLE) AS mta_tax, CAST(tip_amount AS DOUBLE) AS tip_amount,
  CAST(tolls_amount AS DOUBLE) AS tolls_amount, CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
  CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge, CAST(Airport_fee AS DOUBLE) AS airport_fee,
  {{metrics}}, VendorID AS vendor_id, RatecodeID AS ratecode_id, store_and_fwd_flag, 'kafka' AS source
FROM {{source}} t LEFT JOIN dict p ON t.borough = p.borough LEFT JOIN dict d ON dropoff_borough = d.borough"""
_HOURS = (
    "(date_diff('second', TRY_CAST(tpep_pickup_datetime AS TIMESTAMP), "
    "CAST(tpep_dropoff_datetime AS TIMESTAMP)) / 3600.0::DOUBLE)"
)
_METRICS = f"""trip_distance AS distance_km, {r2(_HOURS)} AS duration_h,
  {r2(f'CASE WHEN trip_distance <> 0 AND {_HOURS} <> 0 THEN trip_distance / {_HOURS} END')} AS speed_kmh,
  {r2('CASE WHEN trip_distance > 0 THEN CAST(fare_amount AS DOUBLE) / trip_distance WHEN trip_distance < 0 THEN 0::DOUBLE END')} AS price_per_km"""
_DOCUMENTS = _DOCUMENTS.replace("{metrics}", _METRICS)
_base("trip_documents", _DOCUMENTS.replace("{source}", "resolved"), _DICT)
_base("stream_documents", _DOCUMENTS.replace("{source}", "resolved"), _DICT)
_base(
    "list_trips", _DOCUMENTS.replace("{source}", "resolved") + " ORDER BY trip_id LIMIT 50", _DICT
)
_base("trip_metrics", f"SELECT trip_id, {_METRICS} FROM trips_raw")

# ---- rollup reads ----------------------------------------------------------------------------

_base(
    "rollup_borough_time_lookup",
    f"""SELECT borough, year_month, pickup_date, pickup_hour, sum_passenger_count, sum_fare_amount,
  sum_total_amount, sum_mta_tax, sum_tip_amount, count_vendor_cmt, count_vendor_verifone
FROM r_borough_time WHERE {HERE}""",
    _ROLLUPS,
)
_base(
    "rollup_date_range_scan",
    f"""SELECT * FROM r_borough_time WHERE {HERE} AND pickup_date BETWEEN '{MONTH}-01' AND '{MONTH}-07'""",
    _ROLLUPS,
)
_base(
    "rollup_point_read",
    f"SELECT * FROM r_borough_time WHERE {HERE} ORDER BY pickup_date, pickup_hour LIMIT 1",
    _ROLLUPS,
)
_base(
    "mv_revenue_by_borough",
    f"""SELECT borough, sum_total_amount, year_month, pickup_date, pickup_hour FROM r_borough_time
WHERE borough = '{BOROUGH}'
ORDER BY sum_total_amount DESC, year_month, pickup_date, pickup_hour LIMIT 100""",
    _ROLLUPS,
)
_base(
    "mv_trips_by_time",
    """SELECT year_month, pickup_date, pickup_hour, borough, sum_total_amount, sum_passenger_count
FROM r_borough_time""",
    _ROLLUPS,
)
_base(
    "rollup_table_counts",
    'SELECT coalesce("table", \'ALL\') AS "table", CAST(sum(n) AS BIGINT) AS row_count, count(*) AS tables FROM ('
    + " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS n FROM r_{n}" for n in ROLLUPS)
    + ') GROUP BY ROLLUP ("table")',
    _ROLLUPS,
)
_base(
    "top_zones_revenue",
    f"""SELECT pickup_zone, {money('sum(CAST(sum_total_amount AS DECIMAL(28,2)))')} AS total_revenue,
  round(sum(sum_passenger_count), 0) AS total_passengers FROM r_pickup_zone WHERE {HERE}
GROUP BY pickup_zone ORDER BY total_revenue DESC, pickup_zone LIMIT 20""",
    _ROLLUPS,
)
_base(
    "hourly_performance",
    f"""SELECT CAST(h AS INT) AS pickup_hour,
  coalesce({money('sum(CAST(sum_total_amount AS DECIMAL(28,2)))')}, 0) AS total_revenue,
  coalesce(round(sum(sum_passenger_count), 0), 0) AS total_passengers
FROM range(24) hours(h) LEFT JOIN (SELECT * FROM r_borough_time WHERE {HERE}) ON h = pickup_hour GROUP BY h""",
    _ROLLUPS,
)
_base(
    "route_stats",
    f"""SELECT pickup_location_id, pickup_zone, dropoff_location_id, dropoff_zone, year_month, pickup_date,
  avg_trip_distance, avg_duration, avg_fare_amount, avg_tip_amount, avg_passenger_count
FROM r_route WHERE pickup_location_id = {LOCATION} AND year_month = '{MONTH}'""",
    _ROLLUPS,
)
_VENDOR_ROWS = f"""SELECT vendor_id, borough, year_month, pickup_date, pickup_location_id,
  sum_passenger_count, avg_trip_distance, sum_total_amount, sum_tip_amount, trip_count
FROM r_vendor WHERE vendor_id = {VENDOR} AND {HERE}"""
_base("vendor_performance", _VENDOR_ROWS, _ROLLUPS)
_REVENUE = "CAST(sum(CAST(sum_total_amount AS DECIMAL(28,2))) AS DOUBLE)"
_base(
    "vendor_summary",
    f"""SELECT {r2(f'coalesce({_REVENUE}, 0)')} AS total_revenue, count(*) AS rollup_rows,
  CAST(coalesce(sum(trip_count), 0) AS BIGINT) AS trips,
  {r2(f'CASE WHEN count(*) > 0 THEN {_REVENUE} / count(*) ELSE 0 END')} AS avg_revenue_per_row
FROM ({_VENDOR_ROWS})""",
    _ROLLUPS,
)
_PAY = ["card", "cash", "free", "dispute", "unknown", "voided"]
_base(
    "payment_types",
    "SELECT payment_type, n AS count, "
    + r2("CASE WHEN sum(n) OVER () > 0 THEN CAST(n AS DOUBLE) / sum(n) OVER () * 100 ELSE 0 END")
    + " AS percentage FROM ("
    + " UNION ALL ".join(
        f"SELECT '{p}' AS payment_type, CAST(coalesce(sum(count_payment_{p}), 0) AS BIGINT) AS n "
        f"FROM r_borough_time WHERE {HERE}"
        for p in _PAY
    )
    + ")",
    _ROLLUPS,
)
_base(
    "partition_revenue_total",
    f"SELECT {_REVENUE} AS total_revenue FROM r_borough_time WHERE {HERE}",
    _ROLLUPS,
)
_base(
    "partition_revenue_by_hour",
    f"SELECT pickup_hour, {_REVENUE} AS total_revenue FROM r_borough_time WHERE {HERE} GROUP BY pickup_hour",
    _ROLLUPS,
)
_base(
    "revenue_by_borough_month",
    f"""SELECT borough, year_month, {_REVENUE} AS total_revenue FROM r_borough_time
WHERE year_month = '{MONTH}' GROUP BY borough, year_month""",
    _ROLLUPS,
)
_base(
    "distinct_pickup_locations",
    f"""SELECT DISTINCT pickup_location_id FROM r_route WHERE year_month = '{MONTH}'""",
    _ROLLUPS,
)
_SAMPLE = f"""SELECT * FROM r_route WHERE year_month = '{MONTH}'
  QUALIFY row_number() OVER (PARTITION BY pickup_location_id ORDER BY dropoff_location_id, pickup_date DESC) <= 50"""
_base("route_sample_per_location", _SAMPLE, _ROLLUPS)
_base(
    "zone_route_join",
    f"""SELECT r.pickup_zone, r.year_month, r.dropoff_zone, r.pickup_date, zone_revenue, zone_trips,
  avg_fare_amount, trip_count
FROM r_route r JOIN (
  SELECT pickup_zone, year_month, {_REVENUE} AS zone_revenue, CAST(sum(trip_count) AS BIGINT) AS zone_trips
  FROM r_pickup_zone WHERE {HERE} GROUP BY pickup_zone, year_month) z
ON r.pickup_zone = z.pickup_zone AND r.year_month = z.year_month""",
    _ROLLUPS,
)
_base(
    "delete_partition",
    f"""SELECT borough, year_month, count(*) AS row_count FROM r_borough_time WHERE NOT ({HERE})
GROUP BY borough, year_month""",
    _ROLLUPS,
)

_HOUR_KEYS = "borough, year_month, pickup_date, pickup_hour"
_base(
    "rollup_upsert",
    f"""SELECT {_HOUR_KEYS}, coalesce(c.revenue, f.sum_total_amount) AS sum_total_amount,
  coalesce(c.trips, f.count_payment_card) AS count_payment_card,
  CASE WHEN c.trips IS NULL THEN f.count_payment_cash ELSE 0 END AS count_payment_cash,
  coalesce(c.trips, f.trip_count) AS trip_count
FROM r_borough_time f LEFT JOIN (
  SELECT {_HOUR_KEYS}, {money('sum(total_amount)')} AS revenue, count(*) AS trips
  FROM facts WHERE payment_type = 1 GROUP BY {_HOUR_KEYS}) c USING ({_HOUR_KEYS})""",
    _ROLLUPS,
)

for _name, _r in ROLLUPS.items():
    _base(f"rollup_{_name}", f"SELECT * FROM r_{_name}", _ROLLUPS)
    _base(f"stream_rollup_{_name}", f"SELECT * FROM r_{_name}", _ROLLUPS)

_base(
    "aggregate_rejects",
    """SELECT reason, count(*) AS rejected FROM (
  SELECT CASE WHEN pickup_ts IS NULL THEN 'bad tpep_pickup_datetime'
              WHEN passenger_count IS NULL THEN 'null passenger_count' END AS reason FROM resolved)
WHERE reason IS NOT NULL GROUP BY reason""",
)

# ---- rollup anomalies ------------------------------------------------------------------------

_KPH = "(avg_trip_distance / avg_duration * 3600.0::DOUBLE)"
_SPEED = f"CASE WHEN avg_duration > 0 THEN {_KPH} ELSE 0::DOUBLE END"


def _detectors(borough_time: str, pickup_zone: str, route: str) -> str:
    at = "pickup_date || ' ' || lpad(CAST(pickup_hour AS VARCHAR), 2, '0') || ':00:00'"
    key_hour = "lpad(CAST(pickup_hour AS VARCHAR), 2, '0')"
    return f"""
SELECT 1 AS source_order, 'trips_by_borough_time' AS source,
  borough || '|' || pickup_date || '|' || {key_hour} AS row_key,
  borough || ' (Hour ' || CAST(pickup_hour AS VARCHAR) || ')' AS pickup_zone, 'Unknown' AS dropoff_zone,
  borough, {at} AS pickup_datetime, 0::DOUBLE AS distance_km, 0::DOUBLE AS distance_miles,
  0::DOUBLE AS duration_minutes, sum_total_amount AS total_amount, sum_fare_amount AS fare_amount,
  sum_tip_amount AS tip_amount, 0::DOUBLE AS speed_kmh, 0::DOUBLE AS speed_mph,
  'invalid_amount' AS anomaly_type
FROM {borough_time} WHERE sum_total_amount <= 0 OR sum_fare_amount < 0 OR sum_tip_amount < 0
UNION ALL
SELECT 2, 'trips_by_pickup_zone', borough || '|' || pickup_date || '|' || {key_hour} || '|' || pickup_zone,
  pickup_zone, 'Unknown', borough, {at}, 0, 0, 0, sum_total_amount, sum_fare_amount, 0, 0, 0, 'zero_distance'
FROM {pickup_zone} WHERE avg_trip_distance = 0 AND sum_total_amount > 0
UNION ALL
SELECT 3, 'trips_by_route', lpad(CAST(pickup_location_id AS VARCHAR), 10, '0') || '|'
    || lpad(CAST(dropoff_location_id AS VARCHAR), 10, '0') || '|'
    || lpad(CAST(date_diff('day', CAST(pickup_date AS DATE), DATE '9999-12-31') AS VARCHAR), 10, '0'),
  pickup_zone, dropoff_zone, 'Unknown', pickup_date, {r2("avg_trip_distance * 1.60934::DOUBLE")},
  {r2("avg_trip_distance")}, {r2("avg_duration / 60.0::DOUBLE")}, {r2("avg_fare_amount")},
  {r2("avg_fare_amount")}, 0, {r2(f"({_SPEED}) * 1.60934::DOUBLE")}, {r2(_SPEED)},
  CASE WHEN avg_duration <= 0 THEN 'invalid_duration' ELSE 'high_speed' END
FROM {route} WHERE avg_trip_distance > 0 AND (avg_duration <= 0 OR {_KPH} > 90)"""


_SHOWN = """source_order, source, pickup_zone, dropoff_zone, borough, pickup_datetime, distance_km,
  distance_miles, duration_minutes, total_amount, fare_amount, tip_amount, speed_kmh, speed_mph, anomaly_type"""
_base(
    "anomaly_rollups",
    f"""SELECT {_SHOWN} FROM ({_detectors(
        f'(SELECT * FROM r_borough_time WHERE {HERE})',
        f'(SELECT * FROM r_pickup_zone WHERE {HERE})',
        f"(SELECT * FROM r_route WHERE year_month = '{MONTH}')")})""",
    _ROLLUPS,
)
_base(
    "anomaly_rollups_all",
    f"SELECT {_SHOWN} FROM ({_detectors('r_borough_time', 'r_pickup_zone', 'r_route')})",
    _ROLLUPS,
)

# ---- sinks -----------------------------------------------------------------------------------

_base(
    "write_json_chunks",
    "SELECT count(*) AS total_records, CAST(0 AS BIGINT) AS files_over_limit FROM trips_raw",
)
_base(
    "encode_envelope",
    """SELECT borough AS key, trip_id, pickup_zone, DOLocationID AS dropoff_location_id,
  tpep_pickup_datetime AS pickup_datetime, CAST(total_amount AS DOUBLE) AS total_amount,
  true AS has_passenger_count FROM resolved""",
)

# ---- validation ------------------------------------------------------------------------------

_base("validate_records", "SELECT trip_id, reason IS NULL AS is_valid, reason FROM checked", _CHECKED)
_base(
    "reject_reasons",
    "SELECT reason, count(*) AS rejected FROM checked WHERE reason IS NOT NULL GROUP BY reason",
    _CHECKED,
)
_base(
    "stamp_records",
    """SELECT trip_id AS source_id, md5(trip_id) AS trip_id,
  epoch_ms(CAST(tpep_dropoff_datetime AS TIMESTAMP)) AS producer_timestamp FROM trips_raw""",
)
_base(
    "enrich_zones",
    """SELECT trip_id, PULocationID AS pickup_location_id, p.borough AS pickup_borough, p.zone AS pickup_zone,
  p.Shape_Leng AS pickup_shape_leng, DOLocationID AS dropoff_location_id, d.borough AS dropoff_borough,
  CASE WHEN d.LocationID IS NOT NULL THEN 'Polygon' END AS dropoff_geometry_type,
  DOLocationID IS NULL AS dropoff_is_null
FROM trips_raw LEFT JOIN zones p ON PULocationID = p.LocationID LEFT JOIN zones d ON DOLocationID = d.LocationID""",
)
_base(
    "unresolved_zones",
    """SELECT trip_id, side, location_id FROM (
  SELECT trip_id, 'pickup' AS side, PULocationID AS location_id FROM trips_raw
  UNION ALL SELECT trip_id, 'dropoff', DOLocationID FROM trips_raw)
WHERE location_id IS NOT NULL AND location_id NOT IN (SELECT LocationID FROM zones)""",
)

# ---- trip anomalies --------------------------------------------------------------------------

_base(
    "anomaly_trips",
    """SELECT trip_id, pickup_zone, dropoff_zone, borough, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, trip_distance AS distance_km,
  trip_distance * 0.621371::DOUBLE AS distance_miles, minutes AS duration_minutes,
  CAST(total_amount AS DOUBLE) AS total_amount, CAST(fare_amount AS DOUBLE) AS fare_amount,
  CAST(tip_amount AS DOUBLE) AS tip_amount, speed AS speed_kmh, speed * 0.621371::DOUBLE AS speed_mph,
  passenger_count, label AS anomaly_type FROM anomalies""",
    _ANOMALIES,
)
_base(
    "anomaly_counts",
    """SELECT anomaly_type, count(label) AS n
FROM (VALUES ('zero_distance'), ('invalid_duration'), ('invalid_amount'), ('high_speed'), ('other')) v(anomaly_type)
LEFT JOIN anomalies ON label = anomaly_type GROUP BY anomaly_type""",
    _ANOMALIES,
)
_base(
    "anomaly_labels_simple",
    """SELECT v.label, count(a.label) AS n
FROM (VALUES ('Zero distance'), ('Invalid duration'), ('Invalid amount'), ('High speed')) v(label)
LEFT JOIN (SELECT CASE WHEN trip_distance = 0 THEN 'Zero distance' WHEN minutes < 0 THEN 'Invalid duration'
             WHEN total_amount < 0 THEN 'Invalid amount' ELSE 'High speed' END AS label FROM anomalies) a
ON a.label = v.label GROUP BY v.label""",
    _ANOMALIES,
)

# ---- dictionary and reconciliation -----------------------------------------------------------

_base("borough_dictionary", "SELECT borough, borough_id FROM dict", _DICT)
_base("stream_borough_dictionary", "SELECT borough, borough_id FROM dict", _DICT)
_base(
    "borough_ids",
    """SELECT trip_id, p.borough_id AS pickup_borough_id, d.borough_id AS dropoff_borough_id
FROM resolved t JOIN dict p ON t.borough = p.borough JOIN dict d ON t.dropoff_borough = d.borough""",
    _DICT,
)
_base(
    "borough_distribution",
    """SELECT coalesce(CAST(borough_id AS VARCHAR), 'Unknown') AS borough_id, count(*) AS count
FROM trips_raw LEFT JOIN zones ON PULocationID = LocationID LEFT JOIN dict ON zones.borough = dict.borough GROUP BY 1""",
    _DICT,
)
for _name in ("reconcile_writes", "key_difference"):
    _base(
        _name,
        "SELECT DISTINCT trip_id FROM again WHERE trip_id NOT IN (SELECT trip_id FROM back)",
        _RECENT_AGAIN,
    )
_base(
    "duplicate_keys",
    "SELECT trip_id, count(*) AS copies FROM back GROUP BY trip_id HAVING count(*) > 1",
    _RECENT_AGAIN,
)
_base(
    "integrity_verdict",
    """SELECT expected_records, found_records, duplicate_records, missing_records,
  CASE WHEN duplicate_records = 0 AND missing_records = 0 THEN 'true' ELSE 'false' END AS data_integrity,
  CASE WHEN duplicate_records = 0 AND found_records >= expected_records - 5 THEN 'OK' ELSE 'ISSUES' END AS rollup_integrity
FROM (SELECT (SELECT count(DISTINCT trip_id) FROM again) AS expected_records,
             (SELECT count(*) FROM back) AS found_records,
             (SELECT count(*) - count(DISTINCT trip_id) FROM back) AS duplicate_records,
             (SELECT count(DISTINCT trip_id) FROM again WHERE trip_id NOT IN (SELECT trip_id FROM back)) AS missing_records)""",
    _RECENT_AGAIN,
)
_base(
    "stream_dedup",
    "SELECT trip_id, VendorID AS vendor_id, CAST(total_amount AS DOUBLE) AS total_amount FROM resolved",
)

# ---- trip analyses ---------------------------------------------------------------------------

_base(
    "top_zones_by_revenue",
    f"""SELECT borough, {money('sum(total_amount)')} AS total_revenue, count(*) AS total_trips,
  {avg('fare_amount')} AS avg_fare FROM trips GROUP BY borough ORDER BY total_revenue DESC, borough LIMIT 10""",
)
_base(
    "top_zones_by_trips",
    f"""SELECT borough, count(*) AS total_trips, {money('sum(total_amount)')} AS total_revenue,
  {avg('passenger_count')} AS avg_passengers FROM trips GROUP BY borough ORDER BY total_trips DESC, borough LIMIT 10""",
)
_base(
    "passenger_distribution",
    f"""SELECT passenger_count, count(*) AS count, {avg('fare_amount')} AS avg_fare,
  {avg('trip_distance')} AS avg_distance FROM trips GROUP BY passenger_count""",
)
_base(
    "hourly_stats",
    f"""SELECT CAST(hour(pickup_ts) AS INT) AS hour, count(*) AS total_trips,
  {money('sum(total_amount)')} AS total_revenue, {avg('fare_amount')} AS avg_fare,
  {avg('trip_distance')} AS avg_distance FROM trips GROUP BY 1""",
)
_base("borough_counts", "SELECT borough, count(*) AS count FROM trips GROUP BY borough")
_base(
    "top_boroughs_share",
    f"""SELECT borough, trips, {r2('CAST(trips AS DOUBLE) / sum(trips) OVER () * 100')} AS percentage
FROM (SELECT borough, count(*) AS trips FROM trips GROUP BY borough) ORDER BY trips DESC, borough LIMIT 10""",
)

# ---- skew ------------------------------------------------------------------------------------

_HASH = "CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT) % {n}"
_DATE = "CAST(CAST(pickup_ts AS DATE) AS VARCHAR)"
_KEYS = {
    "borough_hour": "borough || '_' || CAST(hour(pickup_ts) AS VARCHAR)",
    "time_bucket": f"{_DATE} || '-' || lpad(CAST(hour(pickup_ts) // 6 AS VARCHAR), 2, '0')",
    "unique_id": "md5(trip_id)",
    "hash": "CAST(" + _HASH.format(x=f"borough || {_DATE}", n=100) + " AS VARCHAR)",
}
for _name, _key in _KEYS.items():
    _mean = "(CAST(sum(n) AS DOUBLE) / count(*))"
    _std = "coalesce(stddev_samp(n), 0::DOUBLE)"
    _base(
        f"skew_{_name}",
        f"""SELECT count(*) AS num_partitions, {r2(_mean)} AS avg_records_per_partition,
  max(n) AS max_records_in_partition, min(n) AS min_records_in_partition,
  {r2(_std)} AS std_deviation, {r2(f'{_std} / {_mean} * 100')} AS coefficient_of_variation_percent,
  {r2(f'100.0::DOUBLE - {_std} / {_mean} * 100')} AS balance_score
FROM (SELECT {_key} AS k, count(*) AS n FROM trips GROUP BY 1)""",
    )
_base(
    "hottest_partitions",
    f"""SELECT {_KEYS['borough_hour']} AS partition_key, count(*) AS n FROM trips GROUP BY 1
ORDER BY n DESC, partition_key LIMIT 10""",
)
_BUCKETS = f""",
buckets AS (
  SELECT b AS bucket, count(trip_id) AS documents, CAST(coalesce(sum(size), 0) AS BIGINT) AS data_size_bytes
  FROM range(6) r(b) LEFT JOIN (
    SELECT trip_id, {_HASH.format(x='borough', n=6)} AS bucket,
      strlen(concat_ws('|', trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, borough, pickup_zone)) AS size
    FROM trips) t ON t.bucket = b GROUP BY b)"""
_PERCENT = r2("CAST(documents AS DOUBLE) / sum(documents) OVER () * 100")
_base(
    "skew_report",
    f"""SELECT bucket, documents, percentage, data_size_bytes,
  {r2('data_size_bytes / (1024.0::DOUBLE * 1024.0::DOUBLE)')} AS data_size_mb,
  {r2('CASE WHEN documents > 0 THEN CAST(data_size_bytes AS DOUBLE) / documents ELSE 0 END / 1024.0::DOUBLE')} AS avg_obj_size_kb,
  CASE WHEN percentage > 40 THEN 'high' WHEN percentage < 25 THEN 'low' ELSE 'normal' END AS band
FROM (SELECT *, {_PERCENT} AS percentage FROM buckets)""",
    _BUCKETS,
)
_base(
    "skew_balance_score",
    f"""SELECT CAST(sum(documents) AS BIGINT) AS total_documents, CAST(6 AS BIGINT) AS total_buckets,
  {r2('''100.0::DOUBLE - greatest(max(documents) - sum(documents) / 6.0::DOUBLE,
      sum(documents) / 6.0::DOUBLE - min(documents)) / (sum(documents) / 6.0::DOUBLE) * 100''')} AS balance_score
FROM buckets""",
    _BUCKETS,
)

# ---- measurements ----------------------------------------------------------------------------

ORACLE["latency_summary"] = _latency("event_type", "events", "value")
ORACLE["timing_extremes"] = f"""WITH t AS (
  SELECT 'event_' || CAST(event_id AS VARCHAR) AS name, CASE WHEN event_id % 50 = 0 THEN 0 ELSE value END AS ms FROM events)
SELECT count(*) AS events,
  {r2('(SELECT CAST(sum(CAST(ms AS DECIMAL(28,6))) AS DOUBLE) / count(*) FROM t WHERE ms > 0)')} AS avg_value_above_zero,
  (SELECT name FROM t ORDER BY ms, name LIMIT 1) AS least_event,
  (SELECT name FROM t ORDER BY ms DESC, name LIMIT 1) AS greatest_event
FROM t"""
_FIRST = """SELECT 'user_' || CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS q,
  arg_min(value, event_id) AS ms FROM events WHERE event_type = '{kind}' GROUP BY 1"""
ORACLE["compare_results"] = f"""WITH a AS ({_FIRST.format(kind='click')}), b AS ({_FIRST.format(kind='purchase')})
SELECT 'U' || substr(coalesce(a.q, b.q), 2) AS user_day, coalesce(a.ms, 0) AS first_click, coalesce(b.ms, 0) AS first_purchase
FROM a FULL OUTER JOIN b ON a.q = b.q"""

# ---- windows ---------------------------------------------------------------------------------

ORACLE["last_n_trips"] = "SELECT event_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 15"
ORACLE["rolling_latency"] = f"""SELECT event_id,
  {r2('CAST(sum(v) OVER w AS DOUBLE) / count(*) OVER w')} AS avg_value, CAST(max(v) OVER w AS DOUBLE) AS max_value
FROM (SELECT event_id, CAST(value AS DECIMAL(18,2)) AS v FROM events)
WINDOW w AS (ORDER BY event_id ROWS BETWEEN 4999 PRECEDING AND CURRENT ROW)"""
ORACLE["trips_per_minute"] = """SELECT second, CAST(sum(n) OVER (
  ORDER BY second RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS BIGINT) AS trips_per_minute
FROM (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS second, count(*) AS n FROM events GROUP BY 1)"""
ORACLE["running_totals"] = """SELECT event_id, count(*) OVER w AS total_trips,
  CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total_revenue
FROM events WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)"""

# ---- scalar functions ------------------------------------------------------------------------

_base(
    "scalar_dates",
    f"""SELECT trip_id, strftime(pickup_ts, '%Y-%m') AS year_month, {_DATE} AS pickup_date,
  CAST(hour(pickup_ts) AS INT) AS pickup_hour, date_diff('second', pickup_ts, dropoff_ts) AS duration_seconds,
  date_diff('second', pickup_ts, dropoff_ts) / 60.0::DOUBLE AS duration_minutes,
  CAST(CAST(pickup_ts AS DATE) + payment_type AS VARCHAR) AS plus_days, {_KEYS['time_bucket']} AS time_bucket,
  strftime(pickup_ts, '%Y-%m-%d %H:%M:%S') AS as_text FROM trips""",
)
_base(
    "scalar_strings",
    f"""SELECT trip_id, lower(pickup_zone) AS lower_zone,
  upper(substr(pickup_zone, 1, 1)) || lower(substr(pickup_zone, 2)) AS label,
  CASE WHEN payment_type <> 1 THEN trip_distance END AS percent, substr(md5(trip_id), 1, 8) AS short_id,
  {_HASH.format(x=f"borough || {_DATE}", n=100)} AS hash_bucket FROM trips""",
)
_base(
    "scalar_math",
    f"""SELECT trip_id, trip_distance * 0.621371::DOUBLE AS miles, trip_distance * 1.60934::DOUBLE AS km,
  CAST({r2('trip_distance * 10 / 60.0::DOUBLE', 0)} AS BIGINT) AS per_second, {r2('trip_distance / 8')} AS rounded,
  CAST(trunc(trip_distance) AS INT) AS truncated,
  CASE WHEN size = 0 THEN '0 Bytes' ELSE
    regexp_replace(CAST({r2('size / pow(1024.0::DOUBLE, power)')} AS VARCHAR), '\\.0$', '') || ' '
    || CASE power WHEN 0 THEN 'Bytes' WHEN 1 THEN 'KB' WHEN 2 THEN 'MB' WHEN 3 THEN 'GB' ELSE 'TB' END END AS size_text
FROM (SELECT *, CASE WHEN size < 1024 THEN 0 WHEN size < pow(1024, 2) THEN 1 WHEN size < pow(1024, 3) THEN 2
                WHEN size < pow(1024, 4) THEN 3 ELSE 4 END AS power
      FROM (SELECT *, VendorID * pow(1024.0::DOUBLE, payment_type - 1) * trip_distance AS size FROM trips))""",
)

# ---- streams ---------------------------------------------------------------------------------

_base(
    "stream_ingest_metrics",
    """SELECT (SELECT count(*) FROM resolved) AS received, (SELECT count(*) FROM facts) AS processed,
  (SELECT count(*) FROM resolved) - (SELECT count(*) FROM facts) AS rejected, """
    + " + ".join(f"(SELECT count(*) FROM r_{n})" for n in ROLLUPS)
    + " AS rows_stored",
    _ROLLUPS,
)
_base(
    "stream_live_stats",
    f"""SELECT count(*) AS total_trips, {money('sum(total_amount)')} AS total_revenue,
  count(*) FILTER (WHERE passenger_count IS NULL) AS errors,
  strftime(make_timestamp(max(arrived) * 1000), '%Y-%m-%d %H:%M:%S') AS last_trip_time FROM sent WHERE payment_type <> 2""",
    _ARRIVED,
)
ORACLE["stream_live_timed"] = ORACLE["stream_live_stats"]
_base(
    "stream_latency",
    f"""SELECT count(*) AS messages, {r2('CAST(sum(arrived - stamp) AS DOUBLE) / count(*)')} AS all_avg_latency_ms,
  max(arrived - stamp) AS all_max_latency_ms, {r2('''CAST(sum(arrived - stamp) FILTER (WHERE place <= 5000) AS DOUBLE)
    / count(*) FILTER (WHERE place <= 5000)''')} AS avg_latency_ms,
  max(arrived - stamp) FILTER (WHERE place <= 5000) AS max_latency_ms
FROM (SELECT *, row_number() OVER (ORDER BY arrived DESC, trip_id DESC) AS place FROM sent WHERE payment_type <> 2)""",
    _ARRIVED,
)
_base(
    "stream_recent_trips",
    """SELECT strftime(make_timestamp(arrived * 1000), '%H:%M:%S') AS shown_at, trip_id, pickup_zone, dropoff_zone,
  borough, CAST(total_amount AS DOUBLE) AS amount, trip_distance AS distance, CAST(passenger_count AS INT) AS passengers
FROM sent WHERE payment_type <> 2 ORDER BY arrived DESC, trip_id DESC LIMIT 15""",
    _ARRIVED,
)
ORACLE["stream_hourly_window"] = """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
  count(*) AS trips, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM events GROUP BY 1, 2"""
ORACLE["stream_trips_per_minute"] = """SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(make_timestamp((s + 60) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS trips
FROM (SELECT unnest([10 * (CAST(floor(epoch(ts)) AS BIGINT) // 10) - 10 * k for k in range(6)]) AS s FROM events)
GROUP BY s"""
