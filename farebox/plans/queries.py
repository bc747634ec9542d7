"""Every operator as a named query over an input folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions import scalars as fn
from farebox.operators import anomalies, documents, enrich, quality, rollups, windows
from farebox.operators.rollups import ROLLUPS
from farebox.plans import analytics
from farebox.plans.workspace import TRIP_FIELDS, Workspace
from farebox.schemas import CARD_LABELS
from farebox.sinks import files
from farebox.sources import tables, testbed, topic, zones
from farebox.streaming import served

BOROUGH, MONTH, LOCATION, VENDOR = "ASIA", "1998-03", 13, 1

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    """Register under the function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Workspace(spark, sf_dir))
    return build


def _text_dates(df: DataFrame) -> DataFrame:
    """Dates as text, the way the analyses hand them out."""
    return df.select(
        *[F.col(c).cast("string").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes]
    )


# ---- sources ---------------------------------------------------------------------------------


@query
def scan_trips(ws: Workspace) -> DataFrame:
    def write(path: str) -> None:
        trips = ws.trips_raw().select(*TRIP_FIELDS)
        amounts = {c: F.col(c).cast("double") for c, t in trips.dtypes if t.startswith("decimal")}
        trips.withColumns(amounts).write.mode("overwrite").parquet(path)

    return tables.scan_trips(ws.spark, ws.once("trip_files", write)).select(*TRIP_FIELDS)


@query
def zone_dim(ws: Workspace) -> DataFrame:
    return zones.zone_dim(testbed.zone_source(ws.spark, ws.sf_dir), "seq").select(
        F.col("zone_key").alias("location_id"), "zone", "borough"
    )


def _record_files(ws: Workspace) -> str:
    """Enriched trips as JSON array files, one stem per year, plus one file that is cut off."""

    def write(path: str) -> None:
        trips = files.dealt(ws.trips_raw(), "stem", near=("PULocationID", "DOLocationID"))
        records = enrich.to_messages(trips, ws.zones(), ["trip_id", "stem", "slot", "at"])
        files.write_json_arrays(records.drop("key", "reason", "trip_id"), path, "stem", compression="gzip")
        broken = ws.records().limit(1).select(
            F.lit("trips_broken").alias("stem"),
            F.concat(F.lit("["), F.substring("value", 1, 80)).alias("value"),
        )
        broken.coalesce(1).write.mode("append").option("compression", "gzip").partitionBy("stem").text(path)

    return ws.once("record_files", write)


@query
def scan_json_files(ws: Workspace) -> DataFrame:
    # The schema names what is read: the parser skips the other fields.
    wanted = (
        "trip_id STRING, VendorID INT, PULocationID STRUCT<LocationID: INT, zone: STRING>, "
        "DOLocationID STRUCT<LocationID: INT>, passenger_count DOUBLE, total_amount DOUBLE"
    )
    return tables.scan_json_arrays(ws.spark, _record_files(ws), wanted).select(
        "trip_id",
        F.col("VendorID").alias("vendor_id"),
        F.col("PULocationID.LocationID").alias("pickup_location_id"),
        F.col("PULocationID.zone").alias("pickup_zone"),
        F.col("DOLocationID.LocationID").alias("dropoff_location_id"),
        "passenger_count",
        "total_amount",
    )


@query
def ingest_stats_by_file(ws: Workspace) -> DataFrame:
    records = tables.json_records(ws.spark, _record_files(ws))
    checked = enrich.validate(records, "record").withColumn(
        "stem", F.regexp_extract("file", r"stem=([^/]+)", 1)
    )
    return enrich.ingest_stats(checked, "stem")


@query
def decode_envelope(ws: Workspace) -> DataFrame:
    zone = "STRUCT<LocationID: INT, borough: STRING, zone: STRING>"
    wanted = (
        "trip_id STRING, VendorID INT, payment_type INT, passenger_count DOUBLE, total_amount DOUBLE, "
        f"PULocationID {zone}, DOLocationID {zone}, producer_timestamp DOUBLE"
    )
    return topic.decode_wire(ws.topic(), wanted).select(
        "key",
        "msg.trip_id",
        F.col("msg.VendorID").alias("vendor_id"),
        "msg.payment_type",
        "msg.passenger_count",
        "msg.total_amount",
        F.col("msg.PULocationID.LocationID").alias("pickup_location_id"),
        F.col("msg.PULocationID.borough").alias("borough"),
        F.col("msg.DOLocationID.zone").alias("dropoff_zone"),
        F.col("msg.producer_timestamp").cast("bigint").alias("producer_timestamp"),
    )


@query
def list_trips(ws: Workspace) -> DataFrame:
    return documents.flatten_documents(analytics.first_documents(ws.documents()))


@query
def rollup_borough_time_lookup(ws: Workspace) -> DataFrame:
    return analytics.rollup_lookup(ws.rollup("borough_time"), BOROUGH, MONTH)


@query
def rollup_date_range_scan(ws: Workspace) -> DataFrame:
    return _text_dates(
        analytics.date_range(
            ws.rollup("borough_time"), BOROUGH, MONTH, f"{MONTH}-01", f"{MONTH}-07"
        )
    )


@query
def rollup_point_read(ws: Workspace) -> DataFrame:
    return _text_dates(analytics.point_read(ws.rollup("borough_time"), BOROUGH, MONTH))


def _view(ws: Workspace, name: str, view: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stored view of the borough rollup."""
    state = ws.state("borough_time")
    ws.once(
        "views",
        lambda p: files.write_views(state, f"{p}/revenue_by_borough", f"{p}/trips_by_time"),
    )
    return files.read_rollup(ws.spark, f"{ws.path('views')}/{name}", view(state).schema)


@query
def mv_revenue_by_borough(ws: Workspace) -> DataFrame:
    view = _view(ws, "revenue_by_borough", rollups.revenue_view)
    return _text_dates(analytics.best_hours(view, BOROUGH))


@query
def mv_trips_by_time(ws: Workspace) -> DataFrame:
    return _text_dates(_view(ws, "trips_by_time", rollups.time_view))


@query
def rollup_table_counts(ws: Workspace) -> DataFrame:
    return analytics.table_counts({name: ws.state(name) for name in ROLLUPS})


# ---- sinks -----------------------------------------------------------------------------------


@query
def write_json_chunks(ws: Workspace) -> DataFrame:
    """Records written and read back, and the files that hold more than allowed (none)."""
    path = ws.once(
        "json_chunks", lambda p: files.write_json_lines(ws.records().select("trip_id", "value"), p, compression="gzip")
    )
    lines = ws.spark.read.text(path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return lines.agg(
        F.sum("n").alias("total_records"),
        F.count_if(F.col("n") > files.RECORDS_PER_FILE).alias("files_over_limit"),
    )


@query
def encode_envelope(ws: Workspace) -> DataFrame:
    value = F.col("value")
    return ws.sent().select(
        "key",
        "trip_id",
        F.get_json_object(value, "$.PULocationID.zone").alias("pickup_zone"),
        F.get_json_object(value, "$.DOLocationID.LocationID").cast("int").alias("dropoff_location_id"),
        F.get_json_object(value, "$.tpep_pickup_datetime").alias("pickup_datetime"),
        F.get_json_object(value, "$.total_amount").cast("double").alias("total_amount"),
        F.array_contains(F.json_object_keys(value), "passenger_count").alias("has_passenger_count"),
    )



@query
def rollup_upsert(ws: Workspace) -> DataFrame:
    """Rows of card trips only, put over the full rollup: equal keys are replaced, others stay."""
    rollup, state = ROLLUPS["borough_time"], ws.state("borough_time")

    def write(table: str) -> None:
        served.upsert(ws.spark, table, state, rollup)
        cards = rollups.accepted(ws.facts()).filter("payment_type = 1")
        served.upsert(ws.spark, table, rollups.aggregate(cards, rollup), rollup)

    now = served.read(ws.spark, ws.once("rollup_upserted", write), state.schema)
    return _text_dates(
        rollups.present(now, rollup).select(
            *rollup.pk, "sum_total_amount", "count_payment_card", "count_payment_cash", "trip_count"
        )
    )


@query
def delete_partition(ws: Workspace) -> DataFrame:
    """The rollup without one borough's month: the range that held it is written anew."""
    rollup, state = ROLLUPS["borough_time"], ws.state("borough_time")

    def write(table: str) -> None:
        served.upsert(ws.spark, table, state, rollup)
        served.delete(ws.spark, table, F.col("borough") == BOROUGH, rollup, MONTH)

    left = served.read(ws.spark, ws.once("rollup_borough_time_deleted", write), state.schema)
    return left.groupBy("borough", "year_month").agg(F.count("*").alias("row_count"))


# ---- validation and reshape ------------------------------------------------------------------


@query
def validate_records(ws: Workspace) -> DataFrame:
    return enrich.validate(ws.records()).select("trip_id", "is_valid", "reason")


@query
def reject_reasons(ws: Workspace) -> DataFrame:
    _, rejected = enrich.split_valid(enrich.validate(ws.records()))
    return rejected.groupBy("reason").agg(F.count("*").alias("rejected"))


@query
def stamp_records(ws: Workspace) -> DataFrame:
    rows = ws.trips_raw().select(F.col("trip_id").alias("source_id"), "tpep_dropoff_datetime")
    sent_at = F.col("tpep_dropoff_datetime").cast("timestamp")
    return enrich.stamp(rows, ["source_id"], sent_at).select(
        "source_id", "trip_id", F.col("producer_timestamp").cast("bigint").alias("producer_timestamp")
    )


@query
def trip_documents(ws: Workspace) -> DataFrame:
    return documents.flatten_documents(ws.documents())


@query
def trip_metrics(ws: Workspace) -> DataFrame:
    metrics = documents.trip_metrics(
        F.col("tpep_pickup_datetime"),
        F.col("tpep_dropoff_datetime"),
        F.col("trip_distance"),
        F.col("fare_amount"),
    )
    return ws.trips_raw().select("trip_id", metrics.alias("m")).select("trip_id", "m.*")


@query
def anomaly_trips(ws: Workspace) -> DataFrame:
    return anomalies.trip_anomalies(ws.ingested())


@query
def anomaly_counts(ws: Workspace) -> DataFrame:
    return anomalies.label_counts(anomalies.trip_anomalies(ws.ingested()))


@query
def anomaly_labels_simple(ws: Workspace) -> DataFrame:
    found = anomalies.trip_anomalies(ws.ingested()).withColumn(
        "label",
        anomalies.card_label(F.col("distance_km"), F.col("duration_minutes"), F.col("total_amount")),
    )
    return anomalies.label_counts(found, "label", CARD_LABELS)


@query
def anomaly_rollups(ws: Workspace) -> DataFrame:
    return anomalies.month_rollup_anomalies(
        ws.rollup("borough_time"), ws.rollup("pickup_zone"), ws.rollup("route"), BOROUGH, MONTH
    ).drop("row_key")


@query
def anomaly_rollups_all(ws: Workspace) -> DataFrame:
    return anomalies.all_rollup_anomalies(
        ws.rollup("borough_time"), ws.rollup("pickup_zone"), ws.rollup("route")
    ).drop("row_key")


# ---- joins -----------------------------------------------------------------------------------


@query
def enrich_zones(ws: Workspace) -> DataFrame:
    pu, do = "PULocationID", "DOLocationID"
    return ws.enriched().select(
        "trip_id",
        F.col(f"{pu}.LocationID").alias("pickup_location_id"),
        F.col(f"{pu}.borough").alias("pickup_borough"),
        F.col(f"{pu}.zone").alias("pickup_zone"),
        F.col(f"{pu}.Shape_Leng").alias("pickup_shape_leng"),
        F.col(f"{do}.LocationID").alias("dropoff_location_id"),
        F.col(f"{do}.borough").alias("dropoff_borough"),
        F.col(f"{do}.geometry_type").alias("dropoff_geometry_type"),
        F.col(do).isNull().alias("dropoff_is_null"),
    )


@query
def unresolved_zones(ws: Workspace) -> DataFrame:
    return enrich.unresolved(ws.trips_raw(), ws.zones())


@query
def route_sample_per_location(ws: Workspace) -> DataFrame:
    return _text_dates(anomalies.route_sample(ws.rollup("route"), MONTH))


@query
def zone_route_join(ws: Workspace) -> DataFrame:
    joined = analytics.zones_with_routes(ws.rollup("pickup_zone"), ws.rollup("route"), BOROUGH, MONTH)
    return _text_dates(
        joined.select(
            "pickup_zone",
            "year_month",
            "dropoff_zone",
            "pickup_date",
            "zone_revenue",
            "zone_trips",
            "avg_fare_amount",
            "trip_count",
        )
    )


@query
def borough_ids(ws: Workspace) -> DataFrame:
    numbered = documents.add_borough_ids(
        ws.resolved(), ws.dictionary(), F.col("borough"), F.col("dropoff_borough")
    )
    return numbered.select("trip_id", "pickup_borough_id", "dropoff_borough_id")


def _redelivered(ws: Workspace) -> DataFrame:
    trips = ws.trips().select("trip_id", "payment_type", "VendorID", "PULocationID")
    again = trips.filter((F.col("payment_type") == 2) & (F.col("VendorID") == 1))
    return trips.unionByName(again)


def _read_back(ws: Workspace) -> DataFrame:
    return _redelivered(ws).filter(F.col("PULocationID") != 7)


@query
def reconcile_writes(ws: Workspace) -> DataFrame:
    return quality.missing_keys(_redelivered(ws), _read_back(ws), "trip_id")


@query
def key_difference(ws: Workspace) -> DataFrame:
    return quality.key_difference(_redelivered(ws), _read_back(ws), "trip_id")


@query
def duplicate_keys(ws: Workspace) -> DataFrame:
    return quality.duplicate_keys(_read_back(ws), "trip_id")


@query
def integrity_verdict(ws: Workspace) -> DataFrame:
    return quality.integrity(_redelivered(ws), _read_back(ws), "trip_id")


# ---- rollups ---------------------------------------------------------------------------------


def _rollup(ws: Workspace, name: str) -> DataFrame:
    rollup = ROLLUPS[name]
    state = rollups.aggregate(rollups.accepted(ws.facts()), rollup)
    return _text_dates(rollups.present(state, rollup))


@query
def rollup_borough_time(ws: Workspace) -> DataFrame:
    return _rollup(ws, "borough_time")


@query
def rollup_pickup_zone(ws: Workspace) -> DataFrame:
    return _rollup(ws, "pickup_zone")


@query
def rollup_route(ws: Workspace) -> DataFrame:
    return _rollup(ws, "route")


@query
def rollup_vendor(ws: Workspace) -> DataFrame:
    return _rollup(ws, "vendor")



@query
def aggregate_rejects(ws: Workspace) -> DataFrame:
    return rollups.rejects(rollups.facts_from_trips(ws.resolved()))


# ---- analyses --------------------------------------------------------------------------------


@query
def top_zones_by_revenue(ws: Workspace) -> DataFrame:
    return analytics.top_boroughs_by_revenue(documents.trips_of(ws.documents()))


@query
def top_zones_by_trips(ws: Workspace) -> DataFrame:
    return analytics.top_boroughs_by_trips(documents.trips_of(ws.documents()))


@query
def passenger_distribution(ws: Workspace) -> DataFrame:
    return analytics.passenger_distribution(documents.trips_of(ws.documents()))


@query
def hourly_stats(ws: Workspace) -> DataFrame:
    return analytics.hourly_stats(documents.trips_of(ws.documents()))


@query
def borough_distribution(ws: Workspace) -> DataFrame:
    numbered = documents.add_borough_ids(
        ws.ingested(), ws.dictionary(), F.col("borough"), F.col("dropoff_borough")
    )
    return analytics.borough_distribution(numbered, "pickup_borough_id")


@query
def borough_counts(ws: Workspace) -> DataFrame:
    return analytics.borough_counts(ws.trips())


@query
def top_zones_revenue(ws: Workspace) -> DataFrame:
    return analytics.top_zones_by_revenue(ws.rollup("pickup_zone"), BOROUGH, MONTH)


@query
def hourly_performance(ws: Workspace) -> DataFrame:
    return analytics.hourly_performance(ws.rollup("borough_time"), BOROUGH, MONTH)


@query
def route_stats(ws: Workspace) -> DataFrame:
    return _text_dates(analytics.route_stats(ws.rollup("route"), LOCATION, MONTH))


@query
def vendor_performance(ws: Workspace) -> DataFrame:
    return _text_dates(analytics.vendor_performance(ws.rollup("vendor"), VENDOR, BOROUGH, MONTH))


@query
def vendor_summary(ws: Workspace) -> DataFrame:
    return analytics.vendor_summary(
        analytics.vendor_performance(ws.rollup("vendor"), VENDOR, BOROUGH, MONTH)
    )


@query
def payment_types(ws: Workspace) -> DataFrame:
    return analytics.payment_mix(ws.rollup("borough_time"), BOROUGH, MONTH)


@query
def partition_revenue_total(ws: Workspace) -> DataFrame:
    return analytics.partition_revenue(ws.rollup("borough_time"), BOROUGH, MONTH)


@query
def partition_revenue_by_hour(ws: Workspace) -> DataFrame:
    return analytics.partition_revenue_by_hour(ws.rollup("borough_time"), BOROUGH, MONTH)


@query
def borough_dictionary(ws: Workspace) -> DataFrame:
    return ws.dictionary_of_trips()


@query
def revenue_by_borough_month(ws: Workspace) -> DataFrame:
    return analytics.revenue_by_borough(ws.rollup("borough_time"), MONTH)


@query
def distinct_pickup_locations(ws: Workspace) -> DataFrame:
    return analytics.pickup_locations(ws.rollup("route"), MONTH)


# ---- skew ------------------------------------------------------------------------------------


def _keyed(ws: Workspace) -> tuple[DataFrame, dict]:
    trips = ws.trips()
    date, hour = F.to_date("pickup_ts"), F.hour("pickup_ts")
    return trips, {
        "borough_hour": F.concat_ws("_", "borough", hour.cast("string")),
        "time_bucket": fn.six_hour_bucket(date, hour),
        "unique_id": F.md5("trip_id"),
        "hash": fn.md5_bucket(F.concat(F.col("borough"), date.cast("string")), 100).cast("string"),
    }


def _skew(ws: Workspace, strategy: str) -> DataFrame:
    trips, keys = _keyed(ws)
    return quality.skew_summary(trips, keys[strategy])


@query
def skew_borough_hour(ws: Workspace) -> DataFrame:
    return _skew(ws, "borough_hour")


@query
def skew_time_bucket(ws: Workspace) -> DataFrame:
    return _skew(ws, "time_bucket")


@query
def skew_unique_id(ws: Workspace) -> DataFrame:
    return _skew(ws, "unique_id")


@query
def skew_hash(ws: Workspace) -> DataFrame:
    return _skew(ws, "hash")


@query
def hottest_partitions(ws: Workspace) -> DataFrame:
    trips, keys = _keyed(ws)
    return quality.hottest(trips, keys["borough_hour"])


@query
def skew_report(ws: Workspace) -> DataFrame:
    parts = ["trip_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "borough", "pickup_zone"]
    return quality.bucket_report(
        ws.trips(), F.col("borough"), 6, F.octet_length(F.concat_ws("|", *parts)).cast("bigint")
    )


@query
def skew_balance_score(ws: Workspace) -> DataFrame:
    return quality.bucket_balance(ws.trips(), F.col("borough"), 6)


@query
def top_boroughs_share(ws: Workspace) -> DataFrame:
    counts = ws.trips().groupBy("borough").agg(F.count("*").alias("trips"))
    return quality.shares(counts, "trips", 10)



# ---- measurements ----------------------------------------------------------------------------



@query
def latency_summary(ws: Workspace) -> DataFrame:
    return quality.latency_summary(ws.events(), ["event_type"], "value")








@query
def timing_extremes(ws: Workspace) -> DataFrame:
    timings = ws.events().select(
        F.concat(F.lit("event_"), F.col("event_id").cast("string")).alias("query_name"),
        F.when(F.col("event_id") % 50 == 0, 0.0).otherwise(F.col("value")).alias("ms"),
    )
    found = quality.timing_extremes(timings, "query_name", "ms")
    return found.toDF("events", "avg_value_above_zero", "least_event", "greatest_event")


@query
def compare_results(ws: Workspace) -> DataFrame:
    """The first click and the first purchase of each user and day as two result sets; most days
    have only one of them."""

    def first(kind: str) -> DataFrame:
        day = F.to_date("ts").cast("string")
        name = F.concat_ws("_", F.lit("user"), F.col("user_id").cast("string"), day)
        of_kind = ws.events().filter(F.col("event_type") == kind)
        return of_kind.groupBy(name.alias("query")).agg(F.min_by("value", "event_id").alias("ms"))

    both = quality.side_by_side(first("click"), first("purchase"), "query", "ms")
    return both.toDF("user_day", "first_click", "first_purchase")


# ---- windows ---------------------------------------------------------------------------------


@query
def last_n_trips(ws: Workspace) -> DataFrame:
    newest = windows.last_n(ws.events(), 15, F.desc("event_id"))
    return newest.select("event_id", "event_type", "value")


@query
def rolling_latency(ws: Workspace) -> DataFrame:
    samples = ws.events().select("event_id", F.col("value").cast("decimal(18,2)").alias("ms"))
    return windows.rolling_stats(samples, "event_id", "ms", 5000)


@query
def trips_per_minute(ws: Workspace) -> DataFrame:
    return windows.trailing_rate(ws.events(), "ts")


@query
def running_totals(ws: Workspace) -> DataFrame:
    paid = ws.events().select("event_id", F.col("value").cast("decimal(18,2)").alias("paid"))
    return windows.running_totals(paid, "event_id", "paid")


# ---- scalar functions ------------------------------------------------------------------------


@query
def scalar_dates(ws: Workspace) -> DataFrame:
    start, end = F.col("pickup_ts"), F.col("dropoff_ts")
    return ws.trips().select(
        "trip_id",
        fn.year_month(start).alias("year_month"),
        F.to_date(start).cast("string").alias("pickup_date"),
        F.hour(start).alias("pickup_hour"),
        fn.seconds_between(start, end).alias("duration_seconds"),
        fn.minutes_between(start, end).alias("duration_minutes"),
        F.date_add(F.to_date(start), F.col("payment_type")).cast("string").alias("plus_days"),
        fn.six_hour_bucket(F.to_date(start), F.hour(start)).alias("time_bucket"),
        F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("as_text"),
    )


@query
def scalar_strings(ws: Workspace) -> DataFrame:
    return ws.trips().select(
        "trip_id",
        F.lower("pickup_zone").alias("lower_zone"),
        fn.capitalize(F.lower("pickup_zone")).alias("label"),
        fn.strip_percent(
            F.when(F.col("payment_type") == 1, "n/a%").otherwise(
                F.concat(F.col("trip_distance").cast("string"), F.lit("%"))
            )
        ).alias("percent"),
        fn.short_id(F.col("trip_id")).alias("short_id"),
        fn.md5_bucket(F.concat("borough", F.to_date("pickup_ts").cast("string")), 100).alias("hash_bucket"),
    )


@query
def scalar_math(ws: Workspace) -> DataFrame:
    size = F.col("VendorID") * F.pow(F.lit(1024.0), F.col("payment_type") - 1) * F.col("trip_distance")
    return ws.trips().select(
        "trip_id",
        fn.km_to_miles(F.col("trip_distance")).alias("miles"),
        fn.miles_to_km(F.col("trip_distance")).alias("km"),
        fn.per_second(F.col("trip_distance") * 10).alias("per_second"),
        F.round(F.col("trip_distance") / 8, 2).alias("rounded"),
        F.col("trip_distance").cast("int").alias("truncated"),
        fn.format_bytes(size).alias("size_text"),
    )
