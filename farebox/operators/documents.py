"""Nested trip documents and the borough dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.functions.scalars import parse_time, seconds_between
from farebox.schemas import TIME_FORMAT


def trip_metrics(
    pickup: Column, dropoff: Column, distance: Column, fare: Column, hour_divisor: float = 3600.0
) -> Column:
    """Distance, duration in hours, speed and price per km; zero or null inputs give null."""
    hours = seconds_between(parse_time(pickup), parse_time(dropoff)) / F.lit(hour_divisor)
    has_distance = distance.isNotNull() & (distance != 0)
    speed = F.when(has_distance & hours.isNotNull() & (hours != 0), distance / hours)
    price = F.when(
        has_distance, F.when(distance > 0, fare.cast("double") / distance).otherwise(F.lit(0.0))
    )
    return F.struct(
        distance.alias("distance_km"),
        F.round(hours, 2).alias("duration_h"),
        F.round(speed, 2).alias("speed_kmh"),
        F.round(price, 2).alias("price_per_km"),
    )


def _location(column: str, borough_id: Column) -> Column:
    zone = F.col(column)
    return F.struct(
        zone["LocationID"].alias("location_id"),
        zone["Shape_Leng"].alias("shape_leng"),
        zone["Shape_Area"].alias("shape_area"),
        zone["borough"].alias("borough"),
        zone["zone"].alias("zone"),
        borough_id.alias("borough_id"),
    )


def to_documents(messages: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Flat message columns to the five nested parts of a trip document.

    ``dictionary`` (borough, borough_id) fills the surrogate ids; it is a stored table, so its
    real size decides whether the join broadcasts. Absent fields are null.
    """
    pickup_id = dropoff_id = F.lit(None).cast("int")
    if dictionary is not None:
        messages = add_borough_ids(
            messages,
            dictionary,
            F.col("PULocationID.borough"),
            F.col("DOLocationID.borough"),
        )
        pickup_id, dropoff_id = F.col("pickup_borough_id"), F.col("dropoff_borough_id")
    amounts = [
        "payment_type",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "congestion_surcharge",
    ]
    return messages.select(
        "trip_id",
        F.struct(
            F.col("tpep_pickup_datetime").alias("datetime"),
            _location("PULocationID", pickup_id).alias("location"),
        ).alias("pickup"),
        F.struct(
            F.col("tpep_dropoff_datetime").alias("datetime"),
            _location("DOLocationID", dropoff_id).alias("location"),
        ).alias("dropoff"),
        "passenger_count",
        F.struct(
            *amounts, F.col("Airport_fee").alias("airport_fee"), F.col("total_amount")
        ).alias("payment"),
        trip_metrics(
            F.col("tpep_pickup_datetime"),
            F.col("tpep_dropoff_datetime"),
            F.col("trip_distance"),
            F.col("fare_amount"),
        ).alias("metrics"),
        F.struct(
            F.col("VendorID").alias("vendor_id"),
            F.col("RatecodeID").alias("ratecode_id"),
            F.col("store_and_fwd_flag"),
            F.lit("kafka").alias("source"),
            F.date_format(
                F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()), TIME_FORMAT
            ).alias("insertion_time"),
        ).alias("metadata"),
    )


def add_borough_ids(
    trips: DataFrame, dictionary: DataFrame, pickup: Column, dropoff: Column
) -> DataFrame:
    """Surrogate ids of both boroughs; a null or unlisted borough gets a null id."""
    for column, borough in (("pickup_borough_id", pickup), ("dropoff_borough_id", dropoff)):
        side = dictionary.select(
            F.col("borough").alias("dict_borough"), F.col("borough_id").alias(column)
        )
        trips = trips.join(side, borough == F.col("dict_borough"), "left").drop("dict_borough")
    return trips


def first_seen(trips: DataFrame, arrival_ms: Column, pickup: Column, dropoff: Column) -> DataFrame:
    """Every borough with the place it first appears: by arrival, pickup before dropoff.

    The place is one number, so it is a running minimum in a hash aggregate, and places of several
    batches merge by their minimum.
    """
    seen = trips.select(
        F.posexplode(F.array(pickup, dropoff)).alias("side", "borough"), arrival_ms.alias("at")
    ).filter(F.col("borough").isNotNull())
    return seen.groupBy("borough").agg(F.min(F.col("at") * 2 + F.col("side")).alias("first"))


def borough_dictionary(first: DataFrame) -> DataFrame:
    """Number boroughs in order of first appearance, those of one place by name. One row per borough
    goes through here."""
    order = Window.orderBy("first", "borough")
    return first.select("borough", F.row_number().over(order).cast("int").alias("borough_id"))


def trips_of(documents: DataFrame) -> DataFrame:
    """Stored documents as the flat trips the analyses read, amounts as decimals again; trips whose
    pickup time does not parse are left out."""
    return documents.filter(parse_time(F.col("pickup.datetime")).isNotNull()).select(
        "trip_id",
        F.col("pickup.location.borough").alias("borough"),
        F.col("pickup.datetime").alias("tpep_pickup_datetime"),
        "passenger_count",
        F.col("metrics.distance_km").alias("trip_distance"),
        F.col("payment.fare_amount").cast("decimal(12,2)").alias("fare_amount"),
        F.col("payment.total_amount").cast("decimal(14,2)").alias("total_amount"),
    )


DOCUMENT_COLUMNS = {
    "trip_id": "trip_id",
    "pickup_datetime": "pickup.datetime",
    "pickup_location_id": "pickup.location.location_id",
    "pickup_shape_leng": "pickup.location.shape_leng",
    "pickup_shape_area": "pickup.location.shape_area",
    "pickup_borough": "pickup.location.borough",
    "pickup_zone": "pickup.location.zone",
    "pickup_borough_id": "pickup.location.borough_id",
    "dropoff_datetime": "dropoff.datetime",
    "dropoff_location_id": "dropoff.location.location_id",
    "dropoff_shape_leng": "dropoff.location.shape_leng",
    "dropoff_shape_area": "dropoff.location.shape_area",
    "dropoff_borough": "dropoff.location.borough",
    "dropoff_zone": "dropoff.location.zone",
    "dropoff_borough_id": "dropoff.location.borough_id",
    "passenger_count": "passenger_count",
    "payment_type": "payment.payment_type",
    "fare_amount": "payment.fare_amount",
    "extra": "payment.extra",
    "mta_tax": "payment.mta_tax",
    "tip_amount": "payment.tip_amount",
    "tolls_amount": "payment.tolls_amount",
    "improvement_surcharge": "payment.improvement_surcharge",
    "congestion_surcharge": "payment.congestion_surcharge",
    "airport_fee": "payment.airport_fee",
    "total_amount": "payment.total_amount",
    "distance_km": "metrics.distance_km",
    "duration_h": "metrics.duration_h",
    "speed_kmh": "metrics.speed_kmh",
    "price_per_km": "metrics.price_per_km",
    "vendor_id": "metadata.vendor_id",
    "ratecode_id": "metadata.ratecode_id",
    "store_and_fwd_flag": "metadata.store_and_fwd_flag",
    "source": "metadata.source",
}


def flatten_documents(documents: DataFrame) -> DataFrame:
    """Documents as flat rows, without the wall-clock insertion time."""
    return documents.select(*[F.col(path).alias(name) for name, path in DOCUMENT_COLUMNS.items()])
