"""Anomaly detectors over trips and over rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.functions.scalars import (
    km_to_miles,
    miles_to_km,
    minutes_between,
    not_nan,
    parse_time,
    zero_if_null,
)
from farebox.operators.rollups import ROLLUPS
from farebox.schemas import ANOMALY_LABELS, CARD_LABELS, MAX_SPEED_KMH, MAX_SPEED_MPH


def _holds(condition: Column) -> Column:
    """A comparison with null does not hold."""
    return F.coalesce(condition, F.lit(False))


def _low(condition: Column) -> Column:
    """In the labels null ranks below every number, so 'at most' and 'below' hold for it."""
    return F.coalesce(condition, F.lit(True))


def trip_anomalies(trips: DataFrame, limit: int | None = None) -> DataFrame:
    """Trips with a zero distance, an impossible duration or amount, or a speed above the limit.

    Input times are text and may not parse. A ``limit`` takes the first trips by id.
    """
    pickup = parse_time(F.col("tpep_pickup_datetime"))
    dropoff = parse_time(F.col("tpep_dropoff_datetime"))
    distance, total, fare, tip = (
        not_nan(F.col(c)) for c in ("trip_distance", "total_amount", "fare_amount", "tip_amount")
    )
    measured = trips.select(
        "trip_id",
        "pickup_zone",
        "dropoff_zone",
        "borough",
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        distance.alias("distance_km"),
        minutes_between(pickup, dropoff).alias("duration_minutes"),
        total.alias("total_amount"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        "passenger_count",
    )
    km, minutes = F.col("distance_km"), F.col("duration_minutes")
    speed = F.when((km > 0) & (minutes > 0), km / (minutes / 60.0)).otherwise(F.lit(0.0))
    measured = measured.withColumn("speed_kmh", speed)
    total, fare, tip = F.col("total_amount"), F.col("fare_amount"), F.col("tip_amount")
    fast = F.col("speed_kmh") > MAX_SPEED_KMH
    found = measured.filter(
        _holds((km <= 0) & (total > 0))
        | _holds(minutes <= 0)
        | minutes.isNull()
        | _holds(total <= 0)
        | _holds(fare < 0)
        | _holds(tip < 0)
        | _holds(fast)
    )
    label = (
        F.when(_low(km <= 0) & _holds(total > 0), "zero_distance")
        .when(_low(minutes <= 0), "invalid_duration")
        .when(_low(total <= 0) | _low(fare < 0), "invalid_amount")
        .when(_holds(fast), "high_speed")
        .otherwise("other")
    )
    if limit is not None:
        found = found.orderBy("trip_id").limit(limit)
    return found.select(
        "*",
        km_to_miles(km).alias("distance_miles"),
        km_to_miles(F.col("speed_kmh")).alias("speed_mph"),
        label.alias("anomaly_type"),
    )


def label_counts(
    labelled: DataFrame, column: str = "anomaly_type", labels: list[str] = ANOMALY_LABELS
) -> DataFrame:
    """Count per label, zero for a label that does not occur."""
    spark = labelled.sparkSession
    wanted = spark.createDataFrame([(x,) for x in labels], f"{column} string")
    found = labelled.groupBy(column).agg(F.count("*").alias("n"))
    return wanted.join(found, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def card_label(distance: Column, minutes: Column, total: Column) -> Column:
    """Label on the anomaly card: only true zero distance and negative values count."""
    zero, bad_time, bad_amount, fast = CARD_LABELS
    return (
        F.when(distance == 0, zero)
        .when(minutes < 0, bad_time)
        .when(total < 0, bad_amount)
        .otherwise(fast)
    )


# The table each detector reads, as the report names it.
HOURS, ZONES, ROUTES = "trips_by_borough_time", "trips_by_pickup_zone", "trips_by_route"


def _row(source: int, table: str, order: list[Column], **values: Column) -> list[Column]:
    """One anomaly in the common shape of the three detectors."""
    zero, unknown = F.lit(0.0), F.lit("Unknown")
    shape = {
        "pickup_zone": unknown,
        "dropoff_zone": unknown,
        "borough": unknown,
        "pickup_datetime": unknown,
        "distance_km": zero,
        "distance_miles": zero,
        "duration_minutes": zero,
        "total_amount": zero,
        "fare_amount": zero,
        "tip_amount": zero,
        "speed_kmh": zero,
        "speed_mph": zero,
        "anomaly_type": unknown,
    }
    shape.update(values)
    return [
        F.lit(source).alias("source_order"),
        F.lit(table).alias("source"),
        F.concat_ws("|", *order).alias("row_key"),
        *[
            (F.round(v, 2) if n not in shape_text else v).alias(n) for n, v in shape.items()
        ],
    ]


shape_text = {"pickup_zone", "dropoff_zone", "borough", "pickup_datetime", "anomaly_type"}


def _day_hour() -> Column:
    hour = F.lpad(F.col("pickup_hour").cast("string"), 2, "0")
    return F.concat(F.col("pickup_date").cast("string"), F.lit(" "), hour, F.lit(":00:00"))


def financial_anomalies(borough_time: DataFrame) -> DataFrame:
    """Hours of a borough whose summed amounts make no sense."""
    total, fare, tip = (
        zero_if_null(F.col(c)) for c in ("sum_total_amount", "sum_fare_amount", "sum_tip_amount")
    )
    hour = F.col("pickup_hour").cast("string")
    return borough_time.filter((total <= 0) | (fare < 0) | (tip < 0)).select(
        *_row(
            1,
            HOURS,
            [F.col("borough"), F.col("pickup_date"), F.lpad(hour, 2, "0")],
            pickup_zone=F.concat(F.col("borough"), F.lit(" (Hour "), hour, F.lit(")")),
            borough=F.col("borough"),
            pickup_datetime=_day_hour(),
            total_amount=total,
            fare_amount=fare,
            tip_amount=tip,
            anomaly_type=F.lit("invalid_amount"),
        )
    )


def zero_distance_anomalies(pickup_zone: DataFrame) -> DataFrame:
    """Zone hours that were charged for but covered no distance."""
    distance = zero_if_null(F.col("avg_trip_distance"))
    total = zero_if_null(F.col("sum_total_amount"))
    return pickup_zone.filter((distance == 0) & (total > 0)).select(
        *_row(
            2,
            ZONES,
            [
                F.col("borough"),
                F.col("pickup_date"),
                F.lpad(F.col("pickup_hour").cast("string"), 2, "0"),
                F.col("pickup_zone"),
            ],
            pickup_zone=F.coalesce("pickup_zone", F.lit("Unknown")),
            borough=F.col("borough"),
            pickup_datetime=_day_hour(),
            total_amount=total,
            fare_amount=zero_if_null(F.col("sum_fare_amount")),
            anomaly_type=F.lit("zero_distance"),
        )
    )


def route_anomalies(route: DataFrame) -> DataFrame:
    """Route days with an impossible mean duration or a mean speed above the limit."""
    miles = zero_if_null(F.col("avg_trip_distance"))
    seconds = zero_if_null(F.col("avg_duration"))
    mph = F.when(seconds > 0, miles / seconds * 3600.0).otherwise(F.lit(0.0))
    label = F.when((seconds <= 0) & (miles > 0), "invalid_duration").when(
        (miles > 0) & (seconds > 0) & (mph > MAX_SPEED_MPH), "high_speed"
    )
    fare = zero_if_null(F.col("avg_fare_amount"))
    return route.withColumn("label", label).filter(F.col("label").isNotNull()).select(
        *_row(
            3,
            ROUTES,
            [
                F.lpad(F.col("pickup_location_id").cast("string"), 10, "0"),
                F.lpad(F.col("dropoff_location_id").cast("string"), 10, "0"),
                # Latest day first inside a route.
                F.lpad(F.date_diff(F.lit("9999-12-31").cast("date"), "pickup_date").cast("string"), 10, "0"),
            ],
            pickup_zone=F.coalesce("pickup_zone", F.lit("Unknown")),
            dropoff_zone=F.coalesce("dropoff_zone", F.lit("Unknown")),
            pickup_datetime=F.col("pickup_date").cast("string"),
            distance_km=miles_to_km(miles),
            distance_miles=miles,
            duration_minutes=seconds / 60.0,
            total_amount=fare,
            fare_amount=fare,
            speed_kmh=miles_to_km(mph),
            speed_mph=mph,
            anomaly_type=F.col("label"),
        )
    )


def all_rollup_anomalies(borough_time, pickup_zone, route) -> DataFrame:
    """Every anomaly the three detectors find, tagged with its source."""
    return (
        financial_anomalies(borough_time)
        .unionByName(zero_distance_anomalies(pickup_zone))
        .unionByName(route_anomalies(route))
    )


def route_sample(route: DataFrame, month: str, per_location: int = 50) -> DataFrame:
    """The first routes of every pickup location of a month, in clustering order."""
    first = Window.partitionBy("pickup_location_id").orderBy(*ROLLUPS["route"].order())
    return (
        route.filter(F.col("year_month") == month)
        .withColumn("rn", F.row_number().over(first))
        .filter(F.col("rn") <= per_location)
        .drop("rn")
    )


def month_rollup_anomalies(
    borough_time: DataFrame,
    pickup_zone: DataFrame,
    route: DataFrame,
    borough: str,
    month: str,
    limit: int | None = None,
) -> DataFrame:
    """The three detectors over one month: a borough's hours and zones, and all routes.

    ``limit`` keeps the first rows in source order.
    """
    here = (F.col("borough") == borough) & (F.col("year_month") == month)
    found = all_rollup_anomalies(
        borough_time.filter(here), pickup_zone.filter(here), route.filter(F.col("year_month") == month)
    ).orderBy("source_order", "row_key")
    return found if limit is None else found.limit(limit)
