"""The fixed analyses. Trip-level ones read trips, the others read one of the rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.scalars import exact_avg, money, parse_time_strict, zero_if_null
from farebox.operators.rollups import ROLLUPS
from farebox.schemas import PAYMENT_CODES

# ---- over trips ------------------------------------------------------------------------------


def top_boroughs_by_revenue(trips: DataFrame, limit: int = 10) -> DataFrame:
    return (
        trips.groupBy("borough")
        .agg(
            money(F.sum("total_amount")).alias("total_revenue"),
            F.count("*").alias("total_trips"),
            exact_avg(F.col("fare_amount")).alias("avg_fare"),
        )
        .orderBy(F.desc("total_revenue"), "borough")
        .limit(limit)
    )


def top_boroughs_by_trips(trips: DataFrame, limit: int = 10) -> DataFrame:
    return (
        trips.groupBy("borough")
        .agg(
            F.count("*").alias("total_trips"),
            money(F.sum("total_amount")).alias("total_revenue"),
            exact_avg(F.col("passenger_count")).alias("avg_passengers"),
        )
        .orderBy(F.desc("total_trips"), "borough")
        .limit(limit)
    )


def passenger_distribution(trips: DataFrame) -> DataFrame:
    """Trips without a passenger count are a group of their own."""
    return (
        trips.groupBy("passenger_count")
        .agg(
            F.count("*").alias("count"),
            exact_avg(F.col("fare_amount")).alias("avg_fare"),
            exact_avg(F.col("trip_distance")).alias("avg_distance"),
        )
        .orderBy(F.asc_nulls_first("passenger_count"))
    )


def hourly_stats(trips: DataFrame) -> DataFrame:
    """By hour of day; a pickup time that does not parse fails the query."""
    hour = F.hour(parse_time_strict(F.col("tpep_pickup_datetime")))
    return (
        trips.groupBy(hour.alias("hour"))
        .agg(
            F.count("*").alias("total_trips"),
            money(F.sum("total_amount")).alias("total_revenue"),
            exact_avg(F.col("fare_amount")).alias("avg_fare"),
            exact_avg(F.col("trip_distance")).alias("avg_distance"),
        )
        .orderBy("hour")
    )


def borough_distribution(trips: DataFrame, borough_id: str) -> DataFrame:
    label = F.coalesce(F.col(borough_id).cast("string"), F.lit("Unknown"))
    return (
        trips.groupBy(label.alias("borough_id"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "borough_id")
    )


def borough_counts(trips: DataFrame) -> DataFrame:
    return trips.groupBy("borough").agg(F.count("*").alias("count")).orderBy("borough")


def first_documents(documents: DataFrame, limit: int = 50) -> DataFrame:
    """The stored documents with the lowest trip ids: every task keeps its own lowest ``limit``."""
    return documents.orderBy("trip_id").limit(limit)


# ---- over rollups ----------------------------------------------------------------------------


def partition(rollup: DataFrame, **key) -> DataFrame:
    """One partition: the month prunes directories, the other keys prune row groups."""
    for column, value in key.items():
        rollup = rollup.filter(F.col(column) == value)
    return rollup


def rollup_lookup(
    borough_time: DataFrame,
    borough: str | None = None,
    month: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Hours of a borough; both keys or none. ``limit`` keeps the first of them."""
    rows = borough_time
    if borough and month:
        rows = partition(rows, borough=borough, year_month=month)
    sums = ["passenger_count", "fare_amount", "total_amount", "mta_tax", "tip_amount"]
    rows = rows.select(
        "borough",
        "year_month",
        F.col("pickup_date").cast("string").alias("pickup_date"),
        "pickup_hour",
        *[zero_if_null(F.col(f"sum_{s}")).alias(f"sum_{s}") for s in sums],
        *[zero_if_null(F.col(f"count_vendor_{v}")).alias(f"count_vendor_{v}") for v in ("cmt", "verifone")],
    )
    if limit is None:
        return rows
    return rows.orderBy("borough", "year_month", "pickup_date", "pickup_hour").limit(limit)


def date_range(borough_time: DataFrame, borough: str, month: str, first: str, last: str) -> DataFrame:
    here = partition(borough_time, borough=borough, year_month=month)
    return here.filter(
        F.col("pickup_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def point_read(borough_time: DataFrame, borough: str, month: str) -> DataFrame:
    here = partition(borough_time, borough=borough, year_month=month)
    return here.orderBy(*ROLLUPS["borough_time"].order()).limit(1)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and in all of them (``ALL``)."""
    counts = None
    for name, table in tables.items():
        rows = table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        counts = rows if counts is None else counts.unionByName(rows)
    return (
        counts.rollup("table")
        .agg(F.sum("row_count").alias("row_count"), F.count("*").alias("tables"))
        .select(F.coalesce("table", F.lit("ALL")).alias("table"), "row_count", "tables")
    )


def top_zones_by_revenue(pickup_zone: DataFrame, borough: str, month: str, limit: int = 20) -> DataFrame:
    return (
        partition(pickup_zone, borough=borough, year_month=month)
        .groupBy("pickup_zone")
        .agg(
            money(F.sum(F.col("sum_total_amount").cast("decimal(28,2)"))).alias("total_revenue"),
            F.round(F.sum("sum_passenger_count"), 0).alias("total_passengers"),
        )
        .orderBy(F.desc("total_revenue"), "pickup_zone")
        .limit(limit)
    )


def hourly_performance(borough_time: DataFrame, borough: str, month: str) -> DataFrame:
    """All 24 hours, zero where nothing was driven."""
    hours = borough_time.sparkSession.range(24).select(F.col("id").cast("int").alias("pickup_hour"))
    by_hour = (
        partition(borough_time, borough=borough, year_month=month)
        .groupBy("pickup_hour")
        .agg(
            money(F.sum(F.col("sum_total_amount").cast("decimal(28,2)"))).alias("total_revenue"),
            F.round(F.sum("sum_passenger_count"), 0).alias("total_passengers"),
        )
    )
    return (
        hours.join(by_hour, "pickup_hour", "left")
        .na.fill(0.0, ["total_revenue", "total_passengers"])
        .orderBy("pickup_hour")
    )


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def route_stats(
    route: DataFrame, pickup_location_id: int, month: str, limit: int | None = None
) -> DataFrame:
    averages = ["trip_distance", "duration", "fare_amount", "tip_amount", "passenger_count"]
    here = partition(route, pickup_location_id=pickup_location_id, year_month=month)
    return (
        _first(here.orderBy(*ROLLUPS["route"].order()), limit)
        .select(
            "pickup_location_id",
            "pickup_zone",
            "dropoff_location_id",
            "dropoff_zone",
            "year_month",
            "pickup_date",
            *[zero_if_null(F.col(f"avg_{a}")).alias(f"avg_{a}") for a in averages],
        )
    )


def vendor_performance(
    vendor: DataFrame, vendor_id: int, borough: str, month: str, limit: int | None = None
) -> DataFrame:
    measures = ["sum_passenger_count", "avg_trip_distance", "sum_total_amount", "sum_tip_amount"]
    here = partition(vendor, vendor_id=vendor_id, borough=borough, year_month=month)
    return (
        _first(here.orderBy(*ROLLUPS["vendor"].order()), limit)
        .select(
            *ROLLUPS["vendor"].pk,
            *[zero_if_null(F.col(m)).alias(m) for m in measures],
            "trip_count",
        )
    )


def vendor_summary(performance: DataFrame) -> DataFrame:
    """Totals over the rows given. Rollup rows and the trips behind them are counted apart."""
    revenue = F.sum(F.col("sum_total_amount").cast("decimal(28,2)")).cast("double")
    return performance.agg(
        F.round(F.coalesce(revenue, F.lit(0.0)), 2).alias("total_revenue"),
        F.count("*").alias("rollup_rows"),
        F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trips"),
        F.round(F.coalesce(F.try_divide(revenue, F.count("*")), F.lit(0.0)), 2).alias(
            "avg_revenue_per_row"
        ),
    )


def payment_mix(borough_time: DataFrame, borough: str, month: str) -> DataFrame:
    """Trips per way of payment with their share of all counted trips."""
    names = list(PAYMENT_CODES)
    here = partition(borough_time, borough=borough, year_month=month)
    totals = here.agg(
        *[F.coalesce(F.sum(f"count_payment_{n}"), F.lit(0)).alias(n) for n in names]
    )
    everything = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return (
        totals.withColumn("total", everything)
        .unpivot("total", names, "payment_type", "count")
        .select(
            "payment_type",
            "count",
            F.when(F.col("total") > 0, F.round(F.col("count") / F.col("total") * 100, 2))
            .otherwise(F.lit(0.0))
            .alias("percentage"),
        )
    )


def _revenue() -> Column:
    return money(F.sum(F.col("sum_total_amount").cast("decimal(28,2)"))).alias("total_revenue")


def partition_revenue(borough_time: DataFrame, borough: str, month: str) -> DataFrame:
    return partition(borough_time, borough=borough, year_month=month).agg(_revenue())


def partition_revenue_by_hour(borough_time: DataFrame, borough: str, month: str) -> DataFrame:
    here = partition(borough_time, borough=borough, year_month=month)
    return here.groupBy("pickup_hour").agg(_revenue())


def revenue_by_borough(borough_time: DataFrame, month: str) -> DataFrame:
    return partition(borough_time, year_month=month).groupBy("borough", "year_month").agg(_revenue())


def pickup_locations(route: DataFrame, month: str) -> DataFrame:
    locations = partition(route, year_month=month).select("pickup_location_id").distinct()
    return locations.orderBy("pickup_location_id")


def zones_with_routes(pickup_zone: DataFrame, route: DataFrame, borough: str, month: str) -> DataFrame:
    """Revenue of each zone of a borough next to the routes that start there.

    The zone hours are added up first, so every route meets one row.
    """
    zones = (
        partition(pickup_zone, borough=borough, year_month=month)
        .groupBy("pickup_zone", "year_month")
        .agg(_revenue().alias("zone_revenue"), F.sum("trip_count").alias("zone_trips"))
    )
    return partition(route, year_month=month).join(zones, ["pickup_zone", "year_month"])


def best_hours(revenue_view: DataFrame, borough: str, limit: int = 100) -> DataFrame:
    here = partition(revenue_view, borough=borough)
    return here.orderBy(
        F.desc("sum_total_amount"), "year_month", "pickup_date", "pickup_hour"
    ).limit(limit)
