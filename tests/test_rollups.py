"""Rollup semantics: rejects, NaN, mergeable state, invariants, stored tables."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from farebox.operators import anomalies, rollups
from farebox.operators.rollups import ROLLUPS
from farebox.plans import analytics
from farebox.plans.workspace import Workspace
from farebox.sources.topic import decode_facts
from farebox.streaming import served, versions

BASE = {
    "trip_id": "t",
    "VendorID": 1,
    "RatecodeID": 1.0,
    "payment_type": 2,
    "tpep_pickup_datetime": "2024-01-05 07:59:59",
    "tpep_dropoff_datetime": "2024-01-05 08:10:00",
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "fare_amount": 10.1,
    "tip_amount": 0.2,
    "total_amount": 12.3,
    "mta_tax": 0.5,
    "PULocationID": {"borough": "Q", "zone": "A", "LocationID": 1},
    "DOLocationID": {"zone": "B", "LocationID": 2},
}


def facts(spark, *changes, drop=()):
    rows = []
    for change in changes or ({},):
        message = {k: v for k, v in {**BASE, **change}.items() if k not in drop}
        rows.append((bytearray(json.dumps(message).encode()), dt.datetime(2024, 1, 5)))
    return rollups.facts_from_messages(
        decode_facts(spark.createDataFrame(rows, "value binary, timestamp timestamp"))
    )


def view(df, name):
    rollup = ROLLUPS[name]
    return rollups.present(rollups.aggregate(rollups.accepted(df), rollup), rollup)


def test_keys_and_counters(spark):
    row = view(facts(spark), "borough_time").first()
    assert (row.borough, row.year_month, row.pickup_date, row.pickup_hour) == (
        "Q", "2024-01", dt.date(2024, 1, 5), 7
    )
    assert (row.count_rate_standard, row.count_payment_cash, row.count_vendor_cmt) == (1, 1, 1)
    assert (row.count_rate_jfk, row.count_payment_card, row.count_vendor_verifone) == (0, 0, 0)
    assert row.sum_total_amount == 12.3


def test_unknown_codes_are_not_counted(spark):
    row = view(facts(spark, {"VendorID": 6, "RatecodeID": 99.0, "payment_type": 0}), "borough_time").first()
    assert row.trip_count == 1
    assert not any(row[c] for c in row.asDict() if c.startswith("count_"))


def test_missing_number_is_zero(spark):
    row = view(facts(spark, drop=("tip_amount", "passenger_count")), "borough_time").first()
    assert (row.sum_tip_amount, row.sum_passenger_count, row.trip_count) == (0.0, 0.0, 1)


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"passenger_count": None}, "null passenger_count"),
        ({"total_amount": "abc"}, "null total_amount"),
        ({"tpep_pickup_datetime": "2024-01-05"}, "bad tpep_pickup_datetime"),
        ({"tpep_dropoff_datetime": None}, "bad tpep_dropoff_datetime"),
    ],
)
def test_rejects(spark, change, reason):
    df = facts(spark, {}, change)
    assert [tuple(r) for r in rollups.rejects(df).collect()] == [(reason, 1)]
    for name in ROLLUPS:
        assert view(df, name).agg(F.sum("trip_count")).first()[0] == 1


def test_numbers_as_text_convert(spark):
    assert view(facts(spark, {"fare_amount": "7.25"}), "borough_time").first().sum_fare_amount == 7.25


def test_nan_makes_its_sum_nan_and_no_other(spark):
    row = view(facts(spark, {}, {"fare_amount": math.nan}), "borough_time").first()
    assert math.isnan(row.sum_fare_amount) and row.sum_tip_amount == 0.4 and row.trip_count == 2
    state = rollups.aggregate(facts(spark, {}, {"trip_distance": math.nan}), ROLLUPS["route"])
    merged = rollups.merge(state.unionByName(state), ROLLUPS["route"])
    row = rollups.present(merged, ROLLUPS["route"]).first()
    assert math.isnan(row.avg_trip_distance) and row.avg_fare_amount == 10.1 and row.trip_count == 4


def test_mean_duration_is_cut_toward_zero(spark):
    ends = [{"tpep_dropoff_datetime": f"2024-01-05 07:59:{s}"} for s in (57, 58, 58)]
    assert view(facts(spark, *ends), "route").first().avg_duration == -1  # -4 / 3


def test_merging_parts_equals_one_pass(spark, sf_dir):
    ws = Workspace(spark, sf_dir)
    good = rollups.accepted(ws.facts())
    for rollup in ROLLUPS.values():
        parts = [rollups.aggregate(good.filter(F.hash("trip_id") % 3 == k), rollup) for k in (-2, -1, 0, 1, 2)]
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part)
        merged, whole = rollups.merge(union, rollup), rollups.aggregate(good, rollup)
        assert merged.exceptAll(whole.select(merged.columns)).count() == 0
        assert merged.count() == whole.count()


def test_invariants(spark, sf_dir):
    ws = Workspace(spark, sf_dir)
    trips = rollups.accepted(ws.facts()).count()
    for name in ROLLUPS:
        assert ws.state(name).agg(F.sum("trip_count")).first()[0] == trips
    keys = ["borough", "year_month", "pickup_date", "pickup_hour"]
    sums = ["sum_fare_amount", "sum_total_amount", "sum_tip_amount", "sum_passenger_count"]
    zone = ws.state("pickup_zone").groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
    hour = ws.state("borough_time").select(*keys, *sums)
    assert zone.exceptAll(hour).count() == 0 and hour.exceptAll(zone).count() == 0


def live_files(spark, table):
    return {str(f) for s in versions.current(spark, str(table)).segments for f in (table / s["path"]).rglob("*.parquet")}


@pytest.mark.parametrize("rows_per_range", [1, 100_000])
def test_upsert_replaces_rows_and_leaves_other_ranges(spark, sf_dir, tmp_path, rows_per_range):
    ws, rollup = Workspace(spark, sf_dir), ROLLUPS["borough_time"]
    state, table = ws.state("borough_time"), tmp_path / "t"
    made = served.upsert(spark, str(table), state, rollup, rows_per_range)
    assert made == state.select("year_month", *(["borough"] if rows_per_range == 1 else [])).distinct().count()
    month = state.filter("year_month = '1998-03'")
    one = month.orderBy(*rollup.pk).limit(1).withColumn("trip_count", F.lit(777).cast("bigint"))
    fresh = one.withColumn("borough", F.lit("NEW"))
    for _ in range(2):  # the second time changes nothing
        before = live_files(spark, table)
        written = served.upsert(spark, str(table), one.unionByName(fresh), rollup, rows_per_range)
        assert written <= 3 and len(before - live_files(spark, table)) <= 3
        now = served.read(spark, str(table), state.schema)
        assert now.count() == state.count() + 1
        assert now.filter("trip_count = 777").count() == 2
        assert now.join(one.select(*rollup.pk), rollup.pk).count() == 1
    rest = now.filter("trip_count <> 777").exceptAll(state.select(now.columns))
    assert rest.count() == 0


@pytest.mark.parametrize("rows_per_range", [1, 100_000])
def test_delete_writes_one_range(spark, sf_dir, tmp_path, rows_per_range):
    ws, rollup = Workspace(spark, sf_dir), ROLLUPS["pickup_zone"]
    state, table = ws.state("pickup_zone"), tmp_path / "t"
    served.upsert(spark, str(table), state, rollup, rows_per_range)
    month, borough = state.groupBy("year_month", "borough").count().orderBy(F.desc("count")).first()[:2]
    before = live_files(spark, table)
    served.delete(spark, str(table), F.col("borough") == borough, rollup, month, rows_per_range)
    gone = (F.col("borough") == borough) & (F.col("year_month") == month)
    left, want = served.read(spark, str(table), state.schema), state.filter(~gone)
    assert left.count() == want.count() < state.count() and left.exceptAll(want.select(left.columns)).count() == 0
    assert len(before - live_files(spark, table)) == 1
    assert served.delete(spark, str(table), F.col("borough") == borough, rollup, month, rows_per_range) == 0
    # A key of the deleted range comes back into a neighbour.
    served.upsert(spark, str(table), state.filter(gone), rollup, rows_per_range)
    assert served.read(spark, str(table), state.schema).count() == state.count()


def test_dense_hours_and_zero_filled_labels(spark, sf_dir):
    ws = Workspace(spark, sf_dir)
    hours = analytics.hourly_performance(ws.rollup("borough_time"), "NOWHERE", "1998-03").collect()
    assert [tuple(r) for r in hours] == [(h, 0.0, 0.0) for h in range(24)]
    none = spark.createDataFrame([], "anomaly_type string")
    assert [r.n for r in anomalies.label_counts(none).collect()] == [0] * 5
    mix = analytics.payment_mix(ws.rollup("borough_time"), "NOWHERE", "1998-03").collect()
    assert [(r["count"], r.percentage) for r in mix] == [(0, 0.0)] * 6
    rows = analytics.vendor_performance(ws.rollup("vendor"), 9, "NOWHERE", "1998-03")
    assert tuple(analytics.vendor_summary(rows).first()) == (0.0, 0, 0, 0.0)


def test_limit_keeps_the_first_anomalies_in_source_order(spark, sf_dir):
    ws = Workspace(spark, sf_dir)
    tables = [ws.rollup(n) for n in ("borough_time", "pickup_zone", "route")]
    all_rows = anomalies.month_rollup_anomalies(*tables, "ASIA", "1998-03")
    some = anomalies.month_rollup_anomalies(*tables, "ASIA", "1998-03", limit=5)
    ordered = [r.row_key for r in all_rows.orderBy("source_order", "row_key").collect()]
    assert [r.row_key for r in some.orderBy("source_order", "row_key").collect()] == ordered[:5]


def test_nothing_is_cut(spark):
    """More rows than the 10, 50, 100 and 500 that limits once let through."""
    spent = {"VendorID": 1, "total_amount": -1.0, "fare_amount": -1.0}
    zones = [{"borough": "Q", "zone": f"z{i}", "LocationID": i} for i in range(130)]
    rows = [{**spent, "trip_id": z["zone"], "PULocationID": z} for z in zones]
    df = facts(spark, *rows)
    shown = analytics.vendor_performance(view(df, "vendor"), 1, "Q", "2024-01")
    assert shown.count() == 130
    total = analytics.vendor_summary(shown).first()
    assert (total.total_revenue, total.rollup_rows, total.trips) == (-130.0, 130, 130)
    assert analytics.vendor_performance(view(df, "vendor"), 1, "Q", "2024-01", limit=50).count() == 50
    assert analytics.pickup_locations(view(df, "route"), "2024-01").count() == 130
    assert anomalies.route_sample(view(df, "route"), "2024-01").count() == 130
    times = [f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00" for i in range(130)]
    hours = facts(spark, *[{"tpep_pickup_datetime": t, "total_amount": -1.0} for t in times])
    tables = [view(hours, name) for name in ("borough_time", "pickup_zone", "route")]
    found = anomalies.month_rollup_anomalies(*tables, "Q", "2024-01")
    assert found.filter("source_order = 1").count() == 130
    assert analytics.rollup_lookup(view(hours, "borough_time"), "Q", "2024-01").count() == 130


def test_rates_are_not_clamped(spark):
    from farebox.operators import windows

    arrivals = spark.range(1500).select(F.timestamp_seconds(F.lit(60)).alias("ts"))
    assert [r.trips_per_minute for r in windows.trailing_rate(arrivals, "ts").collect()] == [1500]


@pytest.mark.parametrize(
    "fares, total",
    [
        ((1e300,), 1e300),
        ((1e300, 1e300, 1.5), 2e300),
        ((math.inf, 1.0), math.inf),
        ((-math.inf, 1.0), -math.inf),
        ((math.inf, math.inf), math.inf),
        ((math.inf, -math.inf), math.nan),
        ((1e15, 0.25), 1e15 + 0.25),
        ((999999999999999.0, 0.000000001), 1e15 - 1 + 0.000000001),
    ],
)
def test_odd_numbers_neither_saturate_nor_stop(spark, fares, total):
    odd = [{"fare_amount": json.loads(json.dumps(f)) if math.isfinite(f) else str(f)} for f in fares]
    state = rollups.aggregate(rollups.accepted(facts(spark, *odd, {"trip_id": "u"})), ROLLUPS["pickup_zone"])
    for df in (state, rollups.merge(state, ROLLUPS["pickup_zone"])):
        row = df.select(rollups.total("fare_amount").alias("t"), rollups.total("tip_amount").alias("tip"), "trip_count").first()
        assert row.tip == pytest.approx(0.2 * (len(fares) + 1)) and row.trip_count == len(fares) + 1
        assert math.isnan(row.t) if math.isnan(total) else row.t == pytest.approx(total + 10.1, rel=1e-15)


def test_digits_past_the_sixth_stay(spark):
    row = view(facts(spark, {"trip_distance": 1.0000004}, {"trip_distance": 1.00000049}), "route").first()
    assert row.avg_trip_distance == pytest.approx(1.000000445, abs=1e-12)


def test_upsert_replaces_rows_with_null_keys(spark, tmp_path):
    rollup, table = ROLLUPS["vendor"], str(tmp_path / "t")
    df = facts(spark, {"VendorID": None}, {"VendorID": 1})
    state = rollups.aggregate(df, rollup)
    served.upsert(spark, table, state, rollup)
    for _ in range(2):
        served.upsert(spark, table, state.filter("vendor_id IS NULL").withColumn("trip_count", F.lit(9).cast("long")), rollup)
        now = served.read(spark, table, state.schema)
        assert sorted((r.vendor_id or 0, r.trip_count) for r in now.collect()) == [(0, 9), (1, 1)]
