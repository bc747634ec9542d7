"""Global order, windows, percentiles and reconciliation against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from farebox.operators import ordering, quality, windows


@pytest.fixture(scope="module")
def hot(spark):
    """Samples with one group and one value far more frequent than the others."""
    rnd = random.Random(5)
    rows = []
    for i in range(4000):
        group = "hot" if rnd.random() < 0.6 else f"g{rnd.randrange(6)}"
        value = 7.0 if rnd.random() < 0.3 else round(rnd.expovariate(0.05), 2)
        rows.append((i, group, value))
    rows += [(4000, "single", 3.5)] + [(4001 + i, "twenty", float(i)) for i in range(20)]
    return rows, spark.createDataFrame(rows, "i bigint, g string, ms double").repartition(7).persist()


def test_latency_summary(hot):
    rows, df = hot
    got = {r.g: r for r in quality.latency_summary(df, ["g"], "ms").collect()}
    groups = {}
    for _, g, ms in rows:
        groups.setdefault(g, []).append(ms)
    assert set(got) == set(groups)
    for g, values in groups.items():
        values.sort()
        n = len(values)
        assert got[g].samples == n
        assert got[g].p95_latency_ms == values[min(int(n * 0.95), n - 1)]
        assert got[g].p99_latency_ms == values[min(int(n * 0.99), n - 1)]
        assert got[g].max_latency_ms == values[-1]
        assert got[g].avg_latency_ms == pytest.approx(statistics.mean(values), abs=0.006)


def test_percentile_is_one_above_the_usual_place(hot):
    _, df = hot
    row = quality.latency_summary(df.filter("g = 'twenty'"), ["g"], "ms").first()
    assert row.p95_latency_ms == 19.0  # int(20 * 0.95) = 19


def test_position(hot):
    rows, df = hot
    got = ordering.with_position(df.select("g", "i"), "g", "i").orderBy("position").collect()
    assert [(r.g, r.i) for r in got] == sorted((g, i) for i, g, _ in rows)
    assert [r.position for r in got] == list(range(len(rows)))


def test_running_sums(hot):
    rows, df = hot
    exact = df.select("i", F.col("ms").cast("decimal(18,2)").alias("paid"))
    got = windows.running_totals(exact, "i", "paid").orderBy("i").collect()
    total = 0.0
    for n, (row, r) in enumerate(zip(got, sorted(rows)), 1):
        total = round(total + r[2], 2)
        assert row.total_trips == n and row.total_revenue == pytest.approx(total, abs=1e-6)


@pytest.mark.parametrize("n", [1, 2, 7, 500, 10**6])
def test_rolling(hot, n):
    rows, df = hot
    exact = df.select("i", F.col("ms").cast("decimal(18,2)").alias("ms"))
    got = windows.rolling_stats(exact, "i", "ms", n).orderBy("i").collect()
    values = [ms for _, _, ms in sorted(rows)]
    assert len(got) == len(values)
    for i in list(range(0, len(values), 97)) + [n - 2, n - 1, n, 2 * n - 1, len(values) - 1]:
        if 0 <= i < len(values):
            last = values[max(0, i - n + 1) : i + 1]
            assert got[i].max_value == max(last)
            assert got[i].avg_value == pytest.approx(sum(last) / len(last), abs=0.0051)


def test_trailing_rate(spark):
    rnd = random.Random(1)
    seconds = sorted(rnd.choice([rnd.randrange(600), 300 + rnd.randrange(3)]) for _ in range(3000))
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
    got = {r.second: r.trips_per_minute for r in windows.trailing_rate(df, "ts").collect()}
    assert set(got) == set(seconds)
    for s in got:
        assert got[s] == sum(s - 60 < x <= s for x in seconds)


def test_skew_of_one_partition(spark):
    one = spark.range(10).withColumn("k", F.lit("a"))
    row = quality.skew_summary(one, F.col("k")).first()
    assert (row.num_partitions, row.std_deviation, row.balance_score) == (1, 0.0, 100.0)


def test_buckets_without_rows_are_listed(spark):
    df = spark.range(10).withColumn("k", F.lit("a"))
    rows = quality.bucket_report(df, F.col("k"), 4, F.lit(8).cast("bigint")).collect()
    assert [r.bucket for r in rows] == [0, 1, 2, 3]
    assert sorted(r.documents for r in rows) == [0, 0, 0, 10]
    assert {r.band for r in rows} == {"high", "low"}
    assert quality.bucket_balance(df, F.col("k"), 4).first().balance_score == -200.0


def test_reconciliation(spark):
    wrote = spark.createDataFrame([(k,) for k in "aabcd"], "k string")
    read = spark.createDataFrame([(k,) for k in "abbbx"], "k string")
    assert {r.k for r in quality.missing_keys(wrote, read, "k").collect()} == {"c", "d"}
    assert {r.k for r in quality.key_difference(wrote, read, "k").collect()} == {"c", "d"}
    assert [tuple(r) for r in quality.duplicate_keys(read, "k", first=10).collect()] == [("b", 3)]
    row = quality.integrity(wrote, read, "k").first()
    assert (row.expected_records, row.found_records, row.duplicate_records, row.missing_records) == (4, 5, 2, 2)
    assert (row.data_integrity, row.rollup_integrity) == ("false", "ISSUES")
    row = quality.integrity(wrote.distinct(), wrote.distinct().filter("k <> 'd'"), "k").first()
    assert (row.data_integrity, row.rollup_integrity) == ("false", "OK")


def test_side_by_side(spark):
    a = spark.createDataFrame([("trips", 1.5), ("zones", 2.0)], "query string, ms double")
    b = spark.createDataFrame([("zones", 3.0), ("routes", 4.0)], "query string, ms double")
    got = {tuple(r) for r in quality.side_by_side(a, b, "query", "ms").collect()}
    assert got == {("Trips", 1.5, 0.0), ("Zones", 2.0, 3.0), ("Routes", 0.0, 4.0)}


def test_null_group_keeps_its_row(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    got = {r.g: (r.samples, r.avg_latency_ms, r.p95_latency_ms) for r in quality.latency_summary(df, ["g"], "v").collect()}
    assert got == {None: (2, 2.0, 3.0), "a": (1, 2.0, 2.0)}
