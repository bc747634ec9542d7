"""Trips, zones and messages derived from the given star-schema tables.

The mapping is the one in FIXTURES.md: integer arithmetic and decimals only, so any engine gives
the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import EVENT
from farebox.session import written

_DDL = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, "
    "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": EVENT,
}

_PICKUP_SECOND = "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709) % 86400"
_RIDE_SECONDS = "(l_partkey * 31 + l_orderkey * 17) % 3600 - 20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_DDL[name]).parquet(f"{sf_dir}/{name}.parquet")


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Give every core work when the given file is one row group, which no split size divides.

    The rows are the same either way; a scan with more splits than cores passes through.
    """
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    number = (F.col("n_nationkey") + 1).cast("int")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        number.alias("OBJECTID"),
        (number * 10).cast("double").alias("Shape_Leng"),
        (number * 7).cast("double").alias("Shape_Area"),
        F.col("n_name").alias("zone"),
        number.alias("LocationID"),
        F.col("r_name").alias("borough"),
        F.lit("Polygon").alias("geometry_type"),
    )


def zone_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unclean zone table, one row per supplier: zero ids, repeated ids, rows without any id."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("s_suppkey").cast("int")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.when(key % 5 == 0, 0).when(key % 5 == 1, key + 1).otherwise(key).alias("LocationID"),
            F.when(key % 15 == 0, 0).otherwise(key).alias("OBJECTID"),
            F.col("s_name").alias("zone"),
            F.col("r_name").alias("borough"),
            F.col("n_name").alias("geometry"),
            key.alias("seq"),
        )
    )


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unenriched trip per line item, with a shipping year to name its source file by."""
    lineitem = _spread(spark, table(spark, sf_dir, "lineitem"))
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # The narrow sides meet first, so that only one shuffle carries the line items where nothing broadcasts;
    # written down, Catalyst knows their size.
    ordered_by = written(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey"))
    joined = lineitem.join(ordered_by, F.col("l_orderkey") == F.col("o_orderkey")).join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return joined.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE))"
        " AS trip_id",
        "CASE WHEN l_partkey % 101 = 0 THEN 'bad-date' ELSE CAST(l_shipdate"
        f" + make_dt_interval(0, 0, 0, {_PICKUP_SECOND}) AS STRING) END AS tpep_pickup_datetime",
        f"CAST(l_shipdate + make_dt_interval(0, 0, 0, {_PICKUP_SECOND} + {_RIDE_SECONDS}) AS STRING)"
        " AS tpep_dropoff_datetime",
        "CAST(CASE WHEN (l_orderkey + l_partkey) % 199 = 0 THEN 999 ELSE s_nationkey + 1 END AS INT)"
        " AS PULocationID",
        "CAST(CASE WHEN (l_orderkey + l_partkey) % 211 = 0 THEN NULL ELSE c_nationkey + 1 END"
        " AS INT) AS DOLocationID",
        "CAST(1 + l_linenumber % 2 AS INT) AS VendorID",
        "CAST(1 + l_suppkey % 6 AS INT) AS RatecodeID",
        "CAST(1 + l_partkey % 6 AS INT) AS payment_type",
        "CASE WHEN l_partkey % 97 = 0 THEN NULL"
        " ELSE CAST((l_orderkey + l_linenumber) % 7 AS DOUBLE) END AS passenger_count",
        "(l_quantity - 1) / 2.0D AS trip_distance",
        "CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 ELSE 1 END"
        " * CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS fare_amount",
        "CAST(CASE WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN -1 ELSE 1 END"
        " * CAST(l_discount AS DECIMAL(4,2)) * CAST(l_quantity AS DECIMAL(4,0)) AS DECIMAL(12,2))"
        " AS tip_amount",
        "CAST(1.0 AS DECIMAL(12,2)) AS extra",
        "CAST(0.5 AS DECIMAL(12,2)) AS mta_tax",
        "CAST(l_linenumber AS DECIMAL(12,2)) AS tolls_amount",
        "CAST(0.3 AS DECIMAL(12,2)) AS improvement_surcharge",
        "CAST(CASE WHEN l_linenumber = 2 THEN 2.5 ELSE 0 END AS DECIMAL(12,2)) AS congestion_surcharge",
        "CAST(CASE WHEN l_suppkey % 10 = 0 THEN 1.75 END AS DECIMAL(12,2)) AS Airport_fee",
        "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag",
        "concat('trips_', year(l_shipdate)) AS stem",
    ).withColumn(
        "total_amount",
        (
            F.col("fare_amount")
            + F.col("extra")
            + F.col("mta_tax")
            + F.col("tip_amount")
            + F.col("tolls_amount")
        ).cast("decimal(14,2)"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
