"""The zone dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def geometry_type(geometry: Column) -> Column:
    """The kind of shape, from GeoJSON or from well-known text; null for anything else."""
    named = F.regexp_extract(geometry, r"(?i)^\s*(?:SRID=\d+;)?\s*([A-Za-z]+)\s*(?:Z|M|ZM)?\s*(?:\(|EMPTY)", 1)
    known = {k.upper(): k for k in _SHAPES}
    by_name = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[F.upper(named)]
    return F.coalesce(F.get_json_object(geometry, "$.type"), by_name)


def one_per_id(zones: DataFrame) -> DataFrame:
    """One row per ``LocationID``, so that a join to it never multiplies the other side.

    A table that repeats an id keeps the row that sorts last by all its columns; to keep the last one
    in some order, pass it through ``zone_dim`` first. Rows without an id go.
    """
    rest = [c for c in zones.columns if c != "LocationID"]
    kept = zones.filter(F.col("LocationID").isNotNull()).groupBy("LocationID").agg(F.max(F.struct(*rest)).alias("row"))
    return kept.select(*[F.col("LocationID") if c == "LocationID" else F.col("row").getField(c).alias(c) for c in zones.columns])


# Fixed values.
_SHAPES = "Point LineString Polygon MultiPoint MultiLineString MultiPolygon GeometryCollection".split()
_ID_COLUMNS = ["LocationID", "location_id", "OBJECTID"]


def zone_dim(zones: DataFrame, order_by: str) -> DataFrame:
    """One row per zone id; the id is the first of the id columns that is neither null nor zero.

    Rows without an id are dropped, the last row in ``order_by`` wins when an id repeats, and a
    geometry column is not carried.
    """
    present = {name: name for name in zones.columns}
    # Column names differ by case only in part of the sources; keep exact matches.
    ids = [F.nullif(F.col(f"`{present[c]}`"), F.lit(0)) for c in _ID_COLUMNS if c in present]
    if "geometry" in zones.columns and "geometry_type" not in zones.columns:
        zones = zones.withColumn("geometry_type", geometry_type(F.col("geometry")))
    attributes = [c for c in zones.columns if c not in ("geometry", order_by)]
    return (
        zones.withColumn("zone_key", F.coalesce(*ids).cast("int"))
        .filter(F.col("zone_key").isNotNull())
        .groupBy("zone_key")
        .agg(F.max_by(F.struct(*attributes), F.col(order_by)).alias("zone_row"))
        .select("zone_key", "zone_row.*")
    )
