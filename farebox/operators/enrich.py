"""Zone enrichment, message encoding, record validation and stamping."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.sources.zones import one_per_id

_SIDES = {"PULocationID": "pu", "DOLocationID": "do"}


def _with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join both ends of the trip to the zone table.

    No broadcast hint: Catalyst broadcasts the zones while their size is below its threshold and
    falls back to a sort-merge join, with skew splitting, above it.
    """
    packed = one_per_id(zones).select(F.col("LocationID").alias("zone_key"), F.struct("*").alias("zone_row"))
    for column, side in _SIDES.items():
        hit = packed.select(
            F.col("zone_key").alias(f"{side}_key"), F.col("zone_row").alias(f"{side}_zone")
        )
        trips = trips.join(hit, F.col(column) == F.col(f"{side}_key"), "left").drop(f"{side}_key")
    return trips


def enrich(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Replace both zone ids by the zone's record.

    An id the zone table does not hold becomes a record with only that id, a null id stays null.
    """
    joined = _with_zones(trips, zones)
    types = dict(zones.dtypes)
    for column, side in _SIDES.items():
        only_id = F.struct(
            *[
                F.col(column).cast(types[c]).alias(c)
                if c == "LocationID"
                else F.lit(None).cast(types[c]).alias(c)
                for c in zones.columns
            ]
        )
        joined = joined.withColumn(
            column,
            F.when(F.col(f"{side}_zone").isNotNull(), F.col(f"{side}_zone")).when(
                F.col(column).isNotNull(), only_id
            ),
        )
    return joined.drop("pu_zone", "do_zone")


def unresolved(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trip ends whose zone id the zone table does not hold."""
    ends = trips.select(
        "trip_id",
        F.explode(
            F.array(
                F.struct(F.lit("pickup").alias("side"), F.col("PULocationID").alias("location_id")),
                F.struct(F.lit("dropoff").alias("side"), F.col("DOLocationID").alias("location_id")),
            )
        ).alias("end"),
    ).select("trip_id", "end.*")
    return ends.filter(F.col("location_id").isNotNull()).join(
        zones.select(F.col("LocationID").alias("location_id")), "location_id", "left_anti"
    )


def to_messages(trips: DataFrame, zones: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Enrich and encode in one step: ``key``, JSON ``value`` and ``reason`` it would be refused
    for, next to the ``extra`` columns (which do not enter the JSON unless they are trip fields).

    The key is the pickup borough. A zone's JSON is built once per zone and joined in. Null fields
    are written as nulls, so the reader can tell a null from an absent key.
    """
    extra = extra or []
    fields = [c for c in trips.columns if c not in extra or c in ("trip_id", "producer_timestamp")]
    coded = one_per_id(zones).select(
        F.col("LocationID").alias("zone_key"),
        F.struct(
            "borough",
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"),
        ).alias("zone_row"),
    )
    for column, side in _SIDES.items():
        hit = coded.select(
            F.col("zone_key").alias(f"{side}_key"), F.col("zone_row").alias(f"{side}_zone")
        )
        trips = trips.join(hit, F.col(column) == F.col(f"{side}_key"), "left")

    def zone_json(column: str) -> Column:
        zone = F.col(f"{_SIDES[column]}_zone")
        only_id = F.to_json(F.struct(F.col(column).alias("LocationID")))
        return (
            F.when(zone.isNotNull(), zone["json"])
            .when(F.col(column).isNotNull(), only_id)
            .otherwise(F.lit("null"))
        )

    def has(side: str, name: str) -> Column:
        known = F.col(f"{side}_zone").isNotNull() & F.lit(name in zones.columns)
        return known | F.lit(name == "LocationID")

    # The zones are JSON already, so they go in front of the flat fields as they are.
    flat = F.to_json(
        F.struct(*[c for c in fields if c not in _SIDES]), {"ignoreNullFields": "false"}
    )
    ends = [x for c in _SIDES for x in (F.lit(f'"{c}":'), zone_json(c), F.lit(","))]
    value = F.concat(F.lit("{"), *ends, F.substring(flat, 2, 1 << 30))
    reason = _first_broken(
        F.col("PULocationID").isNotNull(),
        F.col("DOLocationID").isNotNull(),
        lambda name: has("pu", name),
        lambda name: has("do", name),
        lambda name: F.lit(name in fields),
    )
    return trips.select(
        F.col("pu_zone.borough").alias("key"),
        value.alias("value"),
        reason.alias("reason"),
        *extra,
    )


def _first_broken(pickup_is_object, dropoff_is_object, pickup_has, dropoff_has, has) -> Column:
    """The first rule a record breaks. Rules look at which keys are present, not at values."""
    # The reason texts, in the order the rules apply.
    rules = [
        (pickup_is_object, "Missing or invalid PULocationID"),
        (dropoff_is_object, "Missing or invalid DOLocationID"),
        *[(pickup_has(n), f"Missing PULocationID.{n}") for n in ("borough", "zone", "LocationID")],
        *[(dropoff_has(n), f"Missing DOLocationID.{n}") for n in ("zone", "LocationID")],
        *[
            (has(n), f"Missing field: {n}")
            for n in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "VendorID")
        ],
    ]
    return F.coalesce(*[F.when(~holds, F.lit(text)) for holds, text in rules])


def reject_reason(record: Column) -> Column:
    """Why a raw JSON record is refused, null when it is not.

    Each text is parsed once: the lambdas hold what they are given, where a plain expression would
    be repeated for every rule.
    """

    def keys(members: Column) -> Column:
        return F.struct(
            F.map_keys(members).alias("top"),
            F.json_object_keys(members["PULocationID"]).alias("pickup"),
            F.json_object_keys(members["DOLocationID"]).alias("dropoff"),
        )

    def among(names: Column):
        return lambda name: F.coalesce(F.array_contains(names, name), F.lit(False))

    def judge(k: Column) -> Column:
        return _first_broken(
            k["pickup"].isNotNull(),
            k["dropoff"].isNotNull(),
            among(k["pickup"]),
            among(k["dropoff"]),
            among(k["top"]),
        )

    members = F.array(F.from_json(record, "map<string,string>"))
    return F.element_at(F.transform(F.transform(members, keys), judge), 1)


# What a record that is not refused holds, as text. Where none of it is null, all keys are there.
_LEAVES = (
    "PULocationID STRUCT<borough: STRING, zone: STRING, LocationID: STRING>, DOLocationID STRUCT<zone: STRING, "
    "LocationID: STRING>, tpep_pickup_datetime STRING, tpep_dropoff_datetime STRING, VendorID STRING"
)


def _plainly_valid(record: Column, leaves: Column) -> Column:
    """Whether the leaves alone show that a record breaks no rule; never null.

    Of a repeated key they hold the last value and the rules look at the first. A zone's key comes once in a text
    without escapes that has its name only four times, as both zones have a LocationID.
    """
    ends = [leaves["PULocationID"][c] for c in ("borough", "zone", "LocationID")]
    ends += [leaves["DOLocationID"][c] for c in ("zone", "LocationID")]
    ends += [leaves[c] for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "VendorID")]
    once = F.octet_length(F.substring_index(record, "LocationID", 5)) == F.octet_length(record)
    return reduce(and_, [*[end.isNotNull() for end in ends], ~record.contains("\\"), once])


def validate(records: DataFrame, column: str = "value") -> DataFrame:
    """Adds ``reason`` and ``is_valid``; accepted and rejected are two filters on the latter.

    Most records have no null where a rule looks, and one decoding that skips all else shows it. The rest, about a
    percent of the records, is judged key by key.
    """
    leaves = max(records.columns, key=len) + "_"
    decoded = records.withColumn(leaves, F.from_json(column, _LEAVES))
    judged = F.when(~_plainly_valid(F.col(column), F.col(leaves)), reject_reason(F.col(column)))
    return decoded.withColumn("reason", judged).withColumn("is_valid", F.col("reason").isNull()).drop(leaves)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validated.filter("is_valid"), validated.filter("NOT is_valid")


def stamp(
    records: DataFrame, id_from: list[str] | None = None, sent_at: Column | None = None
) -> DataFrame:
    """Producer time in epoch ms and a 32-hex id.

    Live records get the wall clock and a random id; with ``id_from`` the id is the md5 of those
    columns, so a replay gives the same id again.
    """
    when = sent_at if sent_at is not None else F.current_timestamp()
    ident = (
        F.md5(F.concat_ws("|", *id_from)) if id_from else F.replace(F.uuid(), F.lit("-"), F.lit(""))
    )
    return records.withColumn(
        "producer_timestamp", F.unix_millis(when.cast("timestamp")).cast("double")
    ).withColumn("trip_id", ident)


def ingest_stats(checked: DataFrame, file_column: str) -> DataFrame:
    """Per source file and over all files (``ALL``): records read, sent, skipped, success rate.

    A row with a null ``record`` stands for a file that did not decode: it counts as a failed file
    and none of its records do.
    """
    read = F.col("record").isNotNull()
    counts = checked.groupBy(F.col(file_column).alias("source_file")).agg(
        F.count_if(read).alias("total_records"),
        F.count_if(read & F.col("is_valid")).alias("sent_records"),
        F.count_if(read & ~F.col("is_valid")).alias("skipped_records"),
        F.max((~read).cast("int")).cast("bigint").alias("files_failed"),
    )
    whole = F.col("files_failed") == 0
    names = ("total_records", "sent_records", "skipped_records")
    per_file = counts.withColumns({c: F.when(whole, F.col(c)).otherwise(0) for c in names})
    rolled = per_file.rollup("source_file").agg(
        *[F.sum(c).alias(c) for c in ("total_records", "sent_records", "skipped_records", "files_failed")],
        F.count("*").alias("files"),
    )
    return rolled.select(
        F.coalesce("source_file", F.lit("ALL")).alias("source_file"),
        "total_records",
        "sent_records",
        "skipped_records",
        (F.col("files") - F.col("files_failed")).alias("files_processed"),
        F.round(
            F.try_divide(F.col("sent_records") * F.lit(100.0), F.col("total_records")), 2
        ).alias("success_rate"),
    )
