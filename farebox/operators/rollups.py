"""The four pre-aggregated tables.

A rollup is kept as *state*: its keys, a trip count, sums and code counters. State rows with the
same key add up, whatever batch or partition they come from, so batch and streaming share the code
and a partial aggregation always runs before the shuffle. Averages are derived when a rollup is
read.

A number within ``REACH`` is cut into its whole part and nine places, both added up as longs: exact in any
order, and the sums run over only after nine thousand million trips with one key. State holds the two as
one decimal. Larger numbers, infinities and NaN are added up beside it as doubles, in ``wild_`` columns
that are 0 otherwise; the two make the total, so one odd trip neither spoils other sums nor stops the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.counts import counter_names, counters
from farebox.functions.scalars import parse_time, seconds_between, year_month
from farebox.schemas import NUMBERS
from farebox.sources.topic import absent

REACH = 1e9
#: Numbers up to here keep nine places when a double takes off their whole part.
_CLOSE = 2.0**20
_SUM = "decimal(34,9)"


@dataclass(frozen=True)
class Rollup:
    name: str
    # Primary key, the two parts of it: which partition, and the order inside it.
    partition: tuple[str, ...]
    clustering: tuple[tuple[str, str], ...]
    # Columns that follow from the key.
    carried: tuple[str, ...]
    sums: tuple[str, ...]
    averages: tuple[str, ...]
    families: tuple[str, ...]

    @property
    def pk(self) -> list[str]:
        return [*self.partition, *[c for c, _ in self.clustering]]

    @property
    def keys(self) -> list[str]:
        return [*self.pk, *self.carried]

    @property
    def measures(self) -> list[str]:
        return sorted({*self.sums, *self.averages})

    @property
    def state(self) -> list[str]:
        sums = [f"sum_{m}" for m in self.measures]
        return ["trip_count", *sums, *self.wild, *counter_names(*self.families)]

    @property
    def wild(self) -> list[str]:
        return [f"wild_{m}" for m in self.measures if m in NUMBERS]

    def order(self) -> list[Column]:
        """Clustering order inside a partition."""
        return [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in self.clustering]


ROLLUPS = {
    r.name: r
    for r in (
        Rollup(
            "borough_time",
            ("borough", "year_month"),
            (("pickup_date", "asc"), ("pickup_hour", "asc")),
            (),
            ("passenger_count", "fare_amount", "mta_tax", "tip_amount", "total_amount"),
            (),
            ("rate", "payment", "vendor"),
        ),
        Rollup(
            "pickup_zone",
            ("borough", "year_month"),
            (("pickup_date", "asc"), ("pickup_hour", "asc"), ("pickup_zone", "asc")),
            (),
            ("passenger_count", "fare_amount", "tip_amount", "total_amount"),
            ("trip_distance",),
            ("payment", "vendor"),
        ),
        Rollup(
            "route",
            ("pickup_location_id", "year_month"),
            (("dropoff_location_id", "asc"), ("pickup_date", "desc")),
            ("pickup_zone", "dropoff_zone"),
            (),
            ("trip_distance", "duration", "fare_amount", "tip_amount", "passenger_count"),
            ("payment",),
        ),
        Rollup(
            "vendor",
            ("vendor_id", "borough", "year_month"),
            (("pickup_date", "desc"), ("pickup_location_id", "asc")),
            (),
            ("passenger_count", "total_amount", "tip_amount", "mta_tax"),
            ("trip_distance",),
            ("payment",),
        ),
    )
}


def facts_from_trips(trips: DataFrame) -> DataFrame:
    """Trip facts from the trip table; ``bad`` names the field that keeps a trip out, if any."""
    null_field = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in NUMBERS])
    flat = trips.select(
        "trip_id",
        "borough",
        "pickup_zone",
        "dropoff_zone",
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        F.col("VendorID").alias("vendor_id"),
        F.col("RatecodeID").alias("rate_code"),
        "payment_type",
        "pickup_ts",
        "dropoff_ts",
        *NUMBERS,
        null_field.alias("bad_number"),
    )
    return facts_of(timed(flat))


def facts_from_messages(decoded: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """Trip facts from decoded messages, with ``more`` columns of them."""
    return facts_of(timed(flat_messages(decoded, more)))


def flat_messages(decoded: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """What the facts of decoded messages are made of, and ``more`` columns.

    A number that is absent counts as 0; one that is null or does not convert keeps the trip out. Of messages
    decoded with numbers as numbers only those that are null are looked at as text.
    """
    read = "texts" in decoded.columns

    def number(name: str) -> Column:
        # A bare NaN comes back in quotes.
        text = F.btrim(F.col(f"texts.{name}" if read else f"msg.{name}"), F.lit('"'))
        other = F.when(absent(name), F.lit(0.0)).otherwise(text.try_cast("double"))
        return F.coalesce(F.col(f"msg.{name}"), other) if read else other

    null_field = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in NUMBERS])
    flat = decoded.select(
        "msg.trip_id",
        F.col("msg.PULocationID.borough").alias("borough"),
        F.col("msg.PULocationID.zone").alias("pickup_zone"),
        F.col("msg.DOLocationID.zone").alias("dropoff_zone"),
        F.col("msg.PULocationID.LocationID").alias("pickup_location_id"),
        F.col("msg.DOLocationID.LocationID").alias("dropoff_location_id"),
        F.col("msg.VendorID").cast("int").alias("vendor_id"),
        F.col("msg.RatecodeID").cast("int").alias("rate_code"),
        F.col("msg.payment_type").cast("int").alias("payment_type"),
        parse_time(F.col("msg.tpep_pickup_datetime")).alias("pickup_ts"),
        parse_time(F.col("msg.tpep_dropoff_datetime")).alias("dropoff_ts"),
        *[number(c).alias(c) for c in NUMBERS],
        *[column.alias(name) for name, column in (more or {}).items()],
    )
    return flat.withColumn("bad_number", null_field)


def timed(flat: DataFrame) -> DataFrame:
    """Flat columns with what follows from their times, and what keeps the trip out."""
    bad_time = F.when(F.col("pickup_ts").isNull(), F.lit("bad tpep_pickup_datetime")).when(
        F.col("dropoff_ts").isNull(), F.lit("bad tpep_dropoff_datetime")
    )
    return flat.select(
        *[c for c in flat.columns if c != "bad_number"],
        F.coalesce(bad_time, F.col("bad_number")).alias("bad"),
        F.to_date("pickup_ts").alias("pickup_date"),
        F.hour("pickup_ts").alias("pickup_hour"),
        seconds_between(F.col("pickup_ts"), F.col("dropoff_ts")).alias("duration"),
    )


def facts_of(trips: DataFrame) -> DataFrame:
    """Trip facts from flat columns with times, numbers cut into their parts."""
    return trips.select(
        *[c for c in trips.columns if c not in NUMBERS],
        *[part for c in NUMBERS for part in _parts(c)],
        year_month(F.col("pickup_date")).alias("year_month"),
    )


def _parts(name: str) -> list[Column]:
    """A number as its whole part, its billionths, and what is beyond reach."""
    value = F.col(name).cast("double")
    # NaN is above every number here.
    tame = F.abs(value) < REACH
    whole = F.floor(value)
    # Half up, as ``round`` does by way of a decimal.
    near = F.floor((value - whole) * 1e9 + 0.5)
    far = ((F.col(name).cast("decimal(24,9)") - whole) * 1_000_000_000).cast("long")
    return [
        F.when(tame, whole).otherwise(F.lit(0).cast("long")).alias(f"whole_{name}"),
        F.when(F.abs(value) < _CLOSE, near).when(tame, far).otherwise(F.lit(0).cast("long")).alias(f"parts_{name}"),
        F.when(tame, 0.0).otherwise(value).alias(f"wild_{name}"),
    ]


def _sum(measure: str) -> Column:
    if measure not in NUMBERS:
        return F.sum(measure)
    whole, parts = F.sum(f"whole_{measure}"), F.sum(f"parts_{measure}")
    return (whole.cast(_SUM) + parts.cast("decimal(20,0)") / 1_000_000_000).cast(_SUM)


def accepted(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("bad").isNull())


def rejects(facts: DataFrame) -> DataFrame:
    """How many trips each unconvertible field keeps out of the rollups."""
    return (
        facts.filter(F.col("bad").isNotNull())
        .groupBy(F.col("bad").alias("reason"))
        .agg(F.count("*").alias("rejected"))
    )


def aggregate(facts: DataFrame, rollup: Rollup, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """State rows of a rollup from accepted trip facts."""
    return facts.groupBy(*rollup.keys, *extra_keys).agg(
        F.count("*").alias("trip_count"),
        *[_sum(m).alias(f"sum_{m}") for m in rollup.measures],
        *[F.sum(w).alias(w) for w in rollup.wild],
        *counters(*rollup.families),
    )


def merge(states: DataFrame, rollup: Rollup) -> DataFrame:
    """Add up state rows that share a key."""
    kept = dict(states.dtypes)
    return states.groupBy(*rollup.keys).agg(
        *[F.sum(c).cast(kept[c]).alias(c) for c in rollup.state]
    )


def total(measure: str) -> Column:
    """A state's sum as the number it stands for."""
    held = F.col(f"sum_{measure}").cast("double")
    return held if measure == "duration" else held + F.col(f"wild_{measure}")


def present(state: DataFrame, rollup: Rollup) -> DataFrame:
    """The rollup as its readers see it: sums as doubles, averages derived, dates as dates."""

    def average(measure: str) -> Column:
        mean = total(measure) / F.col("trip_count")
        # The duration average is a whole number of seconds, cut toward zero.
        return (mean.cast("int") if measure == "duration" else mean).alias(f"avg_{measure}")

    return state.select(
        *rollup.keys,
        *[F.round(total(m), 2).alias(f"sum_{m}") for m in rollup.sums],
        *[average(m) for m in rollup.averages],
        *counter_names(*rollup.families),
        "trip_count",
    )


def revenue_view(state: DataFrame) -> DataFrame:
    """Revenue by borough, best hours first."""
    return state.filter(
        F.col("borough").isNotNull()
        & F.col("year_month").isNotNull()
        & F.col("pickup_date").isNotNull()
        & F.col("pickup_hour").isNotNull()
        & F.col("sum_total_amount").isNotNull()
    ).select(
        "borough",
        F.round(total("total_amount"), 2).alias("sum_total_amount"),
        "year_month",
        "pickup_date",
        "pickup_hour",
    )


def time_view(state: DataFrame) -> DataFrame:
    """Revenue and passengers by day, hours in order."""
    return state.filter(
        F.col("borough").isNotNull()
        & F.col("year_month").isNotNull()
        & F.col("pickup_date").isNotNull()
        & F.col("pickup_hour").isNotNull()
    ).select(
        "year_month",
        "pickup_date",
        "pickup_hour",
        "borough",
        F.round(total("total_amount"), 2).alias("sum_total_amount"),
        total("passenger_count").alias("sum_passenger_count"),
    )
