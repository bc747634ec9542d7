"""Scalar column expressions. Built-in functions only, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.schemas import KM_TO_MILES, MILES_TO_KM

_TIME_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_BYTE_UNITS = ["Bytes", "KB", "MB", "GB", "TB"]


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp, null when it does not parse."""
    return F.when(text.rlike(_TIME_SHAPE), text.try_cast("timestamp_ntz"))


def parse_time_strict(text: Column) -> Column:
    """As parse_time, but bad text fails the query (null text stays null)."""
    return F.when(
        text.isNull() | text.rlike(_TIME_SHAPE), text.cast("timestamp_ntz")
    ).otherwise(F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp_ntz"))


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def six_hour_bucket(date: Column, hour: Column) -> Column:
    block = F.lpad(F.floor(hour / 6).cast("string"), 2, "0")
    return F.concat(date.cast("string"), F.lit("-"), block)


def md5_bucket(text: Column, buckets: int) -> Column:
    """First 32 bits of the md5, modulo ``buckets``."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def short_id(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 8)


def divide_or(numerator: Column, denominator: Column, default=None) -> Column:
    """numerator / denominator where the denominator is above zero, else ``default``."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(default))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def not_nan(value: Column) -> Column:
    """NaN as null: Spark sorts NaN above all numbers, the detectors must not see it that way."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def capitalize(text: Column) -> Column:
    rest = F.substring(text, 2, 1 << 30)
    return F.when(F.length(text) > 0, F.concat(F.upper(F.left(text, F.lit(1))), rest)).otherwise(
        F.lit("")
    )


def strip_percent(text: Column) -> Column:
    """``"12.5%"`` to 12.5; blank text is 0; anything else that is no number is null."""
    bare = F.trim(F.replace(text, F.lit("%"), F.lit("")))
    return F.when(bare == "", F.lit(0.0)).otherwise(bare.try_cast("double"))


def format_bytes(size: Column) -> Column:
    """Human form in steps of 1024 with at most two decimals, ``0 Bytes`` for zero."""
    power = F.when(size < 1024, 0)
    for step in range(1, len(_BYTE_UNITS) - 1):
        power = power.when(size < 1024 ** (step + 1), step)
    power = power.otherwise(len(_BYTE_UNITS) - 1)
    scaled = F.round(size / F.pow(F.lit(1024.0), power), 2)
    # Whole numbers print without a fraction, others without trailing zeros.
    text = F.when(
        scaled == F.floor(scaled), F.floor(scaled).cast("string")
    ).otherwise(scaled.cast("string"))
    unit = F.element_at(F.array(*[F.lit(u) for u in _BYTE_UNITS]), (power + 1).cast("int"))
    return F.when(size == 0, F.lit("0 Bytes")).otherwise(F.concat(text, F.lit(" "), unit))


def km_to_miles(km: Column) -> Column:
    return km * F.lit(KM_TO_MILES)


def miles_to_km(miles: Column) -> Column:
    return miles * F.lit(MILES_TO_KM)


def per_second(per_minute: Column) -> Column:
    return F.round(per_minute / F.lit(60.0)).cast("bigint")


def exact_avg(value: Column) -> Column:
    """Mean as one double division of the exact sum, so engines and partitionings agree."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def money(value: Column) -> Column:
    """A summed amount as a double in cents precision."""
    return F.round(value.cast("double"), 2)
