"""Display texts of the live board, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.constants import LOCAL_ZONE, UNKNOWN_DESTINATION
from headway.functions.times import wall_time


def clean_text(value: Column) -> Column:
    """Trimmed text; NULL and the word nan become empty."""
    trimmed = F.regexp_replace(value.cast("string"), r"^\s+|\s+$", "")
    return F.when(F.lower(trimmed) == "nan", "").otherwise(F.coalesce(trimmed, F.lit("")))


def _is_missing(epoch: Column) -> Column:
    return epoch.isNull() | (epoch == 0)


def clock_text(epoch: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local ``HH:mm`` of epoch seconds; missing or zero gives an empty text.    """
    local = wall_time(epoch, zone)

    def two_digits(part: Column) -> Column:
        return F.lpad(part.cast("string"), 2, "0")

    text = F.concat(two_digits(F.hour(local)), F.lit(":"), two_digits(F.minute(local)))
    return F.when(_is_missing(epoch), "").otherwise(text)


def moment_text(epoch: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local date and time of epoch seconds; missing or zero gives NULL."""
    return F.when(~_is_missing(epoch), wall_time(epoch, zone).cast("string"))


def delay_text(seconds: Column) -> Column:
    """Delay in whole minutes, halves rounded to the even minute."""
    minutes = F.bround(seconds / F.lit(60)).cast("long")
    size = F.abs(minutes).cast("string")
    return (
        F.when(seconds.isNull(), "")
        .when(minutes > 0, F.concat(size, F.lit(" min late")))
        .when(minutes < 0, F.concat(size, F.lit(" min early")))
        .otherwise("On time")
    )


def age_text(epoch: Column, now: Column) -> Column:
    """Time since an update; a future update counts as zero seconds old."""
    seconds = F.greatest(F.lit(0).cast("long"), now.cast("long") - epoch.cast("long"))
    minutes = F.floor(seconds / F.lit(60))
    return (
        F.when(_is_missing(epoch), "Unknown")
        .when(seconds < 60, F.concat(seconds.cast("string"), F.lit(" sec ago")))
        .otherwise(F.concat(minutes.cast("string"), F.lit(" min ago")))
    )


def route_sort_key(name: Column) -> Column:
    """Sortable struct: numbered lines by number then suffix, others last."""
    digits = F.regexp_extract(name, r"^\d+", 0)
    numbered = digits != ""
    suffix = F.substr(name, F.length(digits) + F.lit(1))
    return F.struct(
        F.when(numbered, 0).otherwise(1).alias("rank"),
        F.when(numbered, digits.try_cast("decimal(38,0)"))
        .otherwise(F.lit(0).cast("decimal(38,0)"))
        .alias("number"),
        F.lower(F.when(numbered, suffix).otherwise(name)).alias("text"),
    )


def destination_text(headsign: Column, final_stop_name: Column) -> Column:
    """Headsign, else the last stop's name, else a fixed text."""
    sign = F.nullif(F.trim(headsign), F.lit(""))
    return F.coalesce(sign, final_stop_name, F.lit(UNKNOWN_DESTINATION))
