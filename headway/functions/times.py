"""Service-day times, hours and weekdays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def service_seconds(text: Column) -> Column:
    """Seconds since service-day midnight of an ``HH:MM:SS`` text.

    Hours may pass 24. Blank, short, malformed or overflowing texts give NULL.
    """
    fields = F.split(text, ":")

    def scaled(position: int, factor: int) -> Column:
        return F.try_multiply(F.get(fields, F.lit(position)).try_cast("int"), F.lit(factor))

    return F.try_add(F.try_add(scaled(0, 3600), scaled(1, 60)), scaled(2, 1))


def service_hour(seconds: Column) -> Column:
    """Service hour as written in the timetable; 24 and above are kept."""
    return F.floor(seconds / F.lit(3600))


def clock_hour(seconds: Column) -> Column:
    """Hour on the clock, 0 to 23."""
    return F.pmod(service_hour(seconds), F.lit(24)).cast("int")


def weekday_number(day: Column) -> Column:
    """1 for Sunday to 7 for Saturday."""
    return F.dayofweek(day)


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def compact_date(text: Column) -> Column:
    """Date of a ``yyyyMMdd`` text, NULL when it is not one."""
    return F.try_to_date(text, "yyyyMMdd")


def wall_time(epoch: Column, zone: str = "UTC") -> Column:
    """Zone-free local time of epoch seconds, whatever the session's time zone."""
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    elapsed = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), epoch.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), start + elapsed)


def utc_date(instant: Column) -> Column:
    return wall_time(F.unix_seconds(instant)).cast("date")


def utc_hour(instant: Column) -> Column:
    return F.hour(wall_time(F.unix_seconds(instant)))


def utc_digits(instant: Column) -> Column:
    """``HHmmss`` of an instant in UTC."""
    text = wall_time(F.unix_seconds(instant)).cast("string")
    return F.translate(F.substring(text, 12, 8), ":", "")
