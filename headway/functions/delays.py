"""Delay predicates. Every threshold comes from ``headway.constants``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.constants import (
    EXTREME_CHANGE_SECONDS,
    LATE_SECONDS,
    ON_TIME_SECONDS,
    VERY_LATE_SECONDS,
)


def is_on_time(delay: Column) -> Column:
    return F.abs(delay) <= ON_TIME_SECONDS


def is_late(delay: Column) -> Column:
    return delay > LATE_SECONDS


def is_very_late(delay: Column) -> Column:
    return delay > VERY_LATE_SECONDS


def delay_change_is_extreme(change: Column) -> Column:
    """Three-valued: NULL when there is no change to judge."""
    return F.abs(change) > EXTREME_CHANGE_SECONDS


def seconds_apart(left: Column, right: Column) -> Column:
    """Whole seconds between two instants, independent of the time zone."""
    return F.abs(F.unix_seconds(left) - F.unix_seconds(right))
