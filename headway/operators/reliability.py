"""Punctuality metrics by any set of keys.

All metrics of a group follow from how often each delay occurs in it. Delays
are whole seconds, so a group has few distinct ones however many rows it has:
rows are counted by (keys, delay) with a map-side combine, and the percentiles
come from running totals over those counts. The result is exact, every step is
a hash aggregation or a window over counts, and a group that holds a third of
the table shrinks to its distinct delays before it meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import clock_hour, is_late, is_on_time, is_very_late, service_hour
from headway.functions import weekday_name, weekday_number

ROUTE_KEY = ["route_id", "route_short_name", "route_long_name", "transport_mode"]
DELAY = "arrival_delay_seconds"


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """Rows by keys and value, as ``n``. ``weight`` names a pre-count."""
    total = F.count("*") if weight is None else F.sum(weight)
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(total.alias("n"))


def with_running_total(counts: DataFrame, keys: Sequence[str], value: str, n: Column) -> DataFrame:
    """Adds ``running`` and ``whole``: counts up to each value, and of the group."""
    by_value = Window.partitionBy(*keys).orderBy(value)
    up_to_here = by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = by_value.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.withColumn("running", F.sum(n).over(up_to_here)).withColumn(
        "whole", F.sum(n).over(everything)
    )


def percentile_of_counts(value: str, percent: int, n: Column) -> Column:
    """The smallest value that at least ``percent`` % of the rows do not exceed."""
    reached = F.col("running") * 100 >= F.col("whole") * percent
    return F.min(F.when(reached & (n > 0), F.col(value)))


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage with two decimals; NULL for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)


def reliability_by(
    df: DataFrame, keys: Sequence[str], count_name: str, weight: str | None = None
) -> DataFrame:
    """Count, average, median, P95 and the three shares, per group of ``keys``."""
    delay, n = F.col(DELAY), F.col("n")
    counts = with_running_total(value_counts(df, keys, DELAY, weight), keys, DELAY, n)
    total = F.sum("n")

    def share(condition: Column) -> Column:
        return share_pct(F.sum(F.when(condition, n).otherwise(0)), total)

    return counts.groupBy(*keys).agg(
        total.alias(count_name),
        F.round(F.sum(delay * n) / total, 2).alias("avg_arrival_delay_seconds"),
        percentile_of_counts(DELAY, 50, n).alias("median_arrival_delay_seconds"),
        percentile_of_counts(DELAY, 95, n).alias("p95_arrival_delay_seconds"),
        share(is_on_time(delay)).alias("on_time_pct"),
        share(is_late(delay)).alias("over_5_min_late_pct"),
        share(is_very_late(delay)).alias("over_10_min_late_pct"),
    )


# What the metrics below need of the row-level tables: how often each delay occurs for the
# finest keys of a service day. Days are added up by the metrics, so that a day can be
# counted anew without touching the others.
EVENT_COUNT_KEYS = [
    "service_date",
    *ROUTE_KEY,
    "direction_id",
    "stop_id",
    "stop_name",
    "scheduled_hour",
]
OBSERVATION_COUNT_KEYS = ["service_date", "transport_mode", "scheduled_hour"]


def event_counts(events: DataFrame) -> DataFrame:
    """Canonical events counted by day, route, direction, stop, hour and delay."""
    return value_counts(_by_service_hour(events), EVENT_COUNT_KEYS, DELAY)


def observation_counts(observations: DataFrame, weight: str | None = None) -> DataFrame:
    """Observations counted by day, mode, hour and delay."""
    return value_counts(_by_clock_hour(observations), OBSERVATION_COUNT_KEYS, DELAY, weight)


def _by_service_hour(events: DataFrame) -> DataFrame:
    """Trips after midnight keep hours of 24 and above; counts have the hour already."""
    if "scheduled_hour" in events.columns:
        return events
    return events.withColumn("scheduled_hour", service_hour(F.col("scheduled_arrival_seconds")))


def _by_clock_hour(observations: DataFrame) -> DataFrame:
    if "scheduled_hour" in observations.columns:
        return observations
    return observations.withColumn("scheduled_hour", clock_hour(F.col("scheduled_arrival_seconds")))


# Over canonical events, one row per service day and scheduled stop, or their counts.


def route_reliability(events: DataFrame, weight: str | None = None) -> DataFrame:
    return reliability_by(events, ROUTE_KEY, "observations", weight)


def stop_reliability(events: DataFrame, weight: str | None = None) -> DataFrame:
    return reliability_by(events, ["stop_id", "stop_name", "transport_mode"], "observations", weight)


def route_stop_reliability(events: DataFrame, weight: str | None = None) -> DataFrame:
    return reliability_by(events, [*ROUTE_KEY, "stop_id", "stop_name"], "stop_events", weight)


def route_direction_reliability(events: DataFrame, weight: str | None = None) -> DataFrame:
    directed = events.filter("direction_id is not null")
    return reliability_by(directed, [*ROUTE_KEY, "direction_id"], "stop_events", weight)


def route_hourly_reliability(events: DataFrame, weight: str | None = None) -> DataFrame:
    """By service hour."""
    timed = _by_service_hour(events).filter("scheduled_hour is not null")
    return reliability_by(timed, [*ROUTE_KEY, "scheduled_hour"], "stop_events", weight)


def route_weekday_reliability(events: DataFrame, weight: str | None = None) -> DataFrame:
    day = F.col("service_date")
    # The name follows from the number: it is added after the aggregation.
    numbered = events.withColumn("day_of_week_number", weekday_number(day))
    metrics = reliability_by(numbered, [*ROUTE_KEY, "day_of_week_number"], "stop_events", weight)
    # 2023-12-31 was a Sunday, day number 1 is one day after the Saturday before.
    any_such_day = F.date_add(F.lit("2023-12-30").cast("date"), F.col("day_of_week_number"))
    named = metrics.withColumn("day_of_week", weekday_name(any_such_day))
    rest = [name for name in metrics.columns if name not in (*ROUTE_KEY, "day_of_week_number")]
    return named.select(*ROUTE_KEY, "day_of_week_number", "day_of_week", *rest)


# Over observations, where every snapshot counts, or their counts.


def hourly_patterns(observations: DataFrame, weight: str | None = None) -> DataFrame:
    """By mode and hour on the clock."""
    timed = _by_clock_hour(observations).filter("scheduled_hour is not null")
    return reliability_by(timed, ["transport_mode", "scheduled_hour"], "observations", weight)


def daily_metrics(observations: DataFrame, weight: str | None = None) -> DataFrame:
    """By service day and mode."""
    return reliability_by(observations, ["service_date", "transport_mode"], "observations", weight)
