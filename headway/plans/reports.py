"""Analytic reports over the Gold tables.

Inputs are aggregates, far smaller than the history. Rankings are an order plus
a limit, which Spark runs as a distributed top-k.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import constants as c
from headway.functions import is_late, is_on_time, is_very_late, weekday_number
from headway.operators.reliability import ROUTE_KEY, share_pct


def weighted_mean(name: str, weight: str) -> Column:
    """Mean of an already rounded metric, weighted by its group sizes.

    Summed in whole hundredths, so the result does not depend on the order in
    which partitions are added up.
    """
    hundredths = F.round(F.col(name) * 100).cast("long")
    return F.round(F.sum(hundredths * F.col(weight)) / F.sum(weight) / 100, 2)


def only(df: DataFrame, modes: Iterable[str] = (), route_ids: Iterable[int] = ()) -> DataFrame:
    """The dashboards' global filters; an empty filter keeps everything."""
    modes, route_ids = list(modes), list(route_ids)
    if modes:
        df = df.filter(F.col("transport_mode").isin(modes))
    if route_ids:
        df = df.filter(F.col("route_id").isin(route_ids))
    return df


def _tail_risk(max_avg: float, min_p95: float) -> Column:
    return (F.col("avg_arrival_delay_seconds") <= max_avg) & (
        F.col("p95_arrival_delay_seconds") >= min_p95
    )


def tail_risk_routes(
    route_reliability: DataFrame,
    min_observations: int = c.MIN_ROUTE_OBSERVATIONS,
    max_avg: float = c.TAIL_RISK_MAX_AVG_SECONDS,
    min_p95: float = c.TAIL_RISK_MIN_P95_SECONDS,
) -> DataFrame:
    """Routes that look fine on average and are often badly late."""
    return route_reliability.filter(
        (F.col("observations") >= min_observations) & _tail_risk(max_avg, min_p95)
    ).select(
        *ROUTE_KEY, "observations", "avg_arrival_delay_seconds", "p95_arrival_delay_seconds"
    )


def tail_risk_share(
    route_reliability: DataFrame,
    min_observations: int = c.MIN_ROUTE_OBSERVATIONS,
    max_avg: float = c.TAIL_RISK_MAX_AVG_SECONDS,
    min_p95: float = c.TAIL_RISK_MIN_P95_SECONDS,
) -> DataFrame:
    """How many qualified routes there are and which share is at risk."""
    qualified = F.count("*")
    risky = F.count(F.when(_tail_risk(max_avg, min_p95), 1))
    return route_reliability.filter(F.col("observations") >= min_observations).agg(
        qualified.alias("qualified_routes"),
        risky.alias("tail_risk_routes"),
        share_pct(risky, qualified).alias("tail_risk_share_pct"),
    )


def direction_gap(
    route_direction: DataFrame, min_events: int = c.MIN_DIRECTION_EVENTS
) -> DataFrame:
    """On-time gap between the two directions, largest first."""

    def of(direction: int, name: str) -> Column:
        return F.max(F.when(F.col("direction_id") == direction, F.col(name)))

    both = (
        route_direction.filter(F.col("stop_events") >= min_events)
        .groupBy(*ROUTE_KEY)
        .agg(
            of(0, "stop_events").alias("stop_events_0"),
            of(1, "stop_events").alias("stop_events_1"),
            of(0, "on_time_pct").alias("on_time_pct_0"),
            of(1, "on_time_pct").alias("on_time_pct_1"),
        )
        .filter("stop_events_0 is not null and stop_events_1 is not null")
    )
    gap = F.round(F.abs(F.col("on_time_pct_0") - F.col("on_time_pct_1")), 2)
    return both.withColumn("on_time_gap", gap).orderBy(F.desc("on_time_gap"), "route_id")


def worst_route_stops(
    route_stop: DataFrame, min_events: int = c.MIN_ROUTE_STOP_EVENTS, top: int = 20
) -> DataFrame:
    """Least punctual route and stop pairs."""
    return (
        route_stop.filter(F.col("stop_events") >= min_events)
        .orderBy("on_time_pct", F.desc("avg_arrival_delay_seconds"), "route_id", "stop_id")
        .limit(top)
    )


def delay_tendency(
    route_propagation: DataFrame, min_events: int = c.MIN_PROPAGATION_EVENTS
) -> DataFrame:
    """Whether a route tends to accumulate or recover delay."""
    gained, lost = F.col("pct_delay_accumulated"), F.col("pct_delay_recovered")
    tendency = (
        F.when(gained > lost, "accumulates")
        .when(gained < lost, "recovers")
        .when(gained == lost, "stable")
    )
    return route_propagation.filter(F.col("propagation_events") >= min_events).withColumn(
        "tendency", tendency
    )


def accumulating_routes(
    route_propagation: DataFrame, min_events: int = c.MIN_PROPAGATION_EVENTS, top: int = 20
) -> DataFrame:
    """Routes that gain delay most often."""
    return (
        delay_tendency(route_propagation, min_events)
        .filter("tendency = 'accumulates'")
        .orderBy(F.desc("pct_delay_accumulated"), "route_id")
        .limit(top)
    )


def time_of_day(route_hourly: DataFrame, min_events: int = c.MIN_HOUR_EVENTS) -> DataFrame:
    """Network punctuality by service hour, for hours with enough events."""
    weight = "stop_events"
    return (
        route_hourly.groupBy("scheduled_hour")
        .agg(
            F.sum(weight).alias("events"),
            weighted_mean("avg_arrival_delay_seconds", weight).alias("avg_arrival_delay_seconds"),
            weighted_mean("on_time_pct", weight).alias("on_time_pct"),
            weighted_mean("over_5_min_late_pct", weight).alias("over_5_min_late_pct"),
        )
        .filter(F.col("events") >= min_events)
        .withColumnRenamed("events", "stop_events")
    )


def headline_kpis(route_reliability: DataFrame) -> DataFrame:
    """Network figures out of the route table, weighted by observations."""
    weight = "observations"
    return route_reliability.agg(
        F.sum(weight).alias("total_observations"),
        F.count("*").alias("routes"),
        *[
            weighted_mean(name, weight).alias(name)
            for name in (
                "avg_arrival_delay_seconds",
                "on_time_pct",
                "over_5_min_late_pct",
                "over_10_min_late_pct",
            )
        ],
    )


def kpi_cross_check(route_reliability: DataFrame, events: DataFrame) -> DataFrame:
    """Headline figures out of the route table against the events themselves.

    The route table holds rounded metrics, so the two may differ by the rounding
    of one hundredth.
    """
    delay = F.col("arrival_delay_seconds")
    total = F.count("*")

    def share(condition: Column) -> Column:
        return share_pct(F.count(F.when(condition, 1)), total)

    direct = events.filter(delay.isNotNull()).agg(
        total.cast("double").alias("total_observations"),
        F.round(F.avg(delay), 2).alias("avg_arrival_delay_seconds"),
        share(is_on_time(delay)).alias("on_time_pct"),
        share(is_late(delay)).alias("over_5_min_late_pct"),
        share(is_very_late(delay)).alias("over_10_min_late_pct"),
    )
    names = direct.columns
    served = headline_kpis(route_reliability).select(
        *[F.col(name).cast("double").alias(name) for name in names]
    )
    pairs = served.unpivot([], names, "metric", "from_routes").join(
        direct.unpivot([], names, "metric", "from_events"), "metric"
    )
    # Compared in whole hundredths, as a difference of doubles is not exact.
    gap = F.abs(F.round(F.col("from_routes") * 100) - F.round(F.col("from_events") * 100))
    return pairs.withColumn("matches", F.coalesce(gap <= 1, F.lit(False)))


def avg_vs_p95(
    route_reliability: DataFrame, min_observations: int = c.MIN_ROUTE_OBSERVATIONS
) -> DataFrame:
    """Typical against worst-case delay per route."""
    tail = F.col("p95_arrival_delay_seconds") - F.col("avg_arrival_delay_seconds")
    return route_reliability.filter(F.col("observations") >= min_observations).select(
        *ROUTE_KEY,
        "observations",
        "avg_arrival_delay_seconds",
        "p95_arrival_delay_seconds",
        F.round(tail, 2).alias("tail_seconds"),
    )


def weekday_coverage(route_weekday: DataFrame, events: DataFrame) -> DataFrame:
    """Network punctuality by weekday, with the number of days behind it."""
    weight = "stop_events"
    punctuality = route_weekday.groupBy("day_of_week_number", "day_of_week").agg(
        F.sum(weight).alias("total_stop_events"),
        weighted_mean("on_time_pct", weight).alias("on_time_pct"),
        weighted_mean("avg_arrival_delay_seconds", weight).alias("avg_arrival_delay_seconds"),
    )
    # Distinct days first: a busy day is one row when weekdays are counted.
    days = (
        events.filter("arrival_delay_seconds is not null")
        .select("service_date")
        .distinct()
        .groupBy(weekday_number(F.col("service_date")).alias("day_of_week_number"))
        .agg(F.count("*").alias("days_observed"))
    )
    return punctuality.join(days, "day_of_week_number")
