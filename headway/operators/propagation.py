"""How delay changes from one observed stop of a trip to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.constants import EXTREME_CHANGE_SECONDS
from headway.functions import delay_change_is_extreme
from headway.operators.reliability import (
    DELAY,
    ROUTE_KEY,
    percentile_of_counts,
    share_pct,
    value_counts,
    with_running_total,
)

TRIP_DAY = ["trip_id", "service_date"]
# Stop sequences per piece; above what a timetabled trip has.
SEQUENCE_PIECE = 1000
_CARRIED = {
    "stop_id": "previous_stop_id",
    "stop_name": "previous_stop_name",
    DELAY: "previous_arrival_delay_seconds",
}
_BASE = [
    "service_date",
    "trip_id",
    *ROUTE_KEY,
    "trip_headsign",
    "direction_id",
    "stop_id",
    "stop_name",
    "stop_sequence",
    "scheduled_arrival_seconds",
    DELAY,
]


def with_previous_stop(events: DataFrame, piece: int = SEQUENCE_PIECE) -> DataFrame:
    """Each event with the one before it on the same trip and day.

    Previous means previously observed: a stop without a delay is no event here
    and is bridged.

    A trip is worked on in pieces of its stop sequence, so that no task has to
    order a trip of any length. Nearly all trips fit into their first piece; for
    the others, the first event of a piece follows the last one of the piece
    before, which is looked up among one row per piece. Whether there are such trips
    is a subquery: without them the lookup neither reads nor shuffles an event.
    """
    cut = events.withColumn("_piece", F.floor(F.col("stop_sequence") / F.lit(piece)))
    order = ["stop_sequence", "stop_id"]
    in_piece = Window.partitionBy(*TRIP_DAY, "_piece").orderBy(*order)
    placed = cut.select(
        "*",
        F.row_number().over(in_piece).alias("_place"),
        *(F.lag(name).over(in_piece).alias(alias) for name, alias in _CARRIED.items()),
    )

    beyond = cut.filter((F.col("stop_sequence") >= piece) | (F.col("stop_sequence") < 0))
    long_trips = beyond.select(*TRIP_DAY).distinct()
    last = F.max_by(F.struct(*_CARRIED), F.struct(*order))
    some = beyond.agg(F.count("*") > 0).scalar()
    ends = (
        cut.filter(some)
        .join(long_trips, TRIP_DAY, "left_semi")
        .groupBy(*TRIP_DAY, "_piece")
        .agg(last.alias("_end"))
    )
    by_piece = Window.partitionBy(*TRIP_DAY).orderBy("_piece")
    before = ends.select(*TRIP_DAY, "_piece", F.lag("_end").over(by_piece).alias("_before"))

    def previous(name: str, alias: str):
        at_start = F.when(F.col("_place") == 1, F.col("_before")[name])
        return F.coalesce(F.col(alias), at_start).alias(alias)

    return placed.join(
        before.filter("_before is not null"), [*TRIP_DAY, "_piece"], "left"
    ).select(
        *events.columns, *(previous(name, alias) for name, alias in _CARRIED.items())
    )


def delay_propagation_events(events: DataFrame) -> DataFrame:
    """Canonical events with the change since the previous observed stop."""
    observed = events.filter(F.col(DELAY).isNotNull()).select(*_BASE)
    change = F.col(DELAY) - F.col("previous_arrival_delay_seconds")
    return (
        with_previous_stop(observed)
        .withColumn("delay_change_seconds", change)
        .withColumn(
            "is_extreme_propagation", delay_change_is_extreme(F.col("delay_change_seconds"))
        )
    )


CHANGE = "delay_change_seconds"


def propagation_counts(propagation: DataFrame) -> DataFrame:
    """Changes counted by day, route and seconds."""
    return value_counts(propagation, ["service_date", *ROUTE_KEY], CHANGE)


def route_delay_propagation(propagation: DataFrame, weight: str | None = None) -> DataFrame:
    """Accumulation and recovery per route, of rows or of their counts.

    Extreme changes are counted and then left out of the average, the median
    and the two shares, which are NULL for a route with nothing else.
    """
    name = CHANGE
    change, n = F.col(name), F.col("n")
    extreme = F.abs(change) > EXTREME_CHANGE_SECONDS
    usual = F.when(extreme, 0).otherwise(n)
    counts = with_running_total(
        value_counts(propagation, ROUTE_KEY, name, weight), ROUTE_KEY, name, usual
    )
    total, usual_total = F.sum("n"), F.sum(usual)
    extreme_total = F.sum(F.when(extreme, n).otherwise(0))

    def usual_share(condition: Column) -> Column:
        return share_pct(F.sum(F.when(condition, usual).otherwise(0)), usual_total)

    return counts.groupBy(*ROUTE_KEY).agg(
        total.alias("propagation_events"),
        extreme_total.alias("extreme_propagation_events"),
        share_pct(extreme_total, total).alias("extreme_propagation_pct"),
        F.round(F.sum(change * usual) / F.nullif(usual_total, F.lit(0)), 2).alias(
            "avg_delay_change_seconds"
        ),
        percentile_of_counts(name, 50, usual).alias("median_delay_change_seconds"),
        usual_share(change > 0).alias("pct_delay_accumulated"),
        usual_share(change < 0).alias("pct_delay_recovered"),
    )
