"""Feed history matched with the timetable, and the canonical event per stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import seconds_apart
from headway.operators.picking import top_row

# The trip comes first: it tells most rows apart, which is what sorts go by.
STOP_KEY = ["trip_id", "stop_id", "stop_sequence"]
EVENT_KEY = [*STOP_KEY, "service_date"]

_CONTEXT = [
    "route_id",
    "route_short_name",
    "route_long_name",
    "transport_mode",
    "trip_headsign",
    "direction_id",
    "stop_name",
]
_SCHEDULE = [
    "scheduled_arrival_time",
    "scheduled_departure_time",
    "scheduled_arrival_seconds",
    "scheduled_departure_seconds",
]
_REPORTED = [
    "arrival_time_actual",
    "departure_time_actual",
    "arrival_delay_seconds",
    "departure_delay_seconds",
]
OBSERVATION_COLUMNS = [
    "service_date",
    "trip_id",
    "route_id",
    "route_short_name",
    "route_long_name",
    "transport_mode",
    "trip_headsign",
    "direction_id",
    "stop_id",
    "stop_name",
    "stop_sequence",
    "feed_timestamp",
    *_SCHEDULE,
    *_REPORTED,
]
EVENT_COLUMNS = [
    *(name for name in OBSERVATION_COLUMNS if name != "feed_timestamp"),
    "feed_timestamp",
    "seconds_from_reported_arrival",
]


def stop_timetable(silver: dict[str, DataFrame]) -> DataFrame:
    """Everything static about a scheduled stop, by trip, stop and sequence.

    Joining the static tables with each other first means that the far larger
    feed history is shuffled once, on the full stop key, and not once per table.
    """
    routes = silver["routes"].select(
        "route_id", "route_short_name", "route_long_name", "transport_mode"
    )
    trips = silver["trips"].select("trip_id", "route_id", "trip_headsign", "direction_id")
    stops = silver["stops"].select("stop_id", "stop_name")
    schedule = silver["stop_events"].select(
        *STOP_KEY,
        F.col("arrival_time_raw").alias("scheduled_arrival_time"),
        F.col("departure_time_raw").alias("scheduled_departure_time"),
        F.col("arrival_seconds").alias("scheduled_arrival_seconds"),
        F.col("departure_seconds").alias("scheduled_departure_seconds"),
    )
    return (
        schedule.join(trips.join(routes, "route_id"), "trip_id")
        .join(stops, "stop_id")
        .select(*STOP_KEY, *_CONTEXT, *_SCHEDULE)
    )


def numbered_history(realtime: DataFrame) -> DataFrame:
    """Feed history with ids as the timetable's numbers and its service date."""
    return realtime.select(
        F.col("start_date").alias("service_date"),
        F.col("trip_id").try_cast("bigint").alias("trip_id"),
        F.col("stop_id").try_cast("bigint").alias("stop_id"),
        F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
        "feed_timestamp",
        *_REPORTED,
    )


def stop_observations(silver: dict[str, DataFrame]) -> DataFrame:
    """Every snapshot row that matches a scheduled stop, with its context."""
    history = numbered_history(silver["realtime_stop_events"])
    return history.join(stop_timetable(silver), STOP_KEY).select(*OBSERVATION_COLUMNS)


def canonical_snapshots(rows: DataFrame) -> DataFrame:
    """The snapshot nearest to the reported arrival, per service day and stop.

    The newer snapshot wins a tie; the reported values settle what is left, so
    the choice never depends on row order. Needs the event key, the snapshot
    time and the reported values; other columns are carried along.
    """
    measured = rows.filter("arrival_time_actual is not null").withColumn(
        "seconds_from_reported_arrival",
        seconds_apart(F.col("feed_timestamp"), F.col("arrival_time_actual")),
    )
    order = [
        F.col("seconds_from_reported_arrival").asc(),
        F.col("feed_timestamp").desc(),
        *(F.col(name).asc_nulls_last() for name in _REPORTED[2:] + _REPORTED[:2]),
        # Rows of a timetable that repeats a stop differ only in these.
        *(F.col(name).asc_nulls_last() for name in rows.columns if name in _CONTEXT + _SCHEDULE),
    ]
    return top_row(measured, EVENT_KEY, order)


def canonical_events(observations: DataFrame) -> DataFrame:
    """Canonical events out of materialised observations."""
    return canonical_snapshots(observations).select(*EVENT_COLUMNS)


def canonical_events_from_history(silver: dict[str, DataFrame]) -> DataFrame:
    """The same events straight from the feed history.

    The choice needs feed columns only and the timetable join decides per stop
    key, so choosing first gives the same events while the join sees one row per
    event and no key with many rows. A stop key the timetable repeats is taken
    once, which keeps one event per key.
    """
    picks = canonical_snapshots(numbered_history(silver["realtime_stop_events"]))
    timetable = stop_timetable(silver)
    once = top_row(
        timetable,
        STOP_KEY,
        [F.col(name).asc_nulls_last() for name in timetable.columns if name not in STOP_KEY],
    )
    return picks.join(once, STOP_KEY).select(*EVENT_COLUMNS)


def delay_counts(silver: dict[str, DataFrame]) -> DataFrame:
    """Observations counted by stop key, day and delay, then given their context.

    For metrics over every snapshot: repeated delays of a stop are counted on
    the map side and joined once, with ``weight`` as their number.
    """
    counted = (
        numbered_history(silver["realtime_stop_events"])
        .filter("arrival_delay_seconds is not null")
        .groupBy(*EVENT_KEY, "arrival_delay_seconds")
        .agg(F.count("*").alias("weight"))
    )
    return counted.join(stop_timetable(silver), STOP_KEY)
