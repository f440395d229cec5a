"""Narrowing of the timetable and the feed to the routes in scope.

Each step keeps the rows of one table whose key occurs in another, which is a
semi join: no column of the other side is needed, and a repeated key there
cannot multiply rows. No side is broadcast by hint, since all of them grow with
the network; Spark broadcasts one only when its measured size is small.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.constants import SCOPE_AGENCIES
from headway.functions import history_mode, service_seconds


def routes_in_scope(routes: DataFrame, agencies: Iterable[int] = SCOPE_AGENCIES) -> DataFrame:
    return routes.filter(F.col("agency_id").isin(*agencies)).select(
        "route_id",
        "route_short_name",
        "route_long_name",
        "route_type",
        history_mode(F.col("route_type")).alias("transport_mode"),
    )


def trips_in_scope(trips: DataFrame, routes: DataFrame) -> DataFrame:
    return trips.join(routes.select("route_id"), "route_id", "left_semi").select(
        "trip_id", "route_id", "service_id", "trip_headsign", "direction_id", "shape_id"
    )


def scheduled_stop_events(stop_times: DataFrame) -> DataFrame:
    """Raw times renamed, and read as seconds of the service day."""
    arrival, departure = F.col("arrival_time"), F.col("departure_time")
    return stop_times.select(
        "trip_id",
        "stop_sequence",
        "stop_id",
        arrival.alias("arrival_time_raw"),
        departure.alias("departure_time_raw"),
        service_seconds(arrival).alias("arrival_seconds"),
        service_seconds(departure).alias("departure_seconds"),
    )


def stop_events_in_scope(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    kept = stop_times.join(trips.select("trip_id"), "trip_id", "left_semi")
    return scheduled_stop_events(kept)


def stops_in_use(stops: DataFrame, stop_events: DataFrame) -> DataFrame:
    # Many stop events share a stop: distinct ids first, so that a busy stop is
    # one row on the join's build side.
    used = stop_events.select("stop_id").distinct()
    return stops.join(used, "stop_id", "left_semi").select(
        "stop_id",
        "stop_name",
        "stop_lat",
        "stop_lon",
        "location_type",
        "parent_station",
        "platform_code",
    )


def observations_in_scope(observations: DataFrame, trips: DataFrame) -> DataFrame:
    """Feed rows of known trips. An id that is not a number matches nothing."""
    known = trips.select(F.col("trip_id").alias("_known_trip"))
    same_trip = F.col("trip_id").try_cast("bigint") == F.col("_known_trip")
    return observations.join(known, same_trip, "left_semi")
