"""Decoded feed messages to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.constants import DEFAULT_STATUS
from headway.functions import compact_date
from headway.operators.picking import keep_last
from headway.schemas import OBSERVATION


def _entities(feed: DataFrame, part: str) -> DataFrame:
    """One row per entity that carries ``part``, in feed order."""
    return (
        feed.select(
            F.col("header.timestamp").alias("feed_timestamp"),
            F.posexplode("entity").alias("entity_index", "entity"),
        )
        .select("feed_timestamp", "entity_index", F.col(f"entity.{part}").alias("part"))
        .filter(F.col("part").isNotNull())
    )


def _filled(name: str):
    return F.nullif(F.col(name), F.lit(""))


def trip_update_rows(feed: DataFrame) -> DataFrame:
    """One row per stop update; fields that were not sent stay NULL."""
    return (
        _entities(feed, "trip_update")
        .filter(F.length("part.trip.trip_id") > 0)
        .select(
            "feed_timestamp",
            F.col("part.trip.trip_id").alias("trip_id"),
            _filled("part.trip.start_date").alias("start_date"),
            F.explode("part.stop_time_update").alias("stop"),
        )
        .select(
            "trip_id",
            _filled("stop.stop_id").alias("stop_id"),
            F.col("stop.stop_sequence").cast("long").alias("stop_sequence"),
            F.col("stop.arrival.time").alias("arrival_time_actual"),
            F.col("stop.departure.time").alias("departure_time_actual"),
            F.col("stop.arrival.delay").cast("long").alias("arrival_delay_seconds"),
            F.col("stop.departure.delay").cast("long").alias("departure_delay_seconds"),
            "feed_timestamp",
            "start_date",
        )
    )


def typed_observations(rows: DataFrame) -> DataFrame:
    """Epochs to instants and the start date to a date."""
    return rows.select(
        "trip_id",
        "stop_id",
        "stop_sequence",
        F.timestamp_seconds("arrival_time_actual").alias("arrival_time_actual"),
        F.timestamp_seconds("departure_time_actual").alias("departure_time_actual"),
        "arrival_delay_seconds",
        "departure_delay_seconds",
        F.timestamp_seconds("feed_timestamp").alias("feed_timestamp"),
        compact_date(F.col("start_date")).alias("start_date"),
    ).to(OBSERVATION)


def vehicle_rows(
    feed: DataFrame, require_trip: bool = True, require_position: bool = True
) -> DataFrame:
    """One row per vehicle entity.

    The board needs a trip and a position. The inspection of vehicles without a
    trip turns the first demand off, feed comparisons the second.
    """
    rows = _entities(feed, "vehicle").select(
        "feed_timestamp",
        "entity_index",
        _filled("part.vehicle.id").alias("vehicle_id"),
        _filled("part.trip.trip_id").alias("trip_id"),
        _filled("part.trip.route_id").alias("route_id"),
        F.col("part.position.latitude").alias("latitude"),
        F.col("part.position.longitude").alias("longitude"),
        F.col("part.timestamp").alias("vehicle_timestamp"),
        _filled("part.stop_id").alias("stop_id"),
        F.coalesce("part.current_status", F.lit(DEFAULT_STATUS)).alias("current_status"),
    )
    if require_trip:
        rows = rows.filter("vehicle_id is not null and trip_id is not null")
    if require_position:
        rows = rows.filter("latitude is not null")
    return rows


def vehicles_by_id(rows: DataFrame) -> DataFrame:
    """Last entity per snapshot and vehicle."""
    named = rows.filter("vehicle_id is not null")
    return keep_last(named, ["feed_timestamp", "vehicle_id"], "entity_index")


def vehicles_by_trip(rows: DataFrame) -> DataFrame:
    """Last entity per snapshot and trip."""
    running = rows.filter("vehicle_id is not null and trip_id is not null")
    return keep_last(running, ["feed_timestamp", "trip_id"], "entity_index")


def trip_update_state(feed: DataFrame) -> DataFrame:
    """Last update per snapshot and trip, its stop updates as an array.

    The live reading differs from the history: a time of zero counts as not
    sent, and a sequence that was not sent counts as zero.
    """

    def live(stop):
        return F.struct(
            F.coalesce(stop["stop_sequence"], F.lit(0)).alias("stop_sequence"),
            stop["stop_id"].alias("stop_id"),
            F.nullif(stop["arrival"]["time"], F.lit(0)).alias("arrival_time"),
            stop["arrival"]["delay"].alias("arrival_delay"),
            F.nullif(stop["departure"]["time"], F.lit(0)).alias("departure_time"),
            stop["departure"]["delay"].alias("departure_delay"),
        )

    updates = (
        _entities(feed, "trip_update")
        .filter(F.length("part.trip.trip_id") > 0)
        .select(
            "feed_timestamp",
            "entity_index",
            F.col("part.trip.trip_id").alias("trip_id"),
            _filled("part.vehicle.id").alias("vehicle_id"),
            F.col("part.timestamp").alias("update_timestamp"),
            F.transform("part.stop_time_update", live).alias("stop_updates"),
        )
    )
    return keep_last(updates, ["feed_timestamp", "trip_id"], "entity_index")


def newest_trip_states(states: DataFrame) -> DataFrame:
    """The newest of the states of :func:`trip_update_state` per trip, over all snapshots."""
    return keep_last(states, ["trip_id"], "feed_timestamp", "entity_index")


def stop_update_rows(state: DataFrame) -> DataFrame:
    """The stop updates of :func:`trip_update_state` as rows, in feed order."""
    return state.select(
        "feed_timestamp", "trip_id", F.posexplode("stop_updates").alias("update_index", "stop")
    ).select("feed_timestamp", "trip_id", "update_index", "stop.*")


def feed_trip_ids(feed: DataFrame) -> DataFrame:
    """Distinct trip ids of the trip updates."""
    return (
        _entities(feed, "trip_update")
        .select(F.col("part.trip.trip_id").alias("trip_id"))
        .filter(F.length("trip_id") > 0)
        .distinct()
    )
