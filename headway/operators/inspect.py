"""Inspection of the realtime feeds: coverage, overlap and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.picking import top_row


def _rate(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1)


def missing_trip_profile(vehicles: DataFrame) -> DataFrame:
    """Vehicles with and without a trip, per snapshot."""
    total, with_trip = F.count("*"), F.count("trip_id")
    return vehicles.groupBy("feed_timestamp").agg(
        total.alias("total_vehicles"),
        with_trip.alias("with_trip"),
        (total - with_trip).alias("without_trip"),
        _rate(total - with_trip, total).alias("missing_trip_pct"),
    )


def missing_trip_examples(vehicles: DataFrame, limit: int = 20) -> DataFrame:
    """The first vehicles without a trip, in feed order."""
    return (
        vehicles.filter("trip_id is null")
        .select(
            "feed_timestamp",
            "entity_index",
            "vehicle_id",
            "latitude",
            "longitude",
            "vehicle_timestamp",
            "stop_id",
            "current_status",
        )
        .orderBy("feed_timestamp", "entity_index")
        .limit(limit)
    )


def feed_overlap(vehicle_trips: DataFrame, update_trips: DataFrame) -> DataFrame:
    """Trips in both feeds, and their share of the trips with a vehicle."""
    sides = vehicle_trips.select(
        F.col("trip_id").cast("string").alias("trip_id"),
        F.lit(1).alias("driven"),
        F.lit(0).alias("updated"),
    ).union(update_trips.select(F.col("trip_id").cast("string"), F.lit(0), F.lit(1)))
    # One aggregation by trip in place of two distincts and a join.
    by_trip = (
        sides.filter("trip_id is not null")
        .groupBy("trip_id")
        .agg(F.max("driven").alias("driven"), F.max("updated").alias("updated"))
    )
    driven, updated = F.sum("driven"), F.sum("updated")
    both = F.count(F.when((F.col("driven") == 1) & (F.col("updated") == 1), 1))
    return by_trip.agg(
        F.coalesce(driven, F.lit(0)).alias("vehicle_trips"),
        F.coalesce(updated, F.lit(0)).alias("update_trips"),
        both.alias("trips_in_both"),
        _rate(both, driven).alias("match_rate"),
    )


def overlap_examples(
    vehicles: DataFrame, state: DataFrame, trips: int = 5, stops: int = 5
) -> DataFrame:
    """A few trips of both feeds with their first stop updates."""
    updates = state.filter(F.size("stop_updates") > 0).select(
        "trip_id",
        "update_timestamp",
        F.size("stop_updates").alias("stop_update_count"),
        F.slice("stop_updates", 1, stops).alias("first_stop_updates"),
    )
    return (
        vehicles.select("trip_id", "vehicle_id", "latitude", "longitude", "vehicle_timestamp")
        .join(updates, "trip_id")
        .orderBy("trip_id")
        .limit(trips)
    )


def route_match(vehicles: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Vehicles with their trip's route, and whether the trip is known.

    A trip the timetable repeats counts once, so no vehicle is repeated.
    """
    lines = routes.select("route_id", "route_short_name", "route_long_name", "route_type")
    lookup = top_row(
        trips.select("trip_id", "route_id", "trip_headsign").join(lines, "route_id", "left"),
        ["trip_id"],
        [F.col("route_id").asc_nulls_last()],
    ).withColumnRenamed("trip_id", "_trip")
    same_trip = vehicles["trip_id"].try_cast("bigint") == lookup["_trip"]
    return vehicles.join(lookup, same_trip, "left").select(
        "vehicle_id",
        "trip_id",
        "latitude",
        "longitude",
        "vehicle_timestamp",
        F.col("_trip").isNotNull().alias("matched"),
        lookup["route_id"].alias("route_id"),
        "route_short_name",
        "route_long_name",
        "route_type",
        "trip_headsign",
    )


def route_match_summary(matches: DataFrame) -> DataFrame:
    total, matched = F.count("*"), F.count(F.when(F.col("matched"), 1))
    return matches.agg(
        total.alias("live_vehicles"),
        matched.alias("matched"),
        (total - matched).alias("unmatched"),
        _rate(matched, total).alias("match_rate"),
    )


def route_match_examples(matches: DataFrame, matched: bool, limit: int = 10) -> DataFrame:
    return (
        matches.filter(F.col("matched") == matched)
        .orderBy("vehicle_id", "trip_id", "vehicle_timestamp")
        .limit(limit)
    )


def consecutive_snapshots(vehicles: DataFrame) -> DataFrame:
    """Snapshot times with the time before, the seconds between and both totals.

    One row per snapshot time but the first; vehicles are counted before the
    few times meet in one task.
    """
    counted = (
        vehicles.filter("feed_timestamp is not null")
        .groupBy("feed_timestamp")
        .agg(F.count("*").alias("vehicles_now"))
    )
    in_time = Window.orderBy("feed_timestamp")
    paired = counted.withColumns(
        {
            "previous_timestamp": F.lag("feed_timestamp").over(in_time),
            "vehicles_before": F.lag("vehicles_now").over(in_time),
        }
    )
    delta = F.col("feed_timestamp") - F.col("previous_timestamp")
    return paired.filter("previous_timestamp is not null").withColumn("feed_delta_seconds", delta)


def vehicle_changes(vehicles: DataFrame) -> DataFrame:
    """Each vehicle against itself in the snapshot before, however long ago.

    ``vehicles`` has one row per snapshot time (epoch seconds) and vehicle. A
    vehicle that one of the two snapshots lacks has no row.
    """
    values = ["trip_id", "route_id", "latitude", "longitude", "vehicle_timestamp"]
    pairs = consecutive_snapshots(vehicles).select("feed_timestamp", "previous_timestamp")
    after = vehicles.select("feed_timestamp", "vehicle_id", *values).join(pairs, "feed_timestamp")
    before = vehicles.select(
        F.col("feed_timestamp").alias("previous_timestamp"),
        "vehicle_id",
        *[F.col(name).alias(f"previous_{name}") for name in values],
    )

    def differs(name: str) -> Column:
        return ~F.col(name).eqNullSafe(F.col(f"previous_{name}"))

    return after.join(before, ["previous_timestamp", "vehicle_id"]).select(
        "feed_timestamp",
        "previous_timestamp",
        "vehicle_id",
        *values,
        *[f"previous_{name}" for name in values],
        (differs("latitude") | differs("longitude")).alias("position_changed"),
        differs("vehicle_timestamp").alias("timestamp_changed"),
    )


def feed_freshness(vehicles: DataFrame) -> DataFrame:
    """Per snapshot but the first: how many vehicles moved on since the one before.

    Snapshots without a common vehicle have a row too, with counts of zero.
    """
    updated = F.count(F.when(F.col("position_changed") | F.col("timestamp_changed"), 1))
    by_time = vehicle_changes(vehicles).groupBy("feed_timestamp").agg(
        F.count("*").alias("vehicles_in_both"),
        updated.alias("updated_vehicles"),
        F.count(F.when(F.col("position_changed"), 1)).alias("position_changes"),
        F.count(F.when(F.col("timestamp_changed"), 1)).alias("timestamp_changes"),
    )
    counts = by_time.columns[1:]
    common = F.col("vehicles_in_both")
    return (
        consecutive_snapshots(vehicles)
        .join(by_time, "feed_timestamp", "left")
        .fillna(0, counts)
        .select(
            "feed_timestamp",
            "previous_timestamp",
            "feed_delta_seconds",
            "vehicles_before",
            "vehicles_now",
            *counts,
            _rate(F.col("updated_vehicles"), common).alias("updated_pct"),
            _rate(F.col("position_changes"), common).alias("position_pct"),
        )
    )


def change_examples(changes: DataFrame, limit: int = 10) -> DataFrame:
    return (
        changes.filter("position_changed or timestamp_changed")
        .orderBy("feed_timestamp", "vehicle_id")
        .limit(limit)
    )
