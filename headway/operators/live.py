"""The live board: current vehicles with route, next stop and delay.

Everything is a batch over the newest state of the feeds; the streaming package
keeps that state up to date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway import constants as c
from headway.functions import (
    age_text,
    clean_text,
    clock_text,
    delay_text,
    destination_text,
    live_mode,
    route_sort_key,
)
from headway.operators.picking import keep_first, keep_last


def newest_snapshot(rows: DataFrame) -> DataFrame:
    """Rows of the latest snapshot time, found by a subquery that the scan can
    filter by."""
    return rows.filter(F.col("feed_timestamp") == latest_value(rows, "feed_timestamp"))


def latest_value(rows: DataFrame, name: str) -> Column:
    """The greatest value of a column, as a subquery."""
    return rows.agg(F.max(name)).scalar()


# Static context


def final_stops(stop_times: DataFrame) -> DataFrame:
    """Last scheduled stop per trip; sequences are unique within a trip."""
    return stop_times.groupBy("trip_id").agg(
        F.max_by("stop_id", "stop_sequence").alias("destination_stop_id")
    )


def trip_lines(trips: DataFrame, routes: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Route and the id of the last stop per trip; unmatched parts stay empty."""
    lines = routes.select("route_id", "route_short_name", "route_long_name", "route_type")
    # Ids meet first: names of routes then need not be dealt by trip.
    return (
        trips.select("trip_id", "route_id", "trip_headsign")
        .join(final_stops(stop_times), "trip_id", "left")
        .join(lines, "route_id", "left")
    )


def with_destination_name(lines: DataFrame, stops: DataFrame) -> DataFrame:
    """:func:`trip_lines` with the name of the last stop."""
    named_stops = stops.select(
        F.col("stop_id").alias("destination_stop_id"),
        F.col("stop_name").alias("destination_stop_name"),
    )
    return lines.join(named_stops, "destination_stop_id", "left")


def context_of_lines(lines: DataFrame) -> DataFrame:
    """Mode and destination of :func:`with_destination_name`, from the columns of a row."""
    return lines.select(
        "trip_id",
        "route_id",
        "trip_headsign",
        "route_short_name",
        "route_long_name",
        "route_type",
        "destination_stop_id",
        "destination_stop_name",
        live_mode(F.col("route_type")).alias("transport_mode"),
        destination_text(F.col("trip_headsign"), F.col("destination_stop_name")).alias(
            "destination"
        ),
    )


def trip_context(
    trips: DataFrame, routes: DataFrame, stop_times: DataFrame, stops: DataFrame
) -> DataFrame:
    """Route, mode and destination per trip; unmatched parts stay empty."""
    return context_of_lines(with_destination_name(trip_lines(trips, routes, stop_times), stops))


def trip_stops(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Every scheduled stop of a trip with its name and place."""
    places = stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
    return stop_times.select("trip_id", "stop_id", "stop_sequence").join(places, "stop_id", "left")


def _first_ends(shown: DataFrame, count: int = 2) -> DataFrame:
    """The first destinations of each route, joined to one text."""
    by_first = Window.partitionBy("route_id").orderBy("first_trip", "destination")
    kept = shown.withColumn("place", F.row_number().over(by_first)).filter(
        F.col("place") <= count
    )
    in_order = F.array_sort(F.collect_list(F.struct("place", "destination")))
    return kept.groupBy("route_id").agg(
        F.array_join(F.transform(in_order, lambda d: d["destination"]), c.END_JOINER).alias("ends")
    )


def route_catalog(context: DataFrame, routes: DataFrame) -> DataFrame:
    """A readable label per route: its name and up to two destinations.

    Destinations count in the order of the smallest trip id that shows them,
    since rows of a distributed table have no file order.
    """
    text = clean_text(F.col("destination"))
    shown = (
        context.filter("route_id is not null")
        .select("route_id", "trip_id", text.alias("destination"))
        .filter((F.col("destination") != "") & (F.col("destination") != c.UNKNOWN_DESTINATION))
        .groupBy("route_id", "destination")
        .agg(F.min("trip_id").alias("first_trip"))
    )
    ordered = _first_ends(shown)
    listed = context.select("route_id").filter("route_id is not null").distinct()
    lines = routes.select("route_id", "route_short_name", "route_long_name", "route_type")
    short, long = clean_text(F.col("route_short_name")), clean_text(F.col("route_long_name"))
    id_text = F.col("route_id").cast("string")

    def first_filled(*names: Column) -> Column:
        return F.coalesce(*[F.nullif(name, F.lit("")) for name in names], id_text)

    mode = live_mode(F.col("route_type"))
    primary = F.when(mode.isin(*c.LONG_NAME_MODES), first_filled(long, short)).otherwise(
        first_filled(short, long)
    )
    return (
        listed.join(lines, "route_id", "left")
        .join(ordered, "route_id", "left")
        .select(
            "route_id",
            short.alias("route_short_name"),
            long.alias("route_long_name"),
            mode.alias("transport_mode"),
            F.concat_ws(c.DASH, primary, "ends").alias("route_label"),
        )
    )


# Vehicles


def _trip_number(df: DataFrame) -> Column:
    return df["trip_id"].try_cast("bigint")


def board_vehicles(vehicles: DataFrame, context: DataFrame) -> DataFrame:
    """One row per vehicle (first in the feed) with its trip's context.

    The choice comes after the join, so a trip that the timetable repeats does
    not repeat its vehicle.
    """
    known = context.withColumnRenamed("trip_id", "_trip").withColumnRenamed("route_id", "_route")
    # The context is cut down to the running trips before the outer join, whose
    # preserved side could not be broadcast.
    running = vehicles.select(_trip_number(vehicles).alias("_trip")).distinct()
    known = known.join(running, "_trip", "left_semi")
    joined = vehicles.join(known, _trip_number(vehicles) == known["_trip"], "left").select(
        "vehicle_id",
        "trip_id",
        "latitude",
        "longitude",
        "vehicle_timestamp",
        "entity_index",
        F.col("_route").alias("route_id"),
        F.coalesce("route_short_name", F.lit(c.UNKNOWN_LINE)).alias("route_short_name"),
        "route_long_name",
        F.coalesce("transport_mode", F.lit(c.LIVE_MODE_DEFAULT)).alias("transport_mode"),
        F.coalesce("destination", F.lit(c.UNKNOWN_DESTINATION)).alias("destination"),
    )
    return keep_first(
        joined, ["vehicle_id"], "entity_index", "route_id", "route_short_name", "destination"
    ).drop("entity_index")


def next_stop_by_trip(updates: DataFrame, now: int | Column) -> DataFrame:
    """The earliest stop not yet passed, per trip; feed order settles ties.

    Of several snapshots, each trip's newest counts.
    """
    moment = now if isinstance(now, Column) else F.lit(now)
    event_time = F.coalesce(
        F.nullif("arrival_time", F.lit(0)), F.nullif("departure_time", F.lit(0))
    )
    numbered = updates.withColumn("_trip", F.col("trip_id").try_cast("bigint"))
    if "feed_timestamp" in updates.columns:
        newest = F.max("feed_timestamp").over(Window.partitionBy("_trip"))
        numbered = numbered.withColumn("_newest", newest).filter("feed_timestamp = _newest")
    coming = (
        numbered.withColumn("event_time", event_time)
        .filter((F.col("event_time") >= moment) & F.col("_trip").isNotNull())
    )
    nearest = keep_first(coming, ["_trip"], "event_time", "update_index")
    return nearest.select(
        "_trip",
        F.col("stop_sequence").cast("int").alias("stop_sequence"),
        "event_time",
        F.coalesce("arrival_delay", "departure_delay").alias("delay_seconds"),
    )


def with_next_stop(
    live: DataFrame, updates: DataFrame, stops_of_trips: DataFrame, now: int | Column
) -> DataFrame:
    """Add the next stop; a vehicle without one keeps its position only."""
    coming = next_stop_by_trip(updates, now)
    places = stops_of_trips.select(
        F.col("trip_id").alias("_trip"),
        "stop_sequence",
        F.col("stop_id").alias("next_stop_id"),
        F.col("stop_name").alias("_stop_name"),
    )
    key = ["_trip", "stop_sequence"]
    # The timetable is cut down to the trips at hand before the outer join, whose
    # preserved side could not be broadcast; by trip alone, as its buckets are.
    running = places.join(coming.select("_trip"), "_trip", "left_semi")
    ahead = keep_last(running.join(coming.select(*key), key, "left_semi"), key, "next_stop_id")
    resolved = coming.join(ahead, key, "left").withColumn("_matched", F.lit(True))
    matched = F.col("_matched").isNotNull()
    stop_name = F.coalesce(
        F.nullif(clean_text(F.col("_stop_name")), F.lit("")), F.lit(c.UNKNOWN_STOP)
    )
    return live.join(resolved, _trip_number(live) == resolved["_trip"], "left").select(
        *live.columns,
        F.when(matched, stop_name).otherwise(c.POSITION_ONLY_TEXT).alias("next_stop"),
        clock_text(F.col("event_time")).alias("next_time"),
        delay_text(F.col("delay_seconds")).alias("delay_display"),
        "next_stop_id",
        F.when(matched, c.STATUS_MATCHED)
        .otherwise(c.STATUS_POSITION_ONLY)
        .alias("realtime_status"),
    )


# Board


def shown_on_board(mode: str | None = None, route_id: int | None = None) -> Column:
    """Condition of the board's mode and route filters."""
    by_mode = F.col("transport_mode").isin(*c.VISIBLE_MODES)
    if mode is not None:
        by_mode = F.col("transport_mode") == mode
    return by_mode if route_id is None else by_mode & (F.col("route_id") == route_id)


def vehicle_cards(live: DataFrame, shown: Column | None = None) -> DataFrame:
    """The three text lines of a vehicle."""
    rows = live.filter(shown_on_board() if shown is None else shown)
    detail = F.concat_ws(
        c.DOT,
        F.col("next_stop"),
        F.nullif("next_time", F.lit("")),
        F.nullif("delay_display", F.lit("")),
    )
    return rows.select(
        "vehicle_id",
        F.concat("route_short_name", F.lit(c.ARROW), "destination").alias("title"),
        F.initcap("transport_mode").alias("subtitle"),
        F.concat(F.lit("Next: "), detail).alias("detail"),
    )


def board_kpis(live: DataFrame, shown: Column | None = None) -> DataFrame:
    """Vehicles and routes shown; the match rate is over all live vehicles."""
    visible = F.coalesce(shown_on_board() if shown is None else shown, F.lit(False))
    matched = F.count(F.when(F.col("realtime_status") == c.STATUS_MATCHED, 1))
    return live.agg(
        F.count(F.when(visible, 1)).alias("live_vehicles"),
        F.count_distinct(F.when(visible, F.col("route_id"))).alias("routes_active"),
        F.round(F.lit(100.0) * matched / F.nullif(F.count("*"), F.lit(0)), 1).alias(
            "realtime_pct"
        ),
    )


def observed_routes(*live: DataFrame) -> DataFrame:
    """Route ids seen so far, over any number of board states."""
    ids = [df.select("route_id").filter("route_id is not null") for df in live]
    seen = ids[0]
    for more in ids[1:]:
        seen = seen.union(more)
    return seen.distinct()


def observed_catalog(catalog: DataFrame, seen: DataFrame, shown: Column | None = None) -> DataFrame:
    """Catalog entries of routes seen live, in natural order of their number."""
    rows = catalog.join(seen, "route_id", "left_semi")
    rows = rows.filter(shown_on_board() if shown is None else shown)
    return rows.orderBy(route_sort_key(F.col("route_short_name")), "route_id")


def route_search(catalog: DataFrame, query: str, hits: int = 8) -> DataFrame:
    """Routes whose label contains the query, whatever the case."""
    wanted = query.strip().lower()
    label = F.lower(F.coalesce("route_label", F.lit("")))
    return (
        catalog.filter(label.contains(wanted))
        .orderBy(route_sort_key(F.col("route_short_name")), "route_id")
        .limit(hits)
    )


# Following a vehicle


def followed_vehicles(requested: DataFrame, live: DataFrame, now: int) -> DataFrame:
    """The board row of each requested vehicle, or that it is missing now."""
    rows = live.withColumn("_present", F.lit(True))
    found = requested.select("vehicle_id").join(rows, "vehicle_id", "left")
    return found.select(
        *live.columns,
        age_text(F.col("vehicle_timestamp"), F.lit(now)).alias("updated"),
        F.when(F.col("_present"), "live").otherwise(c.MISSING_VEHICLE_TEXT).alias("follow_status"),
    )


def followed_trip_stops(followed: DataFrame, stops_of_trips: DataFrame) -> DataFrame:
    """Stops with a place along the followed trips, the next one marked."""
    trips = followed.select(
        "vehicle_id", F.col("trip_id").try_cast("bigint").alias("trip_id"), "next_stop_id"
    )
    return (
        stops_of_trips.filter("stop_lat is not null and stop_lon is not null")
        .join(trips, "trip_id")
        .select(
            "vehicle_id",
            "trip_id",
            "stop_sequence",
            "stop_id",
            F.coalesce("stop_name", F.lit(c.UNKNOWN_STOP)).alias("stop_name"),
            "stop_lat",
            "stop_lon",
            F.coalesce(F.col("stop_id") == F.col("next_stop_id"), F.lit(False)).alias(
                "is_next_stop"
            ),
        )
        .orderBy("vehicle_id", "stop_sequence")
    )
