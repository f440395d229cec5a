"""A small hand-written network: two routes, three trips, four stops."""

import datetime

DAY = datetime.date(2024, 1, 7)
MIDNIGHT = 1704585600  # of DAY, UTC

ROUTES = [(1, "7", "Line seven", 700, "bus"), (2, "10", "Line ten", 401, "subway")]
TRIPS = [(100, 1, "s", "North", 0, "x"), (101, 1, "s", "South", 1, "x"), (200, 2, "s", "E", None, "y")]
STOPS = [(i, f"Stop {i}") for i in range(1, 5)]


def when(seconds):
    if seconds is None:
        return None
    return datetime.datetime.fromtimestamp(seconds, datetime.timezone.utc)


def schedule(trip, count=4, start=8 * 3600):
    return [
        (trip, i, i, f"t{i}", f"d{i}", start + 60 * i, start + 60 * i + 20)
        for i in range(1, count + 1)
    ]


def seen(trip, sequence, delay, closeness=0, stop=None, day=DAY, arrival=True, base=8 * 3600):
    """A feed row whose snapshot is ``closeness`` seconds after the arrival."""
    at = MIDNIGHT + base + 60 * sequence
    return (
        str(trip),
        str(sequence if stop is None else stop),
        sequence,
        when(at) if arrival else None,
        when(at + 20),
        delay,
        delay,
        when(at + closeness),
        day,
    )


def tables(spark, observations, routes=ROUTES, trips=TRIPS, stops=STOPS, events=None):
    if events is None:
        events = [row for trip in trips for row in schedule(trip[0])]
    return {
        "routes": spark.createDataFrame(
            routes,
            "route_id long, route_short_name string, route_long_name string, route_type int,"
            " transport_mode string",
        ),
        "trips": spark.createDataFrame(
            trips,
            "trip_id long, route_id long, service_id string, trip_headsign string,"
            " direction_id int, shape_id string",
        ),
        "stops": spark.createDataFrame(stops, "stop_id long, stop_name string"),
        "stop_events": spark.createDataFrame(
            events,
            "trip_id long, stop_sequence int, stop_id long, arrival_time_raw string,"
            " departure_time_raw string, arrival_seconds int, departure_seconds int",
        ),
        "realtime_stop_events": spark.createDataFrame(
            observations,
            "trip_id string, stop_id string, stop_sequence long, arrival_time_actual timestamp,"
            " departure_time_actual timestamp, arrival_delay_seconds long,"
            " departure_delay_seconds long, feed_timestamp timestamp, start_date date",
        ),
    }
