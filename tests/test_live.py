from headway.operators import flatten, inspect, live
from headway.sources.feed import decode_feed
from headway.streaming import live as streams
from tests.feeds import event, feed, payloads, stop, trip, vehicle

NOW = 1704067200


def network(spark):
    routes = spark.createDataFrame(
        [(1, "10X", "Ten", 700), (2, "7", "Seven", 401), (3, "B1", None, 999)],
        "route_id long, route_short_name string, route_long_name string, route_type int",
    )
    trips = spark.createDataFrame(
        [(11, 1, "North "), (12, 1, " "), (13, 2, None), (14, 1, "South"), (15, 9, "Lost"),
         (16, 3, "Depot")],
        "trip_id long, route_id long, trip_headsign string",
    )
    times = spark.createDataFrame(
        [(11, 1, 1), (11, 2, 2), (12, 1, 1), (12, 3, 5), (13, 77, 1), (14, 1, 1)],
        "trip_id long, stop_id long, stop_sequence int",
    )
    stops = spark.createDataFrame(
        [(1, "One", 59.1, 18.1), (2, "Two", 59.2, 18.2), (3, "Three", None, 18.3)],
        "stop_id long, stop_name string, stop_lat double, stop_lon double",
    )
    return trips, routes, times, stops


def board(spark, vehicles, updates=()):
    trips, routes, times, stops = network(spark)
    decoded = decode_feed(payloads(spark, feed(NOW, *vehicles)))
    rows = live.board_vehicles(
        live.newest_snapshot(flatten.vehicle_rows(decoded)),
        live.trip_context(trips, routes, times, stops),
    )
    state = flatten.trip_update_state(decode_feed(payloads(spark, feed(NOW, *updates))))
    return live.with_next_stop(
        rows, flatten.stop_update_rows(state), live.trip_stops(times, stops), NOW
    )


def test_context(spark):
    got = {r.trip_id: r for r in live.trip_context(*network(spark)).collect()}
    assert got[11].destination == "North" and got[11].transport_mode == "bus"
    assert got[12].destination == "Three"
    assert got[13].destination == "Unknown destination" and got[13].transport_mode == "subway"
    assert got[15].transport_mode == "other" and got[15].route_short_name is None


def test_catalog_and_search(spark):
    trips, routes, times, stops = network(spark)
    catalog = live.route_catalog(live.trip_context(trips, routes, times, stops), routes)
    labels = {r.route_id: r.route_label for r in catalog.collect()}
    assert labels == {1: "10X — North ↔ Three", 2: "Seven", 3: "B1 — Depot", 9: "9 — Lost"}
    hits = live.route_search(catalog, " NORTH ").collect()
    assert [h.route_id for h in hits] == [1]
    assert [h.route_id for h in live.route_search(catalog, "", hits=3).collect()] == [2, 1, 9]
    assert live.route_search(catalog, "1.X").count() == 0
    seen = live.observed_routes(catalog.filter("route_id < 3"), catalog.filter("route_id = 2"))
    assert [r.route_id for r in live.observed_catalog(catalog, seen).collect()] == [2, 1]


def test_next_stop(spark):
    vehicles = [
        vehicle("a", "11"),
        vehicle("a", "14"),
        vehicle("b", "12"),
        vehicle("c", "999"),
        vehicle("d", "13"),
    ]
    updates = [
        trip(
            "11",
            stop(1, arrival=event(NOW - 1, 5)),
            stop(2, arrival=event(NOW, 90)),
            stop(3, arrival=event(NOW + 5, 1)),
        ),
        trip("12", stop(9, arrival=event(0), departure=event(NOW + 60, -90))),
        trip("13", stop(1, arrival=event(NOW - 60))),
    ]
    got = {r.vehicle_id: r for r in board(spark, vehicles, updates).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    a = got["a"]
    assert (a.trip_id, a.next_stop, a.next_time) == ("11", "Two", "01:00")
    assert (a.delay_display, a.next_stop_id, a.realtime_status) == ("2 min late", 2, "trip_update")
    assert (got["b"].next_stop, got["b"].delay_display) == ("Unknown stop", "2 min early")
    for missing in ("c", "d"):
        assert got[missing].next_stop == "Live position available"
        assert got[missing].realtime_status == "position_only"
        assert got[missing].next_time == "" and got[missing].delay_display == ""
    assert (got["c"].route_short_name, got["c"].transport_mode) == ("Unknown", "other")


def test_repeated_timetable_rows_do_not_repeat_vehicles(spark):
    trips, routes, times, stops = network(spark)
    decoded = decode_feed(payloads(spark, feed(NOW, vehicle("a", "11"))))
    context = live.trip_context(trips.union(trips), routes, times, stops)
    rows = live.board_vehicles(flatten.vehicle_rows(decoded), context)
    state = flatten.trip_update_state(
        decode_feed(payloads(spark, feed(NOW, trip("11", stop(2, arrival=event(NOW))))))
    )
    places = live.trip_stops(times.union(times), stops)
    board = live.with_next_stop(rows, flatten.stop_update_rows(state), places, NOW)
    assert [(r.vehicle_id, r.next_stop) for r in board.collect()] == [("a", "Two")]


def test_cards_and_kpis(spark):
    vehicles = [vehicle("a", "11"), vehicle("b", "14"), vehicle("c", "999")]
    updates = [trip("11", stop(2, arrival=event(NOW + 60, 0)))]
    rows = board(spark, vehicles, updates)
    cards = {r.vehicle_id: r for r in live.vehicle_cards(rows).collect()}
    assert set(cards) == {"a", "b"}
    assert cards["a"].title == "10X → North" and cards["a"].subtitle == "Bus"
    assert cards["a"].detail == "Next: Two · 01:01 · On time"
    assert cards["b"].detail == "Next: Live position available"
    assert tuple(live.board_kpis(rows).first()) == (2, 1, 33.3)
    assert tuple(live.board_kpis(rows, live.shown_on_board("subway")).first()) == (0, 0, 33.3)
    assert live.board_kpis(rows, live.shown_on_board(route_id=1)).first().live_vehicles == 2


def test_following(spark):
    trips, routes, times, stops = network(spark)
    rows = board(
        spark, [vehicle("a", "12", timestamp=NOW)], [trip("12", stop(1, arrival=event(NOW)))]
    )
    asked = spark.createDataFrame([("a",), ("gone",)], "vehicle_id string")
    got = {r.vehicle_id: r for r in live.followed_vehicles(asked, rows, NOW + 61).collect()}
    assert (got["a"].follow_status, got["a"].updated) == ("live", "1 min ago")
    assert (got["gone"].follow_status, got["gone"].updated) == ("temporarily missing", "Unknown")
    along = live.followed_trip_stops(rows, live.trip_stops(times, stops)).collect()
    assert [(r.stop_name, r.is_next_stop) for r in along] == [("One", True)]


def test_feed_inspection(spark):
    trips, routes, _, _ = network(spark)
    first = feed(100, vehicle("a", "11"), vehicle("b"), vehicle("c", "12"), vehicle("d", "8"))
    second = feed(
        110,
        vehicle("a", "11"),
        vehicle("b", position=(1.0, 2.0)),
        vehicle("c", "12", timestamp=101),
    )
    loose = flatten.vehicle_rows(
        decode_feed(payloads(spark, first, second)), require_trip=False, require_position=False
    )
    profile = {r.feed_timestamp: tuple(r)[1:] for r in inspect.missing_trip_profile(loose).collect()}
    assert profile == {100: (4, 3, 1, 25.0), 110: (3, 2, 1, 33.3)}
    assert [r.vehicle_id for r in inspect.missing_trip_examples(loose).collect()] == ["b", "b"]
    by_id = flatten.vehicles_by_id(loose)
    changes = inspect.vehicle_changes(by_id)
    fresh = inspect.feed_freshness(by_id).collect()
    assert [tuple(r) for r in fresh] == [(110, 100, 10, 4, 3, 3, 2, 1, 1, 66.7, 33.3)]
    assert [r.vehicle_id for r in inspect.change_examples(changes).collect()] == ["b", "c"]

    updates = decode_feed(payloads(spark, feed(110, trip("11", stop(1), stop(2)), trip("50"))))
    at_first = flatten.vehicles_by_trip(loose.filter("feed_timestamp = 100"))
    overlap = inspect.feed_overlap(at_first, flatten.feed_trip_ids(updates)).first()
    assert tuple(overlap) == (3, 2, 1, 33.3)
    shown = inspect.overlap_examples(at_first, flatten.trip_update_state(updates), stops=1).collect()
    assert [(r.trip_id, r.stop_update_count, len(r.first_stop_updates)) for r in shown] == [
        ("11", 2, 1)
    ]

    twice = trips.union(trips)
    matches = inspect.route_match(at_first, twice, routes)
    assert tuple(inspect.route_match_summary(matches).first()) == (3, 2, 1, 66.7)
    assert [r.trip_id for r in inspect.route_match_examples(matches, False).collect()] == ["8"]
    assert inspect.route_match_examples(matches, True).count() == 2


def test_freshness_of_irregular_snapshots(spark):
    feeds = [
        feed(1000, vehicle("a", "11"), vehicle("b", "12")),
        feed(1011, vehicle("a", "11", position=(1.0, 2.0))),
        feed(1020, vehicle("b", "12")),
    ]
    rows = flatten.vehicle_rows(decode_feed(payloads(spark, *feeds)))
    fresh = inspect.feed_freshness(flatten.vehicles_by_id(rows)).orderBy("feed_timestamp")
    assert [tuple(r) for r in fresh.collect()] == [
        (1011, 1000, 11, 2, 1, 1, 1, 1, 0, 100.0, 100.0),
        (1020, 1011, 9, 1, 1, 0, 0, 0, 0, None, None),
    ]


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_vehicle_streams(spark, folder):
    trips, routes, times, stops = network(spark)
    feeds = [
        feed(2, vehicle("a", "11", timestamp=9), vehicle("b", "13", timestamp=1)),
        feed(3, vehicle("a", "12", timestamp=2), vehicle("c", "999", timestamp=2)),
        # Older than what is known by then.
        feed(1, vehicle("a", "13", timestamp=30), vehicle("b", "11", timestamp=30)),
    ]
    source = f"{folder}/in"
    state, board_folder, known = f"{folder}/state", f"{folder}/board", f"{folder}/known"

    def stream():
        schema = flatten.vehicle_rows(decode_feed(payloads(spark, feeds[0]))).schema
        return spark.readStream.schema(schema).parquet(source)

    context = live.trip_context(trips, routes, times, stops)
    for message in feeds:
        arrived = flatten.vehicle_rows(decode_feed(payloads(spark, message)))
        arrived.coalesce(1).write.mode("append").parquet(source)
        streams.start_vehicle_state(stream(), state, f"{folder}/c1").awaitTermination()
        streams.start_known_routes(stream(), trips, known, f"{folder}/c2").awaitTermination()
        streams.start_live_board(
            stream(),
            lambda: spark.createDataFrame(
                [],
                "trip_id string, update_index int, stop_sequence int, arrival_time long,"
                " arrival_delay int, departure_time long, departure_delay int",
            ),
            context,
            live.trip_stops(times, stops),
            lambda: NOW,
            board_folder,
            f"{folder}/c3",
        ).awaitTermination()
    now = {r.vehicle_id: r.trip_id for r in streams.read_last_batch(spark, state).collect()}
    assert now == {"a": "12", "b": "13", "c": "999"}
    assert sorted(r.route_id for r in streams.read_last_batch(spark, known).collect()) == [1, 2]
    last = {r.vehicle_id for r in streams.read_last_batch(spark, board_folder).collect()}
    assert last == {"a", "c"}
