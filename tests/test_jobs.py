import os

import pytest

from headway.operators.history import append_new_snapshots, dedupe_observations
from headway.plans.jobs import observations_of, run_realtime, run_static
from headway.sources.snapshots import read_snapshots
from headway.sources.tables import Catalog, FolderCatalog
from headway.sources.timetable import read_timetable
from headway.streaming.history import observation_stream, snapshot_stream, start_history
from tests.feeds import event, feed, land, payloads, stop, trip

AGENCY = 505000000000000001
FILES = {
    "routes": "route_id,agency_id,route_short_name,route_long_name,route_type,extra\n"
    f"1,{AGENCY},7,Seven,700,x\n"
    "2,500000000000000114,10,Ten,999,x\n"
    f"3,{AGENCY + 1},11,Eleven,106,x\n",
    "trips": "route_id,service_id,trip_id,trip_headsign,direction_id,shape_id\n"
    "1,s,505000000000000101,North,0,a\n"
    "2,s,505000000000000102,,1,a\n"
    "3,s,505000000000000103,West,,a\n",
    "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
    "505000000000000101,08:00:00,08:00:30,11,1\n"
    "505000000000000101,25:30:00,,12,2\n"
    "505000000000000102,,8:3,12,1\n"
    "505000000000000103,09:00:00,09:00:00,13,1\n",
    "stops": "stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station,platform_code\n"
    "11,A,59.1,18.1,0,,1\n12,B,59.2,18.2,,P,\n13,C,59.3,18.3,0,,\n14,D,59.4,18.4,0,,\n",
}
KNOWN = "505000000000000101"


@pytest.fixture
def timetable(folder):
    os.makedirs(f"{folder}/gtfs")
    for name, text in FILES.items():
        with open(f"{folder}/gtfs/{name}.txt", "w") as file:
            file.write(text)
    return f"{folder}/gtfs"


@pytest.fixture
def catalog(spark, folder):
    return FolderCatalog(spark, f"{folder}/lake")


def test_scan_goes_by_header_names(spark, timetable):
    df = read_timetable(spark, timetable, "routes", ["route_id", "agency_id"])
    assert [tuple(r) for r in df.filter("route_id = 1").collect()] == [(1, AGENCY)]
    assert dict(df.dtypes) == {"route_id": "bigint", "agency_id": "bigint"}
    times = read_timetable(spark, timetable, "stop_times")
    assert dict(times.dtypes)["arrival_time"] == "string"


def test_doubled_quotes(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/stops.txt", "w") as file:
        file.write(FILES["stops"].replace("11,A,", '11,"The ""A"", north",'))
    names = [r.stop_name for r in read_timetable(spark, folder, "stops").collect()]
    assert names == ['The "A", north', "B", "C", "D"]


def test_missing_column_is_named(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/trips.txt", "w") as file:
        file.write("route_id,trip_id\n1,2\n")
    with pytest.raises(ValueError, match="service_id"):
        read_timetable(spark, folder, "trips")


def test_optional_columns_may_be_absent(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/stops.txt", "w") as file:
        file.write("stop_id,stop_name,stop_lat,stop_lon\n1,A,59.0,18.0\n")
    row = read_timetable(spark, folder, "stops").first()
    assert (row.stop_id, row.stop_name, row.platform_code, row.location_type) == (1, "A", None, None)
    with open(f"{folder}/trips.txt", "w") as file:
        file.write("route_id,trip_id\n1,2\n")
    some = read_timetable(spark, folder, "trips", ["trip_id", "trip_headsign"])
    assert [tuple(r) for r in some.collect()] == [(2, None)]


def test_static_job(spark, timetable, catalog):
    tables = run_static(spark, timetable, catalog)
    modes = {r.route_id: r.transport_mode for r in tables["routes"].collect()}
    assert modes == {1: "bus", 2: "unknown"}
    trips = {r.trip_id for r in tables["trips"].collect()}
    assert trips == {505000000000000101, 505000000000000102}
    seconds = {
        (r.trip_id % 1000, r.stop_sequence): (r.arrival_seconds, r.departure_seconds)
        for r in tables["stop_events"].collect()
    }
    assert seconds == {(101, 1): (28800, 28830), (101, 2): (91800, None), (102, 1): (None, None)}
    assert {r.stop_id for r in tables["stops"].collect()} == {11, 12}
    assert catalog.exists("stops") and not catalog.exists("realtime_stop_events")


def test_repeated_route_keys_do_not_repeat_trips(spark, timetable):
    from headway.operators.scope import trips_in_scope

    trips = read_timetable(spark, timetable, "trips")
    routes = read_timetable(spark, timetable, "routes")
    assert trips_in_scope(trips, routes.union(routes)).count() == 3


def snapshot(timestamp, *sequences, trip_id=KNOWN):
    stops = [stop(i, "11", arrival=event(timestamp, 5)) for i in sequences]
    return feed(timestamp, trip(trip_id, *stops))


def test_realtime_job_appends_once(spark, timetable, catalog):
    run_static(spark, timetable, catalog)
    first = payloads(spark, snapshot(1000, 1, 2), snapshot(100_000, 1))
    run_realtime(first, catalog)
    assert catalog.read("realtime_stop_events").count() == 3
    run_realtime(first, catalog)
    assert catalog.read("realtime_stop_events").count() == 3
    more = payloads(spark, snapshot(1000, 1, 2, 3), snapshot(500, 1))
    run_realtime(more, catalog)
    history = catalog.read("realtime_stop_events")
    # The known snapshot is skipped whole, the older new one is taken.
    assert history.count() == 4
    assert {str(r.feed_date) for r in history.collect()} == {"1970-01-01", "1970-01-02"}


def test_realtime_job_on_a_metastore(spark, timetable):
    spark.sql("create database if not exists rt_test")
    catalog = Catalog(spark, "rt_test")
    run_static(spark, timetable, catalog)
    assert not catalog.exists("realtime_stop_events")
    for _ in range(2):
        run_realtime(payloads(spark, snapshot(1000, 1, 2)), catalog)
    assert catalog.read("realtime_stop_events").count() == 2
    assert set(catalog.silver()) == {
        "routes",
        "trips",
        "stop_events",
        "stops",
        "realtime_stop_events",
    }


def test_scope_drops_unknown_and_malformed_trips(spark, timetable, catalog):
    trips = run_static(spark, timetable, catalog)["trips"]
    rows = observations_of(
        payloads(
            spark,
            snapshot(5, 1),
            snapshot(5, 1, trip_id="9"),
            snapshot(5, 1, trip_id="x-1"),
            snapshot(5, 1, trip_id="505000000000000103"),
        ),
        trips,
    )
    assert [r.trip_id for r in rows.collect()] == [KNOWN]


def test_empty_scope_appends_nothing(spark, timetable, catalog):
    run_static(spark, timetable, catalog)
    run_realtime(payloads(spark, snapshot(5, 1)), catalog)
    run_realtime(payloads(spark, snapshot(6, 1, trip_id="9")), catalog)
    assert catalog.read("realtime_stop_events").count() == 1


def test_strictness(spark, timetable, catalog):
    run_static(spark, timetable, catalog)
    mixed = payloads(spark, feed(7), snapshot(8, 1), feed(None, trip(KNOWN, stop())))
    with pytest.raises(Exception, match="feed without"):
        run_realtime(mixed, catalog)
    run_realtime(mixed, catalog, strict=False)
    assert catalog.read("realtime_stop_events").count() == 1


def test_dedupe_is_stable_and_takes_null_as_a_key(spark):
    rows = [(1, "a", None, "x"), (1, "a", None, "y"), (1, "a", 1, "z"), (1, "a", 1, "y")]
    schema = "feed_timestamp long, trip_id string, stop_sequence long, stop_id string"
    got = set()
    for order in (rows, rows[::-1]):
        df = dedupe_observations(spark.createDataFrame(order, schema))
        got.add(tuple(sorted((r.stop_sequence is None, r.stop_id) for r in df.collect())))
    assert got == {((False, "y"), (True, "x"))}


def test_stream_equals_batch(spark, timetable, catalog, folder):
    trips = run_static(spark, timetable, catalog)["trips"]
    landing = f"{folder}/landing"
    for i in range(5):
        land(landing, "2024-01-01", i, f"a{i}.pb", snapshot(1000 + i // 2, 1, i + 1))

    def run():
        observations = observation_stream(snapshot_stream(spark, landing, 2), trips)
        start_history(observations, catalog, f"{folder}/checkpoint").awaitTermination()

    run()
    run()
    times = sorted(r[0] for r in catalog.read("realtime_stop_events").select(
        "feed_timestamp").distinct().selectExpr("unix_seconds(feed_timestamp)").collect())
    assert times == [1000, 1001, 1002]
    before = catalog.read("realtime_stop_events").count()
    land(landing, "2024-01-02", 0, "late.pb", snapshot(10, 1))
    run()
    assert catalog.read("realtime_stop_events").count() == before + 1
    batch = FolderCatalog(spark, f"{folder}/batch")
    files = read_snapshots(spark, landing).filter("path like '%late.pb'")
    append_new_snapshots(observations_of(files, trips), batch)
    assert batch.read("realtime_stop_events").count() == 1
