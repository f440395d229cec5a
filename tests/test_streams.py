"""The live job over both feeds, its stored tables, slots and payload files."""

import os

import pytest
from pyspark.sql import functions as F

from headway.operators import live
from headway.plans import jobs
from headway.plans.jobs import TRIP_CONTEXT, TRIP_STOPS, write_board_tables
from headway.registry.encode import encode_feed
from headway.sources.payload_files import write_payload_files
from headway.sources.snapshots import archive_files, read_snapshots
from headway.sources.tables import Catalog, FolderCatalog
from headway.streaming import live as streams
from headway.streaming.history import snapshot_stream
from headway.streaming.slots import Slots, each_once
from tests.feeds import event, feed, land, stop, trip, vehicle
from tests.test_live import NOW, network


def board_of(spark, folder):
    rows = streams.read_board(spark, f"{folder}/board").collect()
    return {r.vehicle_id: (r.trip_id, r.next_stop, r.delay_display) for r in rows}


@pytest.fixture
def tables(spark, folder):
    trips, routes, times, stops = network(spark)
    catalog = FolderCatalog(spark, f"{folder}/tables")
    return write_board_tables(trips, routes, times, stops, catalog)


def test_live_job_merges_feeds_and_withstands_late_ones(spark, folder, tables):
    landing, clock, asked = f"{folder}/landing", [NOW], []

    def now():
        asked.append(clock[0])
        return clock[0]

    def run(**settings):
        parts = [snapshot_stream(spark, f"{landing}/{p}") for p in ("vehicles", "updates")]
        streams.start_live_job(
            parts[0].unionByName(parts[1]), tables[TRIP_CONTEXT], tables[TRIP_STOPS], now,
            f"{folder}/board", f"{folder}/checkpoint", **settings,
        ).awaitTermination()

    def put(part, name, message):
        land(f"{landing}/{part}", "2024-01-01", 0, name, message)

    coming = lambda late: stop(1, "1", arrival=event(NOW + 60 + late, late))
    put("vehicles", "a.pb", feed(100, vehicle("a", "11"), vehicle("b", "12"), vehicle("x", None)))
    put("updates", "a.pb", feed(100, trip("11", coming(120)), trip("12", coming(0))))
    run()
    first = board_of(spark, folder)
    assert set(first) == {"a", "b"}
    assert first["a"][2] == "2 min late" and first["b"][2] == "On time"
    # New positions alone: the updates of before still hold.
    put("vehicles", "b.pb", feed(110, vehicle("a", "11"), vehicle("c", "12")))
    run()
    assert board_of(spark, folder) == {"a": first["a"], "c": ("12", *first["b"][1:])}
    # Late and broken payloads change nothing.
    before = board_of(spark, folder)
    put("vehicles", "c.pb", feed(105, vehicle("z", "11")))
    put("updates", "c.pb", feed(90, trip("11", coming(600))))
    os.makedirs(f"{landing}/updates/ingestion_date=2024-01-01/hour=01", exist_ok=True)
    with open(f"{landing}/updates/ingestion_date=2024-01-01/hour=01/d.pb", "wb") as file:
        file.write(b"\xff\xff\xff")
    run()
    assert board_of(spark, folder) == before
    # A trip's newest state replaces its own only, and expires when it is not reported.
    put("updates", "e.pb", feed(120, trip("11", coming(300))))
    run(keep_seconds=20)
    now_shown = board_of(spark, folder)
    assert now_shown["a"][2] == "5 min late" and now_shown["c"] == before["c"]
    put("updates", "f.pb", feed(200, trip("99", coming(0))))
    run(keep_seconds=20)
    assert {v[2] for v in board_of(spark, folder).values()} == {""}
    # Nothing landed: nothing is asked and the board stays.
    asked.clear()
    run()
    assert asked == [] and len(board_of(spark, folder)) == 2


def test_known_trip_without_its_own_stops(spark, tables):
    assert tables[TRIP_CONTEXT].count() == tables[TRIP_CONTEXT].select("trip_id").distinct().count()


def test_newest_snapshot_of_a_trip_counts(spark):
    rows = [(1, "11", 0, 1, NOW + 50, 0), (1, "11", 1, 2, NOW + 80, 0), (2, "11", 0, 2, NOW + 90, 7),
            (1, "12", 0, 1, NOW + 10, 3)]
    updates = spark.createDataFrame(
        rows, "feed_timestamp long, trip_id string, update_index int, stop_sequence int,"
        " arrival_time long, arrival_delay int",
    ).selectExpr("*", "cast(null as long) as departure_time", "cast(null as int) as departure_delay")
    got = {r["_trip"]: (r.stop_sequence, r.event_time) for r in live.next_stop_by_trip(updates, NOW).collect()}
    assert got == {11: (2, NOW + 90), 12: (1, NOW + 10)}


def test_board_tables_are_dealt_by_ids(spark, folder, monkeypatch):
    """Names of few stops are added after the exchange; with many the rows are the same."""
    dealt = {}

    class Watched(FolderCatalog):
        def replace_bucketed(self, df, table, *rest):
            dealt[table] = set(df.columns)
            return super().replace_bucketed(df, table, *rest)

    trips, routes, times, stops = network(spark)
    # Rows that repeat a stop repeat those of its trips.
    stops = stops.union(stops.limit(1))
    want = {
        TRIP_CONTEXT: live.trip_context(trips, routes, times, stops),
        TRIP_STOPS: live.trip_stops(times, stops),
    }
    for most in (jobs.MOST_SENT_STOPS, 0):
        monkeypatch.setattr(jobs, "MOST_SENT_STOPS", most)
        catalog = Watched(spark, f"{folder}/few-{most}")
        tables = write_board_tables(trips, routes, times, stops, catalog)
        for name, df in want.items():
            assert tables[name].columns == df.columns
            assert sorted(map(repr, tables[name].collect())) == sorted(map(repr, df.collect()))
            names = {"stop_name", "stop_lat", "destination_stop_name"} if most else set()
            assert not dealt[name] & (names | {"destination"})


def test_board_does_not_shuffle_the_timetable(spark, folder):
    name = f"board_{abs(hash(folder)) % 10**9}"
    spark.sql(f"create database {name}")
    trips, routes, times, stops = network(spark)
    stored = write_board_tables(trips, routes, times, stops, Catalog(spark, name))
    vehicles = spark.createDataFrame(
        [("a", "11", 59.0, 18.0, 9, 0)],
        "vehicle_id string, trip_id string, latitude double, longitude double,"
        " vehicle_timestamp long, entity_index int",
    )
    updates = spark.createDataFrame(
        [("11", 0, 1, NOW + 5, 0)],
        "trip_id string, update_index int, stop_sequence int, arrival_time long, arrival_delay int",
    ).selectExpr("*", "cast(null as long) as departure_time", "cast(null as int) as departure_delay")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        # Many running trips: nothing is broadcast, the timetable is read by bucket.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = live.board_vehicles(vehicles, stored[TRIP_CONTEXT])
        board = live.with_next_stop(rows, updates, stored[TRIP_STOPS], NOW)
        plan = board._jdf.queryExecution().executedPlan().toString()
        # Between a scan and the join that cuts it down there is no exchange.
        above, found = [], []
        for line in plan.splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            above = [(d, text) for d, text in above if d < depth]
            if "FileScan" in line:
                own = [text for _, text in reversed(above)]
                joined = next(i for i, text in enumerate(own) if "Join" in text)
                found.append((any("Exchange" in text for text in own[:joined]), "LeftSemi" in own[joined]))
                assert "Bucketed: true" in line
            above.append((depth, line))
        assert found == [(False, True)] * 2, plan
        assert board.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.sql(f"drop database {name} cascade")


def test_hundred_batches_leave_two_folders(spark, folder):
    place = f"{folder}/slots"

    def write(slots, batch, batch_id):
        slots.put(batch_id, batch)
        return batch_id % 10 != 5

    put = each_once(place, write)
    for batch_id in range(100):
        put(spark.range(batch_id, batch_id + 1, numPartitions=1), batch_id)
        last = batch_id - 1 if batch_id % 10 == 5 else batch_id
        if batch_id % 9 == 0:
            assert [r.id for r in Slots(spark, place).read().collect()] == [last]
    assert sorted(os.listdir(f"{place}/rows")) == ["slot=0", "slot=1"]
    files = Slots(spark, place).read().inputFiles()
    assert len(files) == 1 and "slot=1" in files[0]
    # A finished batch that comes again is not written again.
    put(spark.range(5), 99)
    assert Slots(spark, place).read().count() == 1


def test_lost_batch_does_not_show(spark, folder):
    slots = Slots(spark, f"{folder}/slots")
    with pytest.raises(FileNotFoundError):
        slots.read()
    slots.put(0, spark.range(1))
    slots.finish(0)
    slots.put(1, spark.range(7))
    assert slots.read().count() == 1
    slots.put(1, spark.range(9))
    slots.finish(1)
    assert (slots.last(), slots.read().count()) == (1, 9)


def test_payload_files_keep_every_byte(spark, folder):
    contents = [bytes(range(256)) * 40, b"", encode_feed(feed(1, vehicle("a"))), b"\n\r\0", None]
    rows = [(f"day=1/f{i}.pb", c) for i, c in enumerate(contents)]
    frame = spark.createDataFrame(rows, "file string, content binary").repartition(3)
    write_payload_files(frame, folder)
    # Again, as a repeated task would.
    write_payload_files(frame.limit(2), folder)
    found = read_snapshots(spark, folder).select("path", "content").collect()
    # Spark's reader passes over files without a byte; they are there all the same.
    assert {os.path.basename(r.path): bytes(r.content) for r in found} == {
        f"f{i}.pb": c for i, c in enumerate(contents) if c
    }
    names = {n for n in os.listdir(f"{folder}/day=1")}
    assert names == {f"f{i}.pb" for i in range(len(contents))}


def test_archived_files_lie_by_day_and_hour(spark, folder):
    rows = [(90_000, bytearray(b"one")), (7_199, bytearray(b"two"))]
    frame = spark.createDataFrame(rows, "at long, content binary")
    archived = archive_files(frame, folder, F.timestamp_seconds("at"))
    got = {(str(r.ingestion_date), r.hour): (os.path.basename(r.path), bytes(r.content))
           for r in archived.collect()}
    assert got == {
        ("1970-01-02", 1): ("trip_updates_010000.pb", b"one"),
        ("1970-01-01", 1): ("trip_updates_015959.pb", b"two"),
    }
    frame.sparkSession.sql("select 1")
    with pytest.raises(Exception, match="only added"):
        frame.selectExpr("'x' as file", "content").write.format("payload_files").mode("overwrite").save(folder)
