"""Text ids: the dictionary, and whole jobs over files that use them."""

import os

import pytest

from headway.operators.ids import (
    DICTIONARY,
    extend_dictionary,
    id_texts,
    numbered,
    numbered_texts,
    numbers_of,
    read_dictionary,
    with_texts,
)
from headway.operators.history import read_history
from headway.operators.observations import canonical_events_from_history
from headway.plans.jobs import run_realtime, run_static
from headway.sources.tables import FolderCatalog
from tests.feeds import event, feed, payloads, stop, trip

ODD = ["R1", "r1", " 7", "007", "7", "-5", "9223372036854775807", "9223372036854775808", "", "é", None]


@pytest.fixture
def catalog(spark, folder):
    return FolderCatalog(spark, f"{folder}/lake")


def frame(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, trip_id string")


def test_numbers_are_one_to_one_and_stay(spark, catalog):
    assert read_dictionary(catalog).count() == 0
    extend_dictionary(catalog, id_texts(frame(spark, *ODD)))
    first = {r.text: r.id for r in read_dictionary(catalog).collect()}
    # Plain numbers stand for themselves; everything else is below 0 and different.
    assert set(first) == {t for t in ODD if t is not None} - {"7", "9223372036854775807"}
    assert len(set(first.values())) == len(first) and max(first.values()) < 0
    extend_dictionary(catalog, id_texts(frame(spark, "R2", "R1", "é", "R3")))
    extend_dictionary(catalog, id_texts(frame(spark, "R3")))
    later = {r.text: r.id for r in catalog.read(DICTIONARY).collect()}
    assert {t: later[t] for t in first} == first and set(later) - set(first) == {"R2", "R3"}
    assert len(set(later.values())) == len(later) == read_dictionary(catalog).count()
    got = {r.n: r.trip_id for r in numbered(frame(spark, *ODD, "new"), read_dictionary(catalog)).collect()}
    assert got[4] == 7 and got[6] == 9223372036854775807 and got[0] == later["R1"]
    assert got[10] is None and got[11] is None and len(got) == 12
    back = with_texts(numbered(frame(spark, *ODD), read_dictionary(catalog)), read_dictionary(catalog))
    assert {r.n: r.trip_id for r in back.collect()} == dict(enumerate(ODD))


def test_kinds_do_not_mix(spark, catalog):
    both = spark.createDataFrame([("X", "X")], "trip_id string, stop_id string")
    extend_dictionary(catalog, id_texts(both))
    row = numbered(both, read_dictionary(catalog)).first()
    assert row.trip_id != row.stop_id
    assert numbers_of(read_dictionary(catalog), "stop", ["X", "12", "none"]) in (
        [12, row.stop_id], [row.stop_id, 12])


def test_feed_ids_that_look_like_given_numbers(spark, catalog):
    extend_dictionary(catalog, id_texts(frame(spark, "T1")))
    number = read_dictionary(catalog).first().id
    rows = frame(spark, "T1", str(number), "12", "gone", None)
    got = {r.n: r.trip_id for r in numbered_texts(rows, read_dictionary(catalog)).collect()}
    assert got == {0: str(number), 1: f"?{number}", 2: "12", 3: "gone", 4: None}


FILES = {
    "routes": "route_id,agency_id,route_short_name,route_long_name,route_type\n"
    "R1,SE:a,1,One,700\n2,SE:b,2,Two,401\nR9,other,9,Nine,700\n",
    "trips": "route_id,service_id,trip_id,trip_headsign,direction_id,shape_id\n"
    "R1,s,T-1,North,0,a\n2,s,77,South,1,b\nR9,s,T-9,East,0,c\n",
    "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
    "T-1,08:00:00,08:00:30,Place:1,1\nT-1,08:10:00,08:10:30,12,2\n"
    "77,09:00:00,09:00:30,Place:1,1\nT-9,09:00:00,09:00:00,12,1\n",
    "stops": "stop_id,stop_name,stop_lat,stop_lon\nPlace:1,First,59.1,18.1\n12,Second,59.2,18.2\n",
}


def test_jobs_over_text_ids(spark, folder, catalog):
    os.makedirs(f"{folder}/gtfs")
    for name, text in FILES.items():
        with open(f"{folder}/gtfs/{name}.txt", "w") as file:
            file.write(text)
    run_static(spark, f"{folder}/gtfs", catalog, ["SE:a", "SE:b"], text_ids=True)
    before = sorted(map(str, read_dictionary(catalog).collect()))
    tables = run_static(spark, f"{folder}/gtfs", catalog, ["SE:a", "SE:b"], text_ids=True)
    assert sorted(map(str, read_dictionary(catalog).collect())) == before
    assert tables["trips"].count() == 2 and tables["stop_events"].count() == 3
    at = 1_704_700_000
    update = lambda i, s: stop(i, s, arrival=event(at, 60 * i))
    message = feed(at, trip("T-1", update(1, "Place:1"), update(2, "12")), trip("77", update(1, "Place:1")),
                   trip("T-9", update(1, "12")), trip("unknown", update(1, "12")))
    run_realtime(payloads(spark, message), catalog)
    assert read_history(catalog).count() == 3
    events = canonical_events_from_history(catalog.silver())
    found = with_texts(events, read_dictionary(catalog)).collect()
    assert sorted((r.trip_id, r.route_id, r.stop_id, r.stop_name, r.arrival_delay_seconds) for r in found) == [
        ("77", "2", "Place:1", "First", 60),
        ("T-1", "R1", "12", "Second", 120),
        ("T-1", "R1", "Place:1", "First", 60),
    ]
    assert catalog.read("trip_context").count() == 3


def test_only_plain_numbers_are_cast(spark):
    """A cast that fails costs an exception a row, so other texts must not come to one."""
    from pyspark.sql import functions as F

    from headway.operators.ids import own_number

    texts = ["0", "12", "9223372036854775807", "9223372036854775808", "-0", "+5", "7\n", " 7", "00", "T3", "1e3", "", None]
    rows = spark.createDataFrame([(x,) for x in texts], "text string").select("text", own_number(F.col("text")).alias("id"))
    assert {r.text: r.id for r in rows.collect() if r.id is not None} == {
        "0": 0, "12": 12, "9223372036854775807": 9223372036854775807}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("RLIKE") < plan.index("THEN") < plan.index("cast(text")
