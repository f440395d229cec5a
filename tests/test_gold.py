import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from headway.operators import observations as obs
from headway.operators import quality
from headway.operators import reliability as rel
from headway.operators.propagation import delay_propagation_events, route_delay_propagation
from headway.plans.jobs import build_gold, gold_frames
from headway.sources.publish import parquet_sink, publish, read_published
from headway.sources.tables import Catalog, FolderCatalog
from tests import silver as s


def events_of(spark, observations, **parts):
    return obs.canonical_events_from_history(s.tables(spark, observations, **parts))


def test_only_scheduled_stops_are_observed(spark):
    rows = [
        s.seen(100, 1, 5),
        s.seen("abc", 1, 5),
        s.seen(999, 1, 5),
        s.seen(100, 1, 5, stop=2),
        s.seen(100, 9, 5),
    ]
    got = obs.stop_observations(s.tables(spark, rows))
    assert got.columns == obs.OBSERVATION_COLUMNS
    only = got.collect()
    assert len(only) == 1
    assert (only[0].route_short_name, only[0].stop_name) == ("7", "Stop 1")
    assert only[0].scheduled_arrival_seconds == 8 * 3600 + 60


@pytest.mark.parametrize("path", ["history", "observations"])
def test_canonical_choice(spark, path):
    rows = [
        s.seen(100, 1, 1, closeness=-30),
        s.seen(100, 1, 2, closeness=30),
        s.seen(100, 1, 3, closeness=500),
        s.seen(100, 2, 4, arrival=False),
        s.seen(100, 3, None, closeness=5),
    ]
    tables = s.tables(spark, rows)
    if path == "history":
        got = obs.canonical_events_from_history(tables)
    else:
        got = obs.canonical_events(obs.stop_observations(tables))
    by_stop = {r.stop_sequence: r for r in got.collect()}
    assert set(by_stop) == {1, 3}
    assert by_stop[1].arrival_delay_seconds == 2
    assert by_stop[1].seconds_from_reported_arrival == 30
    assert got.columns == obs.EVENT_COLUMNS


def test_both_paths_agree_and_ignore_row_order(spark):
    rng = random.Random(5)
    rows = [
        s.seen(
            rng.choice([100, 101, 200]),
            rng.randrange(1, 5),
            rng.choice([None, -5, 5, 50]),
            closeness=rng.randrange(-3, 4),
            day=s.DAY + datetime.timedelta(days=rng.randrange(2)),
            arrival=rng.random() < 0.9,
        )
        for _ in range(400)
    ]
    expected = sorted(map(repr, events_of(spark, rows).collect()))
    rng.shuffle(rows)
    tables = s.tables(spark, rows)
    assert sorted(map(repr, events_of(spark, rows).collect())) == expected
    from_rows = obs.canonical_events(obs.stop_observations(tables))
    assert sorted(map(repr, from_rows.collect())) == expected


def test_repeated_timetable_rows_keep_one_event(spark):
    events = s.schedule(100) + s.schedule(100)
    got = events_of(spark, [s.seen(100, 1, 5), s.seen(100, 2, 5)], events=events)
    assert got.count() == 2


def test_metrics(spark):
    delays = [-61, -60, 60, 61, 300, 301, 600, 601]
    days = [s.DAY + datetime.timedelta(days=i) for i in range(len(delays))]
    rows = [s.seen(100, 1, d, day=day) for d, day in zip(delays, days)]
    got = rel.route_reliability(events_of(spark, rows)).collect()[0]
    assert got.observations == 8
    assert got.avg_arrival_delay_seconds == 225.25
    assert got.median_arrival_delay_seconds == 61
    assert got.p95_arrival_delay_seconds == 601
    assert got.on_time_pct == 25.0
    assert got.over_5_min_late_pct == 37.5
    assert got.over_10_min_late_pct == 12.5


def test_rounding_tie(spark):
    rows = [(1, -163)] * 79 + [(1, -169)]
    df = spark.createDataFrame(rows, "k int, arrival_delay_seconds long")
    got = rel.reliability_by(df, ["k"], "n_rows").collect()[0]
    assert got.avg_arrival_delay_seconds == -163.08


def test_metrics_match_brute_force_with_a_hot_group(spark):
    rng = random.Random(9)
    rows = [(1 if rng.random() < 0.6 else rng.randrange(2, 30), rng.randrange(-700, 900))
            for _ in range(20000)]
    rows += [(None, 4), (None, 5), (77, None)]
    df = spark.createDataFrame(rows, "k int, arrival_delay_seconds long").repartition(7)
    groups = defaultdict(list)
    for key, delay in rows:
        if delay is not None:
            groups[key].append(delay)
    got = {r.k: r for r in rel.reliability_by(df, ["k"], "n_rows").collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        values.sort()
        row = got[key]
        assert row.n_rows == len(values)
        assert row.median_arrival_delay_seconds == values[-(-len(values) * 50 // 100) - 1]
        assert row.p95_arrival_delay_seconds == values[-(-len(values) * 95 // 100) - 1]
        assert row.avg_arrival_delay_seconds == pytest.approx(sum(values) / len(values), abs=0.006)


def test_weighted_metrics_equal_unweighted(spark):
    rows = [s.seen(100, 1, d % 7, closeness=d) for d in range(40)] + [s.seen(200, 2, 9)]
    tables = s.tables(spark, rows)
    plain = rel.daily_metrics(obs.stop_observations(tables))
    counted = rel.daily_metrics(obs.delay_counts(tables), "weight")
    assert sorted(plain.collect()) == sorted(counted.collect())
    plain = rel.hourly_patterns(obs.stop_observations(tables))
    counted = rel.hourly_patterns(obs.delay_counts(tables), "weight")
    assert sorted(plain.collect()) == sorted(counted.collect())


def test_hours_directions_and_weekdays(spark):
    events = s.schedule(100, start=25 * 3600) + s.schedule(200)
    rows = [s.seen(100, 1, 5), s.seen(200, 1, 7)]
    canonical = events_of(spark, rows, events=events)
    hours = {r.route_id: r.scheduled_hour for r in rel.route_hourly_reliability(canonical).collect()}
    assert hours == {1: 25, 2: 8}
    directions = rel.route_direction_reliability(canonical).collect()
    assert [(r.route_id, r.direction_id) for r in directions] == [(1, 0)]
    week = rel.route_weekday_reliability(canonical).collect()
    assert {(r.day_of_week_number, r.day_of_week) for r in week} == {(1, "Sunday")}
    observed = obs.stop_observations(s.tables(spark, rows, events=events))
    wrapped = {r.transport_mode: r.scheduled_hour for r in rel.hourly_patterns(observed).collect()}
    assert wrapped == {"bus": 1, "subway": 8}


def test_groups_without_delays_are_absent(spark):
    assert rel.route_reliability(events_of(spark, [s.seen(100, 1, None)])).count() == 0
    assert rel.route_reliability(events_of(spark, [])).count() == 0


def test_propagation(spark):
    rows = [s.seen(100, 1, 0), s.seen(100, 2, None), s.seen(100, 3, 600), s.seen(100, 4, 1201)]
    got = delay_propagation_events(events_of(spark, rows)).orderBy("stop_sequence").collect()
    assert [r.stop_sequence for r in got] == [1, 3, 4]
    assert [r.delay_change_seconds for r in got] == [None, 600, 601]
    assert [r.is_extreme_propagation for r in got] == [None, False, True]
    assert [r.previous_stop_name for r in got] == [None, "Stop 1", "Stop 3"]
    route = route_delay_propagation(delay_propagation_events(events_of(spark, rows))).collect()[0]
    assert (route.propagation_events, route.extreme_propagation_events) == (2, 1)
    assert route.extreme_propagation_pct == 50.0
    assert route.avg_delay_change_seconds == 600.0
    assert route.median_delay_change_seconds == 600
    assert (route.pct_delay_accumulated, route.pct_delay_recovered) == (100.0, 0.0)


def test_route_with_extreme_changes_only(spark):
    rows = [s.seen(100, 1, 0), s.seen(100, 2, 5000)]
    route = route_delay_propagation(delay_propagation_events(events_of(spark, rows))).collect()[0]
    assert (route.propagation_events, route.extreme_propagation_events) == (1, 1)
    assert route.avg_delay_change_seconds is None
    assert route.median_delay_change_seconds is None
    assert route.pct_delay_accumulated is None and route.pct_delay_recovered is None


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_pieces_do_not_change_the_previous_stop(spark, piece):
    from headway.operators.propagation import with_previous_stop

    rng = random.Random(2)
    rows, expected = [], {}
    for trip in range(6):
        before = (None, None)
        for sequence in sorted(rng.sample(range(1, 60), rng.randrange(1, 25))):
            delay = rng.randrange(99)
            rows.append((s.DAY, trip, sequence, sequence + 500, f"S{sequence}", delay))
            expected[trip, sequence] = before
            before = (sequence + 500, delay)
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows,
        "service_date date, trip_id long, stop_sequence int, stop_id long, stop_name string,"
        " arrival_delay_seconds long",
    )
    got = with_previous_stop(df, piece).collect()
    assert {
        (r.trip_id, r.stop_sequence): (r.previous_stop_id, r.previous_arrival_delay_seconds)
        for r in got
    } == expected


def test_build_and_publish_gold(spark, folder):
    spark.sql("create database if not exists gold_test")
    rows = [s.seen(t, i, 30 * i, closeness=c) for t in (100, 200) for i in (1, 2, 3) for c in (0, 9)]
    tables = s.tables(spark, rows)
    gold = build_gold(tables, Catalog(spark, "gold_test"))
    assert len(gold) == 12
    assert gold["reliability_stop_observations"].count() == 12
    assert gold["reliability_stop_events"].count() == 6
    assert gold["route_reliability"].count() == 2
    assert quality.unique_grain_gold(gold).filter("not passed").count() == 0
    assert quality.not_null_gold(gold).filter("not passed").count() == 0
    names = publish(gold, parquet_sink(folder))
    assert "ROUTE_RELIABILITY" in names and len(names) == 7
    publish(gold, parquet_sink(folder))
    pair = {n: (gold[n], read_published(spark, folder, n)) for n in ("route_reliability",)}
    assert quality.reconcile(pair).first().matches
    changed = gold["route_reliability"].withColumn("on_time_pct", F.col("on_time_pct") + 1)
    pair = {"route_reliability": (changed, pair["route_reliability"][1])}
    assert not quality.reconcile(pair).first().matches


def test_shares_add_up(spark):
    rows = [s.seen(t, i, (t * i) % 700 - 90) for t in (100, 101, 200) for i in range(1, 5)]
    route = rel.route_reliability(events_of(spark, rows)).collect()
    assert all(0 <= r.on_time_pct + r.over_5_min_late_pct <= 100 for r in route)
    change = route_delay_propagation(delay_propagation_events(events_of(spark, rows))).collect()
    assert all(r.pct_delay_accumulated + r.pct_delay_recovered <= 100.01 for r in change)


@pytest.mark.parametrize("metastore", [True, False])
def test_days_can_be_rebuilt_alone(spark, folder, metastore):
    if metastore:
        spark.sql("create database if not exists days_test")
        catalog = Catalog(spark, "days_test")
    else:
        catalog = FolderCatalog(spark, folder)
    monday = s.DAY + datetime.timedelta(days=1)
    first = [s.seen(100, i, 10, day=s.DAY) for i in (1, 2)]
    build_gold(s.tables(spark, first), catalog)
    later = first + [s.seen(100, i, 20, day=monday) for i in (1, 2, 3)]
    later += [s.seen(200, 1, 7, day=monday)]
    partly = build_gold(s.tables(spark, later), catalog, days=[monday])
    whole = gold_frames(s.tables(spark, later))
    for name in ("reliability_stop_observations", "delay_propagation_stop_events",
                 "route_reliability", "daily_reliability_metrics"):
        df = partly[name]
        columns = sorted(df.columns)
        left = sorted(map(repr, df.select(columns).collect()))
        assert left == sorted(map(repr, whole[name].select(columns).collect())), name
