"""Loads of the history: lost, retried, compacted, and Gold days that change."""

import datetime

import pytest
from pyspark.sql import functions as F

from headway.operators import history
from headway.operators.history import (
    HISTORY_TABLE,
    append_new_snapshots,
    compact_history,
    drop_unread,
    read_history,
    read_ledger,
    unread_parts,
)
from headway.plans.jobs import build_gold
from headway.sources.tables import Catalog, FolderCatalog
from tests.silver import DAY, seen, tables

SCHEMA = "feed_timestamp long, trip_id string, stop_sequence long, delay long"
DAY_SECONDS = 86400


def batch(spark, *snapshots, rows=4):
    found = [(s, f"t{s % 7}", i, s + i) for s in snapshots for i in range(rows)]
    frame = spark.createDataFrame(found, SCHEMA)
    return frame.withColumn("feed_timestamp", F.timestamp_seconds("feed_timestamp"))


def content(df):
    return sorted(
        tuple(r) for r in df.select(F.unix_seconds("feed_timestamp"), "stop_sequence", "delay").collect()
    )


def expected(*snapshots, rows=4):
    return sorted((s, i, s + i) for s in snapshots for i in range(rows))


@pytest.fixture(params=["folder", "metastore"])
def catalog(request, spark, folder):
    if request.param == "folder":
        yield FolderCatalog(spark, f"{folder}/lake")
        return
    name = f"history_{abs(hash(folder)) % 10**9}"
    spark.sql(f"create database {name}")
    yield Catalog(spark, name)
    spark.sql(f"drop database {name} cascade")


def lost(*_):
    raise RuntimeError("driver lost")


def test_retry_of_a_lost_load_ends_whole(spark, catalog, monkeypatch):
    append_new_snapshots(batch(spark, 10, 20), catalog)
    with monkeypatch.context() as patch:
        patch.setattr(history, "_enter", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            # Only a part of the rows arrives before the driver is lost.
            append_new_snapshots(batch(spark, 30, DAY_SECONDS, rows=2), catalog)
    assert content(catalog.read(HISTORY_TABLE)) != expected(10, 20)
    assert content(read_history(catalog)) == expected(10, 20)
    assert unread_parts(catalog).count() == 2
    assert append_new_snapshots(batch(spark, 20, 30, DAY_SECONDS), catalog)
    assert content(read_history(catalog)) == expected(10, 20, 30, DAY_SECONDS)
    # The retry wrote over what the lost load had left.
    assert content(catalog.read(HISTORY_TABLE)) == content(read_history(catalog))
    assert append_new_snapshots(batch(spark, 10, 30), catalog) is None


def test_another_load_after_a_lost_one(spark, catalog, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(history, "_enter", lost)
        with pytest.raises(RuntimeError):
            append_new_snapshots(batch(spark, 10, 20), catalog)
    append_new_snapshots(batch(spark, 20, 40), catalog)
    append_new_snapshots(batch(spark, 10, 20), catalog)
    assert content(read_history(catalog)) == expected(10, 20, 40)
    assert len(drop_unread(catalog)) == 1
    assert content(catalog.read(HISTORY_TABLE)) == expected(10, 20, 40)


def test_appending_reads_no_row_of_the_history(spark, folder):
    place = f"{folder}/lake"
    first = append_new_snapshots(batch(spark, 10, 20), FolderCatalog(spark, place))

    class Unreadable(FolderCatalog):
        def read(self, table):
            df = super().read(table)
            if table != HISTORY_TABLE:
                return df
            bad = F.raise_error(F.lit("a history row was read")).cast("string")
            return df.withColumn("trip_id", F.when(F.col("load") == first, bad).otherwise(F.col("trip_id")))

    append_new_snapshots(batch(spark, 20, 30), Unreadable(spark, place))
    assert content(read_history(FolderCatalog(spark, place))) == expected(10, 20, 30)
    with pytest.raises(Exception, match="a history row was read"):
        read_history(Unreadable(spark, place)).collect()


def files_by_day(catalog):
    counted = catalog.read(HISTORY_TABLE).withColumn("file", F.input_file_name())
    found = counted.groupBy("feed_date").agg(F.count_distinct("file").alias("files")).collect()
    return {str(r["feed_date"]): r["files"] for r in found}


def test_compaction_keeps_rows_and_bounds_files(spark, catalog):
    closed = [d * DAY_SECONDS + s for d in (0, 1) for s in (1, 2, 3, 4)]
    still_open = [2 * DAY_SECONDS + s for s in (1, 2, 3)]
    for a, b in zip(closed, [*closed[4:], *closed[:4]]):
        append_new_snapshots(batch(spark, a, b), catalog)
    for one in still_open:
        append_new_snapshots(batch(spark, one), catalog)
    before = content(read_history(catalog))
    assert files_by_day(catalog)["1970-01-01"] > 1
    load = compact_history(catalog, "1970-01-03")
    assert content(read_history(catalog)) == before == expected(*closed, *still_open)
    # Readers of the old loads may go on until these are dropped.
    assert content(catalog.read(HISTORY_TABLE).filter("load <> '%s'" % load)) == before
    drop_unread(catalog)
    assert content(catalog.read(HISTORY_TABLE)) == before
    assert files_by_day(catalog) == {"1970-01-01": 1, "1970-01-02": 1, "1970-01-03": 3}
    assert compact_history(catalog, "1970-01-03") is None
    # A late snapshot of a closed day is a load again, and compacted with the rest.
    append_new_snapshots(batch(spark, 5), catalog)
    compact_history(catalog, "1970-01-03")
    drop_unread(catalog)
    assert content(read_history(catalog)) == expected(5, *closed, *still_open)
    assert files_by_day(catalog)["1970-01-01"] == 1


def test_appending_beside_compaction(spark, folder, monkeypatch):
    catalog = FolderCatalog(spark, f"{folder}/lake")
    append_new_snapshots(batch(spark, 1), catalog)
    append_new_snapshots(batch(spark, 2), catalog)
    enter = history._enter

    def append_first(*arguments):
        monkeypatch.setattr(history, "_enter", enter)
        append_new_snapshots(batch(spark, 3), catalog)
        enter(*arguments)

    monkeypatch.setattr(history, "_enter", append_first)
    compact_history(catalog, "1970-01-02")
    drop_unread(catalog)
    assert content(read_history(catalog)) == expected(1, 2, 3)
    assert read_ledger(catalog).count() == 3


def test_lost_compaction_changes_nothing(spark, folder, monkeypatch):
    catalog = FolderCatalog(spark, f"{folder}/lake")
    for snapshot in (1, 2):
        append_new_snapshots(batch(spark, snapshot), catalog)
    with monkeypatch.context() as patch:
        patch.setattr(history, "_enter", lost)
        with pytest.raises(RuntimeError):
            compact_history(catalog, "1970-01-02")
    assert content(read_history(catalog)) == expected(1, 2)
    compact_history(catalog, "1970-01-02")
    assert content(read_history(catalog)) == expected(1, 2)
    drop_unread(catalog)
    assert files_by_day(catalog) == {"1970-01-01": 1}


@pytest.fixture
def three_days(spark):
    days = [DAY + datetime.timedelta(days=k) for k in range(3)]
    rows = [seen(trip, k, 30 * k, day=d) for trip in (100, 200) for k in (1, 2, 3) for d in days]
    return days, tables(spark, rows)


def by_table(gold):
    return {name: sorted(map(str, df.collect())) for name, df in gold.items()}


def test_rebuilding_days_equals_building_all(spark, catalog, folder, three_days):
    days, silver = three_days
    build_gold(silver, catalog)
    history_rows = silver["realtime_stop_events"]
    changed = history_rows.filter(F.col("start_date") != days[1]).filter(
        (F.col("start_date") != days[0]) | (F.col("stop_sequence") < 3)
    )
    now = {**silver, "realtime_stop_events": changed}
    rebuilt = build_gold(now, catalog, days[:2])
    afresh = build_gold(now, FolderCatalog(spark, f"{folder}/afresh"))
    columns = {name: df.columns for name, df in afresh.items()}
    ordered = {name: df.select(*columns[name]) for name, df in rebuilt.items()}
    assert by_table(ordered) == by_table(afresh)
    # The day without rows has left the tables that are laid out by day.
    left = rebuilt["reliability_stop_events"].select("service_date").distinct().collect()
    assert sorted(r[0] for r in left) == [days[0], days[2]]


def test_rebuilding_reads_rows_of_those_days_only(spark, folder, three_days):
    days, silver = three_days

    class Watched(FolderCatalog):
        def read(self, table):
            df = super().read(table)
            if table not in ("reliability_stop_observations", "reliability_stop_events"):
                return df
            other = ~F.col("service_date").isin([days[1]])
            bad = F.when(other, F.raise_error(F.lit("a row of another day was read")).cast("long"))
            return df.withColumn("trip_id", F.coalesce(bad, "trip_id"))

    place = f"{folder}/lake"
    build_gold(silver, FolderCatalog(spark, place))
    gold = build_gold(silver, Watched(spark, place), [days[1]])
    assert gold["route_reliability"].agg(F.sum("observations")).first()[0] == 18
    with pytest.raises(Exception, match="a row of another day"):
        gold["reliability_stop_events"].collect()
