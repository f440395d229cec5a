"""Checks taken while tables are written, daily sketches, and hours that close."""

import datetime

import pytest
from pyspark.sql import functions as F

from headway.operators import quality
from headway.operators.history import append_new_snapshots, compact_history, read_history
from headway.operators.sketches import (
    SKETCHES,
    day_sketches,
    feed_profile_estimate,
    store_day_sketches,
)
from headway.plans.jobs import replace_checked, run_realtime, silver_report, stored_checks
from headway.plans.jobs import STATIC_CHECKS
from headway.sources.tables import FolderCatalog
from headway.streaming.hourly import hourly_punctuality, start_hourly
from tests.silver import seen, tables
from tests.test_jobs import catalog, snapshot, timetable  # noqa: F401
from tests.feeds import payloads


def rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


class Unreadable(FolderCatalog):
    """Tables whose rows cannot be read; the checks and the ledger can."""

    def read(self, table):
        df = super().read(table)
        if table == STATIC_CHECKS or table.endswith("_ledger"):
            return df
        return df.select(*[F.raise_error(F.lit("a row was read")).cast("string").alias(c) for c in df.columns])


def test_report_of_jobs_equals_report_on_tables(spark, timetable, catalog):  # noqa: F811
    from headway.plans.jobs import run_static

    run_static(spark, timetable, catalog)
    run_realtime(payloads(spark, snapshot(1000, 1, 2), snapshot(100_000, 1)), catalog)
    run_realtime(payloads(spark, snapshot(2000, 1, 2, 3)), catalog)
    silver = catalog.silver()
    assert rows(silver_report(catalog)) == rows(quality.silver_report(silver))
    measured = rows(stored_checks(catalog))
    assert measured == rows(quality.whole_checks(silver))
    # None of it reads a row of a source table, also after compaction.
    compact_history(catalog, "1970-01-02")
    assert rows(stored_checks(Unreadable(spark, catalog.prefix))) == measured
    with pytest.raises(Exception, match="a row was read"):
        quality.whole_checks({"stops": Unreadable(spark, catalog.prefix).read("stops")}).collect()


def test_one_pass_equals_single_checks(spark):
    silver = tables(spark, [seen(100, i, 3) for i in (1, 2)] + [seen("x", 1, None)])
    broken = silver["stop_events"].withColumns(
        {
            "stop_id": F.when(F.col("stop_sequence") > 1, F.col("stop_id")),
            "arrival_time_raw": F.when(F.col("trip_id") == 100, F.lit(" ")).otherwise("24:01:00"),
            "arrival_seconds": F.lit(86_460),
        }
    )
    short = broken.filter("trip_id <> 101 or stop_sequence = 3")
    checked = {**silver, "stop_events": short}
    apart = quality.all_results(
        [quality.row_counts(checked), quality.null_checks(checked), quality.time_checks(short)]
    )
    once = quality.whole_checks(checked).unionByName(
        quality.trip_checks(short).filter("check_name = 'times'")
    )
    assert rows(once) == rows(apart)
    found = {r.subject: (r.value, r.passed) for r in quality.trip_checks(short).collect()}
    assert found == {"trip_id": (1, False), "trips below two stops": (1, False)}


def test_empty_tables_are_counted(spark, folder):
    place = FolderCatalog(spark, f"{folder}/lake")
    empty = tables(spark, [])["stops"].limit(0)
    _, results = replace_checked(empty, "stops", place)
    assert {(r.check_name, r.subject): (r.value, r.passed) for r in results.collect()} == {
        ("row_count", "rows"): (0, False),
        ("null_values", "stop_id"): (0, True),
    }


def test_sketches_merge_and_are_made_anew_by_day(spark, folder):
    base = datetime.date(2024, 1, 1)
    frame = spark.range(60_000).select(
        F.timestamp_seconds(F.col("id") * 30 + 1_704_067_200).alias("feed_timestamp"),
        (F.col("id") % 7_000).cast("string").alias("trip_id"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 40).cast("string")).alias("stop_id"),
        F.date_add(F.lit(base), (F.col("id") / 2880).cast("int")).alias("feed_date"),
    )
    place = FolderCatalog(spark, f"{folder}/lake")
    half = frame.filter("feed_date <> '2024-01-03' or trip_id < '3'")
    extra = frame.limit(1).withColumn("feed_date", F.lit("2023-12-31").cast("date"))
    store_day_sketches(half.unionByName(extra), place)
    days = [datetime.date(2024, 1, 3), datetime.date(2023, 12, 31)]
    sketches = store_day_sketches(frame, place, days)
    assert sketches.count() == 21 and place.exists(SKETCHES)
    got = feed_profile_estimate(sketches).first()
    exact = frame.agg(*[F.count_distinct(c) for c in ("feed_timestamp", "trip_id", "stop_id")]).first()
    for estimate, n in zip((got.unique_feed_timestamps, got.unique_trip_ids, got.unique_stop_ids), exact):
        assert abs(estimate - n) <= 0.02 * n
    assert got.rows == 60_000
    # As a whole and day by day, from the same sketches.
    by_day = feed_profile_estimate(sketches, ["feed_date"])
    assert by_day.agg(F.sum("rows")).first()[0] == 60_000
    assert feed_profile_estimate(day_sketches(frame.limit(0))).first().rows == 0


def test_hours_close_once_and_late_rows_are_dropped(spark, folder):
    schema = "feed_timestamp timestamp, arrival_delay_seconds long"

    def land(*found):
        frame = spark.createDataFrame([(h * 3600 + s, d) for h, s, d in found], "at long, d long")
        frame = frame.select(F.timestamp_seconds("at").alias("feed_timestamp"), F.col("d").alias("arrival_delay_seconds"))
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        start_hourly(stream, f"{folder}/out", f"{folder}/c", "1 hour").awaitTermination()
        done = spark.read.parquet(f"{folder}/out")
        return {
            int(r.hour_start.timestamp()) // 3600: (r.observations, r.on_time_pct, r.over_5_min_late_pct)
            for r in done.collect()
        }

    assert land((0, 1, 0), (0, 2, 400), (0, 3, None)) == {}
    # Hour 0 is open until a snapshot at hour 2; a row of hour 0 still counts.
    assert land((1, 0, 0), (0, 3, -61)) == {}
    first = land((2, 0, 0), (2, 1, 301))
    assert first == {0: (3, 33.33, 33.33)}
    # Too late for hour 0, in time for hour 1.
    assert land((0, 5, 0), (1, 5, 0)) == first
    assert land((9, 0, 0)) == {0: (3, 33.33, 33.33), 1: (2, 100.0, 0.0), 2: (2, 50.0, 50.0)}


def test_hourly_on_a_batch_equals_the_stream_columns(spark):
    frame = spark.createDataFrame([(5, 10)], "at long, arrival_delay_seconds long")
    hours = hourly_punctuality(frame.select(F.timestamp_seconds("at").alias("feed_timestamp"), "arrival_delay_seconds"))
    assert hours.first().observations == 1


def test_history_of_ledger_counts(spark, folder):
    place = FolderCatalog(spark, f"{folder}/lake")
    frame = spark.createDataFrame([(1, "a", None), (1, None, 2)], "t long, trip_id string, stop_sequence long")
    frame = frame.withColumn("feed_timestamp", F.timestamp_seconds("t")).drop("t")
    append_new_snapshots(frame, place)
    entry = place.read("realtime_stop_events_ledger").first()
    assert entry.rows == 2 and entry.nulls == {"trip_id": 1, "stop_sequence": 1}
    assert read_history(place).count() == 2
