"""The registered queries: name to a function of session and table folder."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import functions as fn
from headway.constants import SERVING_TABLES
from headway.operators import inspect as feeds
from headway.operators import live, quality
from headway.operators import observations as obs
from headway.operators import reliability as rel
from headway.operators.flatten import (
    feed_trip_ids,
    newest_trip_states,
    stop_update_rows,
    trip_update_rows,
    trip_update_state,
    typed_observations,
    vehicle_rows,
    vehicles_by_id,
    vehicles_by_trip,
)
from headway.operators.history import (
    HISTORY_TABLE,
    append_new_snapshots,
    compact_history,
    dedupe_observations,
    drop_unread,
    read_history,
    with_feed_date,
)
from headway.operators.ids import read_dictionary, with_texts
from headway.operators.propagation import delay_propagation_events, route_delay_propagation
from headway.operators.scope import observations_in_scope
from headway.operators.sketches import COUNTED, feed_profile_estimate, store_day_sketches
from headway.plans import reports
from headway.plans.jobs import (
    TRIP_CONTEXT,
    TRIP_STOPS,
    build_gold,
    gold_frames,
    run_realtime,
    run_static,
    silver_report,
    write_board_tables,
)
from headway.registry import tables as t
from headway.registry.encode import (
    history_pieces,
    history_snapshots,
    payloads_of,
    update_pieces,
    vehicle_payloads_of,
    vehicle_pieces,
)
from headway.session import configure, new_folder
from headway.sources.feed import decode_feed, require_feed
from headway.sources.payload_files import write_payload_files
from headway.sources.publish import connector_sink, parquet_sink, publish, read_published
from headway.sources.snapshots import (
    archive_files,
    archive_snapshots,
    landing_file,
    latest_snapshot,
    read_snapshots,
)
from headway.sources.tables import FolderCatalog
from headway.sources.timetable import read_timetable
from headway.streaming import history as stream_history
from headway.streaming import hourly as stream_hourly
from headway.streaming import live as stream_live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return t.plain(query(configure(spark), sf_dir))

        QUERIES[name] = run
        return run

    return add


def _over(source: Callable, shape: Callable, name: str) -> None:
    registered(name)(lambda spark, sf_dir: shape(source(spark, sf_dir)))


# Sources of the queries


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events."""
    return obs.canonical_events_from_history(t.silver(spark, sf_dir))


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations pre-counted by stop, day and delay."""
    return obs.delay_counts(t.silver(spark, sf_dir))


def scoped_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = t.scoped_static(spark, sf_dir)["trips"]
    return observations_in_scope(t.realtime(spark, sf_dir), trips)


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Gold tables; the row-level ones are written once to the shared folder,
    since each of them feeds several others."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        if not any(part in name for part in ("stop_events", "observations", "counts")):
            return df
        folder = new_folder(spark, name)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    return gold_frames(t.silver(spark, sf_dir), keep)


def board_vehicle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles of the newest snapshot that have a trip and a position."""
    shown = t.vehicles(spark, sf_dir).filter(
        "vehicle_id is not null and trip_id is not null and latitude is not null"
    )
    newest = live.latest_value(t.vehicles(spark, sf_dir), "feed_timestamp")
    return shown.filter(F.col("feed_timestamp") == newest)


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = t.raw_timetable(spark, sf_dir)
    return live.trip_context(raw["trips"], raw["routes"], raw["stop_times"], raw["stops"])


def stops_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = t.raw_timetable(spark, sf_dir)
    return live.trip_stops(raw["stop_times"], raw["stops"])


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.board_vehicles(board_vehicle_rows(spark, sf_dir), context(spark, sf_dir))


def live_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.with_next_stop(
        board(spark, sf_dir), t.updates(spark, sf_dir), stops_of_trips(spark, sf_dir), t.NOW
    )


def catalog_of_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = t.raw_timetable(spark, sf_dir)["routes"]
    return live.route_catalog(context(spark, sf_dir), routes)


def requested_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vehicle ever seen, as if each had a follower."""
    return t.vehicles(spark, sf_dir).select("vehicle_id").distinct()


def landed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated observations in scope, written once: several loads read them."""
    folder = new_folder(spark, "batch")
    dedupe_observations(scoped_history(spark, sf_dir)).write.parquet(folder)
    return spark.read.parquet(folder)


# Scope and history

for _name, _table in (
    ("routes_scope", "routes"),
    ("trips_scope", "trips"),
    ("stop_events_scope", "stop_events"),
    ("stops_used", "stops"),
):
    _over(t.scoped_static, lambda tables, name=_table: tables[name], _name)

_over(scoped_history, lambda df: df, "realtime_scope")
_over(scoped_history, dedupe_observations, "observations_dedup")


@registered("append_new_snapshots")
def _append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append everything twice; the second time adds nothing."""
    catalog = FolderCatalog(spark, new_folder(spark, "history"))
    batch = landed_batch(spark, sf_dir)
    append_new_snapshots(batch, catalog)
    append_new_snapshots(batch, catalog)
    return read_history(catalog)


@registered("history_after_lost_load")
def _lost_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that were lost before they were entered: the one that is retried had
    written a part of its rows, the other one rows of snapshots that another load brings."""
    catalog = FolderCatalog(spark, new_folder(spark, "history"))
    batch = landed_batch(spark, sf_dir)
    early = F.col("feed_timestamp") < F.timestamp_seconds(F.lit(t.NOW + 40 * 86400))
    load = append_new_snapshots(batch.filter(early), FolderCatalog(spark, new_folder(spark, "trial")))
    for name, lost in ((load, early & (F.col("stop_sequence") % 2 == 0)), ("load-other", ~early)):
        rows = with_feed_date(batch.filter(lost)).withColumn("load", F.lit(name))
        catalog.replace_parts(rows, HISTORY_TABLE, ["feed_date", "load"])
    append_new_snapshots(batch.filter(early), catalog)
    append_new_snapshots(batch, catalog)
    return read_history(catalog)


@registered("history_compacted")
def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads that share days, the closed days of which are made one load."""
    catalog = FolderCatalog(spark, new_folder(spark, "history"))
    batch = landed_batch(spark, sf_dir)
    for part in range(3):
        some = F.pmod(F.xxhash64("feed_timestamp"), F.lit(3)) <= part
        append_new_snapshots(batch.filter(some), catalog)
    compact_history(catalog, "2024-03-01")
    drop_unread(catalog)
    return read_history(catalog)


# Gold tables

_over(t.silver, obs.stop_observations, "stop_observations")
_over(t.silver, obs.canonical_events_from_history, "canonical_stop_events")
_over(
    t.silver,
    lambda silver: obs.canonical_events(obs.stop_observations(silver)),
    "canonical_from_observations",
)
for _name, _metrics in (
    ("route_reliability", rel.route_reliability),
    ("stop_reliability", rel.stop_reliability),
    ("route_stop_reliability", rel.route_stop_reliability),
    ("route_direction_reliability", rel.route_direction_reliability),
    ("route_hourly_reliability", rel.route_hourly_reliability),
    ("route_weekday_reliability", rel.route_weekday_reliability),
    ("delay_propagation_events", delay_propagation_events),
    ("route_delay_propagation", lambda df: route_delay_propagation(delay_propagation_events(df))),
):
    _over(events, _metrics, _name)
_over(counted, lambda df: rel.hourly_patterns(df, "weight"), "hourly_patterns")
_over(counted, lambda df: rel.daily_metrics(df, "weight"), "daily_metrics")

# Quality

_over(t.checked_tables, quality.row_counts, "row_counts")
_over(t.checked_tables, quality.null_checks, "null_checks")
_over(t.checked_tables, quality.uniqueness_checks, "uniqueness_checks")
_over(t.checked_tables, quality.orphan_checks, "orphan_checks")
_over(t.checked_tables, quality.silver_report, "silver_report")


@registered("silver_report_of_jobs")
def _report_of_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on what the jobs wrote, with the checks taken while they wrote."""
    folder = new_folder(spark, "checked")
    catalog = FolderCatalog(spark, f"{folder}/lake")
    for name, df in t.raw_timetable(spark, sf_dir).items():
        df.write.option("header", True).csv(f"{folder}/gtfs/{name}.txt")
    run_static(spark, f"{folder}/gtfs", catalog, t.AGENCIES)
    batch = landed_batch(spark, sf_dir)
    half = F.pmod(F.xxhash64("feed_timestamp"), F.lit(2)) == 0
    append_new_snapshots(batch.filter(half), catalog)
    append_new_snapshots(batch, catalog)
    compact_history(catalog, "2024-02-01")
    return silver_report(catalog)


_over(
    t.realtime,
    lambda df: quality.duplicate_examples(
        df, quality.UNIQUE_KEYS["realtime_stop_events"]
    ),
    "duplicate_examples",
)
_over(
    t.checked_tables,
    lambda tables: quality.orphan_stop_examples(
        tables["realtime_stop_events"], tables["stops"]
    ),
    "orphan_examples",
)
_over(t.checked_tables, lambda d: quality.sequence_profile(d["stop_events"]), "sequence_profile")
_over(t.checked_tables, lambda d: quality.sequence_issues(d["stop_events"]), "sequence_issues")
_over(t.checked_tables, lambda d: quality.time_checks(d["stop_events"]), "time_checks")
_over(t.realtime, quality.delay_profile, "delay_profile")
_over(t.realtime, quality.feed_profile, "feed_profile")


@registered("feed_profile_estimate")
def _profile_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile from stored daily sketches, some of them made anew, next to the exact one."""
    catalog = FolderCatalog(spark, new_folder(spark, "sketches"))
    history = with_feed_date(t.realtime(spark, sf_dir))
    first = datetime.date(2024, 1, 1)
    again = [first + datetime.timedelta(days=k) for k in range(0, 30, 2)]
    lacking = ~F.col("feed_date").isin(again) | (F.col("stop_sequence") > 2)
    store_day_sketches(history.filter(lacking), catalog)
    profile = feed_profile_estimate(store_day_sketches(history, catalog, again))

    def close(name: str) -> F.Column:
        exact = history.select(F.count_distinct(name)).scalar()
        return (F.abs(F.col(f"unique_{name}s") - exact) <= 0.02 * exact).alias(f"{name}s_within_2_pct")

    return profile.select(
        "rows", "min_feed_timestamp", "max_feed_timestamp", *[close(c) for c in COUNTED]
    )


@registered("handshake")
def _handshake(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = t.scoped_static(spark, sf_dir)["trips"]
    return quality.handshake(t.realtime(spark, sf_dir).select("trip_id"), trips)


@registered("gold_rebuilt_days")
def _rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold tables of a history that changes: every third service day first lacks rows, and
    one day has rows that are all withdrawn. Only those days are built again."""
    catalog = FolderCatalog(spark, new_folder(spark, "gold"))
    whole = t.silver(spark, sf_dir)
    history = whole["realtime_stop_events"]
    first, gone = datetime.date(2024, 1, 1), datetime.date(2025, 6, 1)
    late = [first + datetime.timedelta(days=k) for k in range(0, t.SERVICE_DAYS, 3)]
    known = history.filter(~F.col("start_date").isin(late) | (F.col("stop_sequence") > 2))
    wrong = history.filter(F.col("start_date") == late[1]).withColumn("start_date", F.lit(gone))
    build_gold({**whole, "realtime_stop_events": known.unionByName(wrong)}, catalog)
    return gold_totals(build_gold(whole, catalog, [*late, gone]))


def gold_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, and the sums of its numbers in hundredths."""
    parts = []
    for name, df in tables.items():
        sums = {
            c: F.coalesce(F.sum(F.round(F.col(c) * 100).cast("long")), F.lit(0)) for c in t.GOLD_NUMBERS[name]
        }
        one = df.agg(F.count("*").alias("rows"), *[v.alias(c) for c, v in sums.items()])
        long = one.unpivot([], one.columns, "subject", "value")
        parts.append(long.select(F.lit(name).alias("table_name"), "subject", "value"))
    return quality.all_results(parts)


_over(gold, quality.not_null_gold, "not_null_gold")
_over(gold, quality.unique_grain_gold, "unique_grain_gold")

# Reports; the test tables have small groups, hence the lower minimum samples


def _report(metrics: Callable, report: Callable, name: str, **settings) -> None:
    _over(events, lambda df: report(metrics(df), **settings), name)


_report(rel.route_reliability, reports.tail_risk_routes, "tail_risk_routes", min_observations=20)
_report(rel.route_reliability, reports.tail_risk_share, "tail_risk_share", min_observations=20)
_report(rel.route_direction_reliability, reports.direction_gap, "direction_gap", min_events=10)
_report(rel.route_stop_reliability, reports.worst_route_stops, "worst_route_stops", min_events=2)
_report(
    lambda df: route_delay_propagation(delay_propagation_events(df)),
    reports.delay_tendency,
    "delay_tendency",
    min_events=10,
)
_report(
    lambda df: route_delay_propagation(delay_propagation_events(df)),
    reports.accumulating_routes,
    "accumulating_routes",
    min_events=10,
)
_report(rel.route_hourly_reliability, reports.time_of_day, "time_of_day")
_report(rel.route_reliability, reports.headline_kpis, "headline_kpis")
_report(rel.route_reliability, reports.avg_vs_p95, "avg_vs_p95", min_observations=20)
_report(rel.route_reliability, reports.only, "filtered_routes", modes=["bus", "subway"])
_over(
    events,
    lambda df: reports.weekday_coverage(rel.route_weekday_reliability(df), df),
    "weekday_coverage",
)

_over(
    events,
    lambda df: reports.kpi_cross_check(rel.route_reliability(df), df),
    "kpi_cross_check",
)

# Live board and feed inspection

_over(t.vehicles, vehicles_by_id, "latest_vehicles")
_over(t.vehicles, vehicles_by_trip, "vehicles_by_trip")
_over(context, lambda df: df, "trip_context")
_over(stops_of_trips, lambda df: df, "trip_stop_places")
_over(board, lambda df: df, "vehicle_context")
_over(live_board, lambda df: df, "next_stops")
_over(live_board, live.vehicle_cards, "vehicle_cards")
_over(live_board, live.board_kpis, "board_kpis")
_over(catalog_of_routes, lambda df: df, "route_catalog")
_over(catalog_of_routes, lambda df: live.route_search(df, " Urgent "), "route_search")


@registered("next_stops_from_stored")
def _stored_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board on the stored tables of the static job."""
    raw = t.raw_timetable(spark, sf_dir)
    catalog = FolderCatalog(spark, new_folder(spark, "board-tables"))
    stored = write_board_tables(raw["trips"], raw["routes"], raw["stop_times"], raw["stops"], catalog)
    rows = live.board_vehicles(board_vehicle_rows(spark, sf_dir), stored[TRIP_CONTEXT])
    return live.with_next_stop(rows, t.updates(spark, sf_dir), stored[TRIP_STOPS], t.NOW)


@registered("observed_catalog")
def _observed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = live.observed_routes(board(spark, sf_dir))
    return live.observed_catalog(catalog_of_routes(spark, sf_dir), seen)


@registered("followed_vehicles")
def _followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = live_board(spark, sf_dir)
    return live.followed_vehicles(requested_vehicles(spark, sf_dir), rows, t.LATER)


@registered("followed_trip_stops")
def _followed_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = live_board(spark, sf_dir)
    followed = rows.join(requested_vehicles(spark, sf_dir), "vehicle_id", "left_semi")
    return live.followed_trip_stops(followed, stops_of_trips(spark, sf_dir))


_over(t.vehicles, feeds.missing_trip_profile, "missing_trip_profile")
_over(t.vehicles, feeds.missing_trip_examples, "missing_trip_examples")
_over(
    t.vehicles,
    lambda df: feeds.feed_freshness(vehicles_by_id(df)),
    "feed_freshness",
)
_over(
    t.vehicles,
    lambda df: feeds.change_examples(feeds.vehicle_changes(vehicles_by_id(df))).select(
        "feed_timestamp", "previous_timestamp", "vehicle_id", "vehicle_timestamp"
    ),
    "change_examples",
)


@registered("feed_overlap")
def _overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.feed_overlap(t.vehicles(spark, sf_dir), t.updates(spark, sf_dir))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = t.scoped_static(spark, sf_dir)
    running = t.vehicles(spark, sf_dir).filter("trip_id is not null")
    return feeds.route_match(running, tables["trips"], tables["routes"])


_over(matches, lambda df: df, "route_match")
_over(matches, feeds.route_match_summary, "route_match_summary")
_over(matches, lambda df: feeds.route_match_examples(df, False), "route_match_examples")

# Texts

_over(
    t.feed_rows,
    lambda df: df.select(
        "trip_id",
        "feed_timestamp",
        "arrival_delay_seconds",
        fn.delay_text(F.col("arrival_delay_seconds")).alias("delay_text"),
    ),
    "delay_text",
)
_over(
    t.feed_rows,
    lambda df: df.select(
        "trip_id",
        "feed_timestamp",
        "arrival_time_actual",
        fn.clock_text(F.col("arrival_time_actual")).alias("clock_text"),
        fn.moment_text(F.col("arrival_time_actual")).alias("moment_text"),
    ),
    "clock_text",
)
_over(
    t.vehicles,
    lambda df: df.select(
        "entity_index",
        "vehicle_timestamp",
        fn.age_text(F.col("vehicle_timestamp"), F.lit(t.LATER)).alias("age_text"),
    ),
    "age_text",
)
_over(
    t.raw_timetable,
    lambda d: d["routes"]
    .withColumn("key", fn.route_sort_key(F.col("route_short_name")))
    .select(
        "route_id",
        "route_short_name",
        F.col("key.rank").alias("sort_rank"),
        F.col("key.number").cast("long").alias("sort_number"),
        F.col("key.text").alias("sort_text"),
    ),
    "route_sort_key",
)
_over(
    t.raw_timetable,
    lambda d: d["trips"].select(
        "trip_id", fn.clean_text(F.col("trip_headsign")).alias("clean_text")
    ),
    "clean_text",
)

# Files


@registered("timetable_scan")
def _timetable_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "timetable")
    rows = t.raw_timetable(spark, sf_dir)["stop_times"]
    rows.write.option("header", True).csv(f"{folder}/stop_times.txt")
    return read_timetable(spark, folder, "stop_times")


def timetable_files(spark: SparkSession, sf_dir: str) -> str:
    """The timetable as files whose columns are more and in another order than asked for."""
    folder = new_folder(spark, "gtfs")
    for name, df in t.raw_timetable(spark, sf_dir).items():
        shuffled = df.select(F.lit("x").alias("extra"), *reversed(df.columns))
        writer = shuffled.write.option("header", True)
        writer = writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        writer.csv(f"{folder}/{name}.txt")
    return folder


@registered("context_of_files")
def _context_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live context from files, of which only the columns it needs are read."""
    folder = timetable_files(spark, sf_dir)
    columns = {
        "trips": ["trip_id", "route_id", "trip_headsign"],
        "routes": ["route_id", "route_short_name", "route_long_name", "route_type"],
        "stop_times": ["trip_id", "stop_id", "stop_sequence"],
        "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    }
    frames = [read_timetable(spark, folder, name, some) for name, some in columns.items()]
    return live.trip_context(*frames)


@registered("static_job")
def _static_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The static job over files, twice: tables that exist are replaced, with their schema."""
    catalog = FolderCatalog(spark, new_folder(spark, "static-job"))
    catalog.replace(spark.range(3).withColumn("old", F.lit("x")), "stop_events")
    folder = timetable_files(spark, sf_dir)
    for _ in range(2):
        run_static(spark, folder, catalog, t.AGENCIES)
    return catalog.read("stop_events")


@registered("source_registry")
def _source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the five source tables, looked up by name after both jobs."""
    catalog = FolderCatalog(spark, new_folder(spark, "sources"))
    for name, df in t.scoped_static(spark, sf_dir).items():
        catalog.replace(df, name)
    append_new_snapshots(dedupe_observations(scoped_history(spark, sf_dir)), catalog)
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        for name, df in catalog.silver().items()
    ]
    return quality.all_results(counts)


def text_id_tables(spark: SparkSession, sf_dir: str) -> FolderCatalog:
    """The static job over four files with text ids, twice, and the realtime job after it."""
    folder = new_folder(spark, "text-ids")
    catalog = FolderCatalog(spark, f"{folder}/lake")
    for name, df in t.raw_timetable(spark, sf_dir).items():
        writer = t.with_text_ids(df).write.option("header", True)
        writer = writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        writer.csv(f"{folder}/gtfs/{name}.txt")
    agencies = [f"A{n}" if n % 2 == 0 else str(n) for n in t.AGENCIES]
    for _ in range(2):
        run_static(spark, f"{folder}/gtfs", catalog, agencies, text_ids=True)
    # Which of two rows of one key stays goes by the order of the ids: they are told apart first.
    rows = dedupe_observations(t.snapshot_rows(spark, sf_dir))
    files = history_pieces(t.with_text_ids(rows))
    run_realtime(files.withColumn("path", F.col("feed_timestamp").cast("string")), catalog)
    return catalog


@registered("timetable_text_ids")
def _timetable_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled stops in scope with their route and stop, by the texts of the files."""
    catalog = text_id_tables(spark, sf_dir)
    tables = catalog.silver()
    rows = (
        tables["stop_events"]
        .join(tables["trips"].select("trip_id", "route_id", "trip_headsign"), "trip_id")
        .join(tables["routes"].select("route_id", "route_short_name"), "route_id")
        .join(tables["stops"].select("stop_id", "stop_name"), "stop_id", "left")
    )
    return with_texts(rows, read_dictionary(catalog))


@registered("gold_text_ids")
def _gold_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = text_id_tables(spark, sf_dir)
    events = obs.canonical_events_from_history(catalog.silver())
    return with_texts(rel.route_stop_reliability(events), read_dictionary(catalog))


@registered("decode_flatten")
def _decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = decode_feed(payloads_of(t.feed_rows(spark, sf_dir)))
    return typed_observations(trip_update_rows(require_feed(feed)))


@registered("decode_vehicles")
def _decode_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = decode_feed(vehicle_payloads_of(t.vehicles(spark, sf_dir)))
    # Each payload holds one entity, so its place within the feed says nothing.
    return vehicle_rows(feed).drop("entity_index")


def landed(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder with a file per snapshot, of hundreds of entities each."""
    base = new_folder(spark, "landing")
    files = history_snapshots(t.snapshot_rows(spark, sf_dir))
    name = F.concat(F.lit("trip_updates_"), F.col("feed_timestamp").cast("string"), F.lit(".pb"))
    at = F.timestamp_seconds("feed_timestamp")
    write_payload_files(files.select(landing_file(name, at).alias("file"), "content"), base)
    return base


def decoded_files(files: DataFrame) -> DataFrame:
    return typed_observations(trip_update_rows(require_feed(decode_feed(files, parts=True))))


@registered("snapshot_scan")
def _snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read_snapshots(spark, landed(spark, sf_dir))
    feed = decode_feed(files).select(
        "path",
        F.col("header.timestamp").alias("feed_timestamp"),
        F.size("entity").cast("long").alias("entities"),
        F.aggregate(
            "entity",
            F.lit(0).cast("long"),
            lambda n, e: n + F.size(e["trip_update"]["stop_time_update"]),
        ).alias("stop_updates"),
    )
    folders = files.select("path", "ingestion_date", F.col("hour").cast("int").alias("hour"))
    return folders.join(feed, "path").drop("path")


@registered("latest_snapshot")
def _latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded_files(latest_snapshot(spark, landed(spark, sf_dir)))


@registered("stream_snapshots")
def _stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files to the history, some files a batch."""
    folder = new_folder(spark, "stream-snapshots")
    catalog = FolderCatalog(spark, folder)
    trips = t.scoped_static(spark, sf_dir)["trips"]
    files = stream_history.snapshot_stream(spark, landed(spark, sf_dir), files_per_batch=50)
    rows = stream_history.observation_stream(files, trips)
    _finish(stream_history.start_history(rows, catalog, f"{folder}/checkpoint"))
    return read_history(catalog)


@registered("realtime_job")
def _realtime_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over landed files: one day, then all of them."""
    catalog = FolderCatalog(spark, new_folder(spark, "realtime-job"))
    catalog.replace(t.scoped_static(spark, sf_dir)["trips"], "trips")
    base = landed(spark, sf_dir)
    run_realtime(read_snapshots(spark, base).filter("ingestion_date = '2024-01-02'"), catalog)
    run_realtime(read_snapshots(spark, base), catalog)
    return read_history(catalog)


@registered("archive_layout")
def _archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = payloads_of(t.feed_rows(spark, sf_dir))
    # Two landing days, to keep the number of folders small.
    landed_at = F.timestamp_seconds(F.lit(t.NOW) + F.col("feed_timestamp") % 172800)
    archived = archive_snapshots(payloads, new_folder(spark, "archive"), landed_at)
    return archived.groupBy("ingestion_date", "hour").agg(F.count("*").alias("payloads"))


@registered("archive_files")
def _archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived files by folder, and how many still hold the bytes that they were named after."""
    payloads = history_snapshots(t.snapshot_rows(spark, sf_dir))
    at = F.timestamp_seconds(F.lit(t.NOW) + F.col("feed_timestamp") % 172800)
    name = F.concat(F.sha2("content", 256), F.lit(".pb"))
    archived = archive_files(payloads, new_folder(spark, "archive"), at, name)
    same = F.endswith("path", F.concat(F.lit("/"), F.sha2("content", 256), F.lit(".pb")))
    return archived.groupBy(
        F.col("ingestion_date").cast("date").alias("ingestion_date"),
        F.col("hour").cast("int").alias("hour"),
    ).agg(F.count("*").alias("files"), F.count_if(same).alias("same_bytes"))


@registered("archive_rows")
def _archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads kept as table rows; their content decoded again."""
    files = history_pieces(t.snapshot_rows(spark, sf_dir))
    base = new_folder(spark, "archive-rows")
    return decoded_files(archive_snapshots(files, base, F.timestamp_seconds("feed_timestamp")))


@registered("stop_update_state")
def _stop_update_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest stop updates of each trip over three live snapshots."""
    rows = [t.live_updates(spark, sf_dir, i) for i in range(3)]
    files = update_pieces(rows[0].unionByName(rows[1]).unionByName(rows[2]))
    feed = decode_feed(files.withColumn("path", F.lit("x")))
    return stop_update_rows(newest_trip_states(trip_update_state(feed)))


@registered("overlap_examples")
def _overlap_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running vehicles of the newest snapshot whose trips have stop updates."""
    vehicles = vehicles_by_trip(live.newest_snapshot(t.vehicles(spark, sf_dir)))
    rows = [t.live_updates(spark, sf_dir, i) for i in range(3)]
    files = update_pieces(rows[0].unionByName(rows[1]).unionByName(rows[2]))
    states = trip_update_state(decode_feed(files.withColumn("path", F.lit("x"))))
    found = feeds.overlap_examples(vehicles, newest_trip_states(states))

    def shown(stop) -> F.Column:
        time = F.coalesce(stop["arrival_time"].cast("string"), F.lit("-"))
        return F.concat_ws("@", stop["stop_sequence"].cast("string"), time)

    texts = F.array_join(F.transform("first_stop_updates", shown), " ")
    return found.withColumn("first_stop_updates", texts).drop("update_timestamp")


@registered("handshake_of_feed")
def _handshake_of_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read_snapshots(spark, landed(spark, sf_dir))
    return quality.handshake(feed_trip_ids(decode_feed(files, parts=True)), t.scoped_static(spark, sf_dir)["trips"])


@registered("publish_reconcile")
def _publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = FolderCatalog(spark, new_folder(spark, "gold"))
    tables = gold(spark, sf_dir)
    # Gold tables are stored; the copies and their comparison read what is there.
    tables = {name: catalog.replace(tables[name], name) for name in SERVING_TABLES}
    folder = new_folder(spark, "serving")
    publish(tables, parquet_sink(folder))
    return quality.reconcile(
        {name: (tables[name], read_published(spark, folder, name)) for name in SERVING_TABLES}
    )


@registered("publish_connector")
def _publish_connector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A serving copy through a data source that is named by its format, refreshed twice."""
    folder = new_folder(spark, "connector")
    # Gold tables are stored; each refresh reads what is there.
    stored = new_folder(spark, "published-gold")
    rel.route_reliability(events(spark, sf_dir)).write.parquet(stored)
    tables = {"route_reliability": spark.read.parquet(stored)}
    for _ in range(2):
        publish(tables, connector_sink("parquet", {"path": folder}), ["route_reliability"])
    return spark.read.parquet(folder)


# Streams. Each runs over all that is there and stops; the result is read back.


def _stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = t.table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


def _finish(query) -> None:
    query.awaitTermination()


@registered("stream_observations")
def _stream_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-history")
    catalog = FolderCatalog(spark, folder)
    rows = t.typed(t.feed_rows(spark, sf_dir, _stream_of(spark, sf_dir, "lineitem")))
    trips = t.scoped_static(spark, sf_dir)["trips"]
    scoped = observations_in_scope(rows, trips)
    _finish(stream_history.start_history(scoped, catalog, f"{folder}/checkpoint"))
    return read_history(catalog)


def _vehicle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.vehicles(spark, sf_dir, _stream_of(spark, sf_dir, "events"))


@registered("stream_latest_vehicles")
def _stream_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-vehicles")
    state, checkpoint = f"{folder}/state", f"{folder}/checkpoint"
    _finish(stream_live.start_vehicle_state(_vehicle_stream(spark, sf_dir), state, checkpoint))
    return stream_live.read_last_batch(spark, state).select(
        "vehicle_id", "trip_id", "latitude", "longitude", "vehicle_timestamp"
    )


@registered("stream_known_routes")
def _stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-routes")
    routes, checkpoint = f"{folder}/routes", f"{folder}/checkpoint"
    trips = t.raw_timetable(spark, sf_dir)["trips"]
    vehicles = _vehicle_stream(spark, sf_dir)
    _finish(stream_live.start_known_routes(vehicles, trips, routes, checkpoint))
    return stream_live.read_last_batch(spark, routes).select("route_id")


@registered("stream_live_board")
def _stream_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-board")
    rows, checkpoint = f"{folder}/board", f"{folder}/checkpoint"
    shown = _vehicle_stream(spark, sf_dir).filter(
        "vehicle_id is not null and trip_id is not null and latitude is not null"
    )
    _finish(
        stream_live.start_live_board(
            shown,
            lambda: t.updates(spark, sf_dir),
            context(spark, sf_dir),
            stops_of_trips(spark, sf_dir),
            lambda: t.NOW,
            rows,
            checkpoint,
        )
    )
    return stream_live.read_last_batch(spark, rows).drop("board_time")


@registered("stream_board_interval")
def _board_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board refreshed every second until all that is there is shown."""
    folder = new_folder(spark, "board-interval")
    shown = _vehicle_stream(spark, sf_dir).filter(
        "vehicle_id is not null and trip_id is not null and latitude is not null"
    )
    stream = stream_live.start_live_board(
        shown,
        lambda: t.updates(spark, sf_dir),
        context(spark, sf_dir),
        stops_of_trips(spark, sf_dir),
        lambda: t.NOW,
        f"{folder}/board",
        f"{folder}/checkpoint",
        every_seconds=1,
    )
    stream.processAllAvailable()
    stream.stop()
    return stream_live.read_board(spark, f"{folder}/board").drop("board_time")


@registered("live_board_from_feeds")
def _board_from_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live job over landed files of both feeds, in three batches.

    The second batch has the newest vehicles and updates; the third one is late: older
    vehicles, and older updates of every trip.
    """
    folder = new_folder(spark, "live-job")
    raw = t.raw_timetable(spark, sf_dir)
    catalog = FolderCatalog(spark, f"{folder}/tables")
    stored = write_board_tables(raw["trips"], raw["routes"], raw["stop_times"], raw["stops"], catalog)
    vehicles = t.vehicles(spark, sf_dir)
    days = (F.col("feed_timestamp") / 86400).cast("long")
    last = live.latest_value(vehicles, "feed_timestamp")
    newest, before = F.col("feed_timestamp") == last, F.col("feed_timestamp") < last
    stale = t.live_updates(spark, sf_dir, 1).unionByName(t.live_updates(spark, sf_dir, 2))
    stale = stale.withColumn("feed_timestamp", F.lit(t.UPDATE_TIMES[0] - 7))
    batches = [
        (before & (days % 2 == 0), [t.live_updates(spark, sf_dir, i) for i in (0, 1)]),
        (newest, [t.live_updates(spark, sf_dir, 2)]),
        (before & (days % 2 == 1), [stale]),
    ]
    for shown, updates in batches:
        for part, files in (
            ("vehicle_positions", vehicle_pieces(vehicles.filter(shown))),
            *(("trip_updates", update_pieces(rows)) for rows in updates),
        ):
            # A snapshot comes in several files if it is large.
            time = F.col("feed_timestamp").cast("string")
            name = F.concat(time, F.lit("-"), F.sha2("content", 256), F.lit(".pb"))
            place = landing_file(name, F.timestamp_seconds("feed_timestamp"))
            write_payload_files(
                files.select(place.alias("file"), "content"), f"{folder}/landing/{part}"
            )
        streams = [
            stream_history.snapshot_stream(spark, f"{folder}/landing/{part}")
            for part in ("vehicle_positions", "trip_updates")
        ]
        _finish(
            stream_live.start_live_job(
                streams[0].unionByName(streams[1]),
                stored[TRIP_CONTEXT],
                stored[TRIP_STOPS],
                lambda: t.NOW,
                f"{folder}/board",
                f"{folder}/checkpoint",
                keep_seconds=t.KEEP_SECONDS,
            )
        )
    return stream_live.read_board(spark, f"{folder}/board")


@registered("stream_hourly")
def _stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of the feed in three runs; the last one brings rows that are far too late."""
    folder = new_folder(spark, "stream-hourly")
    rows = t.realtime(spark, sf_dir)
    day = F.datediff("start_date", F.lit("2024-01-01").cast("date"))
    late = F.col("stop_sequence") == 2
    parts = [(day < 40) & ~F.coalesce(late, F.lit(False)), day >= 40, (day < 40) & late]
    for part in parts:
        rows.filter(part).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        _finish(stream_hourly.start_hourly(stream, f"{folder}/hours", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/hours")
