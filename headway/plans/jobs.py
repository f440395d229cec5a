"""The batch jobs: timetable tables, realtime history, Gold tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.constants import SCOPE_AGENCIES
from headway.operators import quality
from headway.operators import reliability as rel
from headway.operators.flatten import trip_update_rows, typed_observations
from headway.operators.history import (
    HISTORY_TABLE,
    append_new_snapshots,
    dedupe_observations,
    read_ledger,
)
from headway.operators.ids import (
    DICTIONARY,
    extend_dictionary,
    id_texts,
    numbered,
    numbered_texts,
    numbers_of,
    read_dictionary,
)
from headway.operators.live import (
    context_of_lines,
    trip_lines,
    trip_stops,
    with_destination_name,
)
from headway.operators.observations import canonical_events, stop_observations
from headway.operators.propagation import (
    delay_propagation_events,
    propagation_counts,
    route_delay_propagation,
)
from headway.operators.scope import (
    observations_in_scope,
    routes_in_scope,
    stop_events_in_scope,
    stops_in_use,
    trips_in_scope,
)
from headway.sources.feed import decode_feed, require_feed
from headway.sources.tables import Catalog
from headway.sources.timetable import read_timetable


# Timetable files whose text ids are numbers by now.
NUMBERED = "numbered_"


def run_static(
    spark: SparkSession,
    folder: str,
    catalog: Catalog,
    agencies: Iterable[int | str] = SCOPE_AGENCIES,
    text_ids: bool = False,
) -> dict[str, DataFrame]:
    """Timetable files to the four static tables and the two of the live board.

    Each table is written once and read back as the input of the next, so no
    step is computed twice. The board's tables cover all trips of the files.
    With ``text_ids`` ids may be any texts; the catalog's dictionary numbers them,
    and the realtime job of this catalog numbers those of the feeds alike.
    """
    files = ("routes", "trips", "stops", "stop_times")
    raw = {name: read_timetable(spark, folder, name, text_ids=text_ids) for name in files}
    if text_ids:
        extend_dictionary(catalog, *(id_texts(df) for df in raw.values()))
        dictionary = read_dictionary(catalog)
        # Several tables are made of each, so texts are looked up once.
        raw = {
            name: catalog.replace(numbered(df, dictionary), f"{NUMBERED}{name}")
            for name, df in raw.items()
        }
        agencies = numbers_of(dictionary, "agency", agencies)
    stop_times = raw["stop_times"]
    checks = []

    def replace(df: DataFrame, name: str) -> DataFrame:
        table, results = replace_checked(df, name, catalog)
        checks.append(results)
        return table

    routes = replace(routes_in_scope(raw["routes"], agencies), "routes")
    trips = replace(trips_in_scope(raw["trips"], routes), "trips")
    events = replace(stop_events_in_scope(stop_times, trips), "stop_events")
    stops = replace(stops_in_use(raw["stops"], events), "stops")
    catalog.replace(quality.all_results(checks).coalesce(1), STATIC_CHECKS)
    write_board_tables(raw["trips"], raw["routes"], stop_times, raw["stops"], catalog)
    return {"routes": routes, "trips": trips, "stop_events": events, "stops": stops}


# Checks of the static tables, taken while they were written.
STATIC_CHECKS = "static_checks"


def replace_checked(df: DataFrame, name: str, catalog: Catalog) -> tuple[DataFrame, DataFrame]:
    """Replace a source table; also its checks that need no grouping, observed on the way."""
    seen = Observation()
    table = catalog.replace(df.observe(seen, *quality.whole_measures(name)), name)
    # One row of numbers.
    row = catalog.spark.createDataFrame([seen.get])
    return table, quality.whole_results(row, name)


def stored_checks(catalog: Catalog) -> DataFrame:
    """The checks that need no grouping, of all source tables, without reading a table.

    Those of the static tables were stored by :func:`run_static`; those of the history are
    added up from its ledger.
    """
    columns = quality.CRITICAL_COLUMNS[HISTORY_TABLE]

    def nulls(c: str) -> Column:
        # A snapshot without a time is never taken.
        return F.lit(0) if c == "feed_timestamp" else F.sum(F.col("nulls")[c])

    measured = read_ledger(catalog).agg(
        F.sum("rows").alias("row_count/rows"), *[nulls(c).alias(f"null_values/{c}") for c in columns]
    )
    history = quality.whole_results(measured, HISTORY_TABLE)
    return catalog.read(STATIC_CHECKS).unionByName(history)


def silver_report(catalog: Catalog) -> DataFrame:
    """The report on a catalog's source tables; tables are read for grouped checks only."""
    return quality.silver_report(catalog.silver(), stored_checks(catalog))


# What the live board needs of the timetable, by trip.
TRIP_CONTEXT = "trip_context"
TRIP_STOPS = "trip_stops"


# Names and places of this many stops, some fifty megabytes, are sent to every executor.
MOST_SENT_STOPS = 500_000


def write_board_tables(
    trips: DataFrame, routes: DataFrame, stop_times: DataFrame, stops: DataFrame, catalog: Catalog
) -> dict[str, DataFrame]:
    """Store context and stops of every trip, bucketed by trip.

    The board's batches then neither aggregate nor shuffle the timetable: running trips are
    few and are broadcast to it, or, when they are many, are dealt to its buckets.
    """
    buckets = int(catalog.spark.conf.get("spark.sql.shuffle.partitions"))
    lines = trip_lines(trips, routes, stop_times)
    if stops.count() <= MOST_SENT_STOPS:
        # Ids are dealt, and names are added where they lie then.
        sent = F.broadcast(stops)
        times = stop_times.select("trip_id", "stop_id", "stop_sequence")
        frames = {
            TRIP_CONTEXT: (lines, lambda df: context_of_lines(with_destination_name(df, sent))),
            TRIP_STOPS: (times, lambda df: trip_stops(df, sent)),
        }
    else:
        frames = {
            TRIP_CONTEXT: (with_destination_name(lines, stops), context_of_lines),
            TRIP_STOPS: (trip_stops(stop_times, stops), None),
        }
    return {
        name: catalog.replace_bucketed(df, name, "trip_id", buckets, after)
        for name, (df, after) in frames.items()
    }


def observations_of(
    payloads: DataFrame,
    trips: DataFrame,
    strict: bool = True,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Landed payloads to deduplicated observations in scope.

    ``dictionary`` numbers the ids of feeds whose timetable has text ids.

    ``strict`` fails on a feed without a header time or usable stop update. A
    backfill turns it off, so that one empty night snapshot does not stop it.
    """
    feed = decode_feed(payloads, parts=True)
    checked = require_feed(feed) if strict else feed.filter("header.timestamp is not null")
    typed = typed_observations(trip_update_rows(checked))
    if dictionary is not None:
        typed = numbered_texts(typed, dictionary)
    return dedupe_observations(observations_in_scope(typed, trips))


def run_realtime(
    payloads: DataFrame, catalog: Catalog, strict: bool = True, table: str = HISTORY_TABLE
) -> None:
    """Append the snapshots in ``payloads`` that the history does not hold.

    ``payloads`` is any frame with ``path`` and ``content``: the newest
    snapshot, one ingestion day, or a whole archive.
    """
    dictionary = read_dictionary(catalog) if catalog.exists(DICTIONARY) else None
    observations = observations_of(payloads, catalog.read("trips"), strict, dictionary)
    append_new_snapshots(observations, catalog, table)


# Gold tables by the table they are computed from.
_FROM_OBSERVATIONS = {
    "hourly_reliability_patterns": rel.hourly_patterns,
    "daily_reliability_metrics": rel.daily_metrics,
}
_FROM_EVENTS = {
    "route_reliability": rel.route_reliability,
    "stop_reliability": rel.stop_reliability,
    "route_stop_reliability": rel.route_stop_reliability,
    "route_direction_reliability": rel.route_direction_reliability,
    "route_hourly_reliability": rel.route_hourly_reliability,
    "route_weekday_reliability": rel.route_weekday_reliability,
}


# Counts by service day that the aggregates are computed from; a day's counts follow from
# that day's rows alone.
EVENT_COUNTS = "stop_event_delay_counts"
OBSERVATION_COUNTS = "observation_delay_counts"
PROPAGATION_COUNTS = "delay_change_counts"


def gold_frames(silver: dict[str, DataFrame], keep=lambda df, name: df) -> dict[str, DataFrame]:
    """The twelve Gold tables.

    ``keep`` may materialise a table and return a frame that reads it; the
    tables that others are computed from then act as its readers' input. It is
    also given the daily counts, which are no Gold tables.
    """
    gold = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        gold[name] = keep(df, name)
        return gold[name]

    observations = add("reliability_stop_observations", stop_observations(silver))
    events = add("reliability_stop_events", canonical_events(observations))
    propagation = add("delay_propagation_stop_events", delay_propagation_events(events))
    by_observation = keep(rel.observation_counts(observations), OBSERVATION_COUNTS)
    by_event = keep(rel.event_counts(events), EVENT_COUNTS)
    by_change = keep(propagation_counts(propagation), PROPAGATION_COUNTS)
    for name, metrics in _FROM_OBSERVATIONS.items():
        add(name, metrics(by_observation, "n"))
    for name, metrics in _FROM_EVENTS.items():
        add(name, metrics(by_event, "n"))
    add("route_delay_propagation", route_delay_propagation(by_change, "n"))
    return gold


# Row-level tables and daily counts are laid out by service day.
_BY_DAY = (
    "reliability_stop_observations",
    "reliability_stop_events",
    "delay_propagation_stop_events",
    OBSERVATION_COUNTS,
    EVENT_COUNTS,
    PROPAGATION_COUNTS,
)


def build_gold(
    silver: dict[str, DataFrame], catalog: Catalog, days: Iterable[date] | None = None
) -> dict[str, DataFrame]:
    """Write the twelve Gold tables; each is computed once and then read back.

    A written table is also where a lost executor's work restarts from. With
    ``days``, the row-level tables and the daily counts are recomputed for those
    service days only, which is enough after an append: each of their rows
    depends on the history of its own day. A day that has no rows any more loses
    its partitions. The aggregates are refreshed from the counts of all days, so
    no row of another day is read.
    """
    if days is not None:
        days = list(days)
        history = silver["realtime_stop_events"]
        wanted = history.filter(F.col("start_date").isin(days))
        silver = {**silver, "realtime_stop_events": wanted}

    def keep(df: DataFrame, name: str) -> DataFrame:
        if name not in _BY_DAY:
            return catalog.replace(df, name)
        if days is None:
            return catalog.replace(df, name, ["service_date"])
        return catalog.replace_parts(day_rows(df, days), name, ["service_date"], days)

    return gold_frames(silver, keep)


def day_rows(df: DataFrame, days: Iterable[date]) -> DataFrame:
    """Rows of the given service days; prunes a table laid out by day."""
    return df.filter(F.col("service_date").isin(list(days)))
