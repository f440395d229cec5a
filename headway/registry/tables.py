"""The shared test tables, shaped as timetable, feed history and live feeds.

Each shape is a list of SQL expressions that reads the same in Spark and in the
SQL engine that checks the results; only the expressions named in ``SPARK`` and
``DUCKDB`` differ. Orders act as trips, line items as snapshots of a stop,
customers as routes, suppliers as stops and events as vehicle positions.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from headway.operators.scope import (
    routes_in_scope,
    scheduled_stop_events,
    stop_events_in_scope,
    stops_in_use,
    trips_in_scope,
)

AGENCIES = tuple(range(20))
# The moment of the live board, and a later one to measure ages against.
NOW = 1704067200
LATER = 1705363200

# Order dates are folded into this many service days from 2024-01-01 on, which
# include a change to summer time.
SERVICE_DAYS = 120

SPARK = {
    "days": "datediff(l_shipdate, o_orderdate)",
    "service_day": f"datediff(o_orderdate, date'1970-01-01') % {SERVICE_DAYS}",
    "event_epoch": "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)",
}
DUCKDB = {
    "days": "date_diff('day', o_orderdate, l_shipdate)",
    "service_day": "date_diff('day', date '1970-01-01', cast(o_orderdate as date))"
    f" % {SERVICE_DAYS}",
    "event_epoch": "cast(floor(epoch(ts)) as bigint)",
}

_STOP = "(l_orderkey * 7 + l_linenumber) % {stops}"
_MIDNIGHT = f"({NOW} + ({{service_day}}) * cast(86400 as bigint))"
_SECONDS = "(14400 + (l_orderkey * 613) % 72000 + l_linenumber * 900)"


def _clock(seconds: str) -> str:
    def part(value: str) -> str:
        return f"lpad(cast(cast(floor({value}) as bigint) as string), 2, '0')"

    hours = part(f"{seconds} / 3600")
    minutes = part(f"({seconds} % 3600) / 60")
    return f"{hours} || ':' || {minutes} || ':' || {part(f'{seconds} % 60')}"


ROUTES = [
    "cast(c_nationkey as bigint) as agency_id",
    "c_custkey as route_id",
    "case when c_custkey % 10 = 0 then 'B' || cast(c_custkey % 100 as string)"
    " when c_custkey % 9 = 0 then cast(c_custkey % 700 as string) || 'X'"
    " else cast(c_custkey % 700 as string) end as route_short_name",
    "c_name as route_long_name",
    "case c_custkey % 6 when 0 then 106 when 1 then 401 when 2 then 700"
    " when 3 then 900 when 4 then 1000 else 999 end as route_type",
]
TRIPS = [
    "o_custkey as route_id",
    "o_orderstatus as service_id",
    "o_orderkey as trip_id",
    "case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then '  '"
    " else o_orderpriority end as trip_headsign",
    "case when o_orderkey % 17 = 0 then null else cast(o_orderkey % 2 as int) end"
    " as direction_id",
    "'shape_' || cast(o_orderkey % 100 as string) as shape_id",
]
STOP_TIMES = [
    "l_orderkey as trip_id",
    # One stop in thirteen is another one than the feed reports.
    "case when (l_orderkey + l_linenumber) % 13 = 0"
    f" then (l_orderkey * 7 + l_linenumber + 1) % {{stops}} else {_STOP} end as stop_id",
    "l_linenumber as stop_sequence",
    f"case when (l_orderkey + l_linenumber) % 29 = 0 then '' else {_clock(_SECONDS)} end"
    " as arrival_time",
    f"case when (l_orderkey + l_linenumber) % 31 = 0 then null"
    f" else {_clock(f'({_SECONDS} + 60)')} end as departure_time",
]
STOPS = [
    "s_suppkey as stop_id",
    "s_name as stop_name",
    "case when s_suppkey % 23 = 0 then null"
    " else cast(59 as double) + cast(s_suppkey % 1000 as double) / 1000 end as stop_lat",
    "cast(18 as double) + cast(s_suppkey % 900 as double) / 1000 as stop_lon",
    "cast(s_nationkey % 2 as int) as location_type",
    "'P' || cast(s_nationkey as string) as parent_station",
    "cast(s_suppkey % 10 as string) as platform_code",
]
# Stops for the quality checks: those without a place have an id nobody uses.
CHECKED_STOPS = [
    "case when stop_lat is null then -1 - stop_id else stop_id end as stop_id",
    *(text.rsplit(" as ", 1)[1] for text in STOPS[1:]),
]
# A feed row; times are epoch seconds. An id that is no number and an unknown
# stop occur too.
REALTIME = [
    "case when l_partkey % 211 = 0 then 'extra-' || cast(l_orderkey as string)"
    " else cast(l_orderkey as string) end as trip_id",
    "case when l_partkey % 199 = 0 then cast({stops} + l_linenumber as string)"
    f" else cast({_STOP} as string) end as stop_id",
    "case when l_partkey % 97 = 0 then null else cast(l_linenumber as bigint) end"
    " as stop_sequence",
    "case when l_partkey % 41 = 0 then null"
    f" else {_MIDNIGHT} + {_SECONDS} + {{days}} end as arrival_time_actual",
    f"{_MIDNIGHT} + {_SECONDS} + {{days}} + 60 as departure_time_actual",
    "case when l_partkey % 19 = 0 then null else cast({days} as bigint) end"
    " as arrival_delay_seconds",
    "case when l_partkey % 23 = 0 then null else cast({days} + 30 as bigint) end"
    " as departure_delay_seconds",
    f"{_MIDNIGHT} + {_SECONDS} + {{days}} + (l_partkey % 1801) - 900 as feed_timestamp",
    "date '2024-01-01' + cast({service_day} as int) as start_date",
]
VEHICLES = [
    # A snapshot a day, some of them late: intervals differ.
    "{event_epoch} - {event_epoch} % 86400"
    " + cast(floor({event_epoch} / 86400) as bigint) % 3 * 7 as feed_timestamp",
    "event_id as entity_index",
    "cast(user_id as string) as vehicle_id",
    "case when event_type = 'error' then null else cast((event_id * 7) % {orders} as string)"
    " end as trip_id",
    "cast(event_id % 100 as string) as route_id",
    "case when event_id % 40 = 0 then null else"
    " cast(59 as double) + cast((event_id % 3) * 10 + user_id % 10 as double) / 1000 end"
    " as latitude",
    "case when event_id % 40 = 0 then null else"
    " cast(18 as double) + cast(user_id % 10 as double) / 1000 end as longitude",
    "{event_epoch} as vehicle_timestamp",
    "cast(event_id % 50 as string) as stop_id",
    "cast(event_id % 3 as int) as current_status",
]
_UPDATE_TIME = (
    f"min({NOW} - 900 + l_linenumber * 300 + (cast(l_quantity as bigint) * 37) % 600)"
)
# Snapshots of a day's rows, each at an hour of its own.
SNAPSHOT_TIME = (
    "feed_timestamp - feed_timestamp % 86400"
    " + cast(floor(feed_timestamp / 86400) as bigint) % 24 * 3600"
)
# Live stop updates come in three snapshots; a third of the trips is in the first, the second,
# or the second and the third one. Times of the second are ten minutes late.
UPDATE_TIMES = (NOW - 900, NOW - 60, NOW - 30)
KEEP_SECONDS = 300
# Grouped by order and line.
UPDATES = [
    "l_orderkey as trip_id",
    "l_linenumber as update_index",
    "l_linenumber as stop_sequence",
    f"case when (l_orderkey + l_linenumber) % 11 = 0 then null else {_UPDATE_TIME} end"
    " as arrival_time",
    "case when l_linenumber % 4 = 0 then null"
    " else min((cast(l_quantity as bigint) * 13) % 900 - 200) end as arrival_delay",
    f"{_UPDATE_TIME} + 30 as departure_time",
    "max(cast(l_quantity as bigint) * 7 - 150) as departure_delay",
]

_SHARES = [
    "avg_arrival_delay_seconds",
    "median_arrival_delay_seconds",
    "p95_arrival_delay_seconds",
    "on_time_pct",
    "over_5_min_late_pct",
    "over_10_min_late_pct",
]
# The numbers of the Gold tables that are added up to compare them as wholes.
GOLD_NUMBERS = {
    "reliability_stop_observations": ["trip_id", "stop_id", "arrival_delay_seconds"],
    "reliability_stop_events": ["trip_id", "stop_sequence", "seconds_from_reported_arrival"],
    "delay_propagation_stop_events": ["previous_arrival_delay_seconds", "delay_change_seconds"],
    "hourly_reliability_patterns": ["scheduled_hour", "observations", *_SHARES],
    "daily_reliability_metrics": ["observations", *_SHARES],
    "route_reliability": ["route_id", "observations", *_SHARES],
    "stop_reliability": ["stop_id", "observations", *_SHARES],
    "route_stop_reliability": ["route_id", "stop_events", *_SHARES],
    "route_direction_reliability": ["direction_id", "stop_events", *_SHARES],
    "route_hourly_reliability": ["scheduled_hour", "stop_events", *_SHARES],
    "route_weekday_reliability": ["day_of_week_number", "stop_events", *_SHARES],
    "route_delay_propagation": [
        "propagation_events",
        "extreme_propagation_events",
        "avg_delay_change_seconds",
        "median_delay_change_seconds",
        "pct_delay_accumulated",
    ],
}


def filled(expressions: list[str], names: dict[str, str]) -> list[str]:
    return [text.format(**names) for text in expressions]


@lru_cache(maxsize=None)
def _opened(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The files never change, so their schema is looked up once per session.
    return _opened(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=None)
def _size(spark: SparkSession, sf_dir: str, name: str) -> int:
    # Answered from file footers.
    return table(spark, sf_dir, name).count()


def raw_timetable(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    names = {"stops": _size(spark, sf_dir, "supplier")}
    return {
        "routes": table(spark, sf_dir, "customer").selectExpr(*ROUTES),
        "trips": table(spark, sf_dir, "orders").selectExpr(*TRIPS),
        "stop_times": lines.selectExpr(*filled(STOP_TIMES, names)),
        "stops": table(spark, sf_dir, "supplier").selectExpr(*STOPS),
    }


def feed_rows(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Feed rows before typing: times are epoch seconds."""
    names = {"stops": _size(spark, sf_dir, "supplier"), **SPARK}
    source = table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    lines = source.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        *filled(REALTIME, names)
    )


def typed(rows: DataFrame) -> DataFrame:
    times = ["arrival_time_actual", "departure_time_actual", "feed_timestamp"]
    return rows.withColumns({name: F.timestamp_seconds(name) for name in times})


def realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(feed_rows(spark, sf_dir))


def scoped_static(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four static tables, narrowed step by step."""
    raw = raw_timetable(spark, sf_dir)
    routes = routes_in_scope(raw["routes"], AGENCIES)
    trips = trips_in_scope(raw["trips"], routes)
    events = stop_events_in_scope(raw["stop_times"], trips)
    return {
        "routes": routes,
        "trips": trips,
        "stop_events": events,
        "stops": stops_in_use(raw["stops"], events),
    }


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Source tables for the Gold queries.

    Only the routes are narrowed: the inner joins of the Gold tables carry that
    over to trips, stops and history, so narrowing those too would only add the
    same joins a second time.
    """
    raw = raw_timetable(spark, sf_dir)
    return {
        "routes": routes_in_scope(raw["routes"], AGENCIES),
        "trips": raw["trips"],
        "stop_events": scheduled_stop_events(raw["stop_times"]),
        "stops": raw["stops"],
        "realtime_stop_events": realtime(spark, sf_dir),
    }


def checked_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables with faults for the quality checks: unscoped children next to
    scoped parents, and an undeduplicated history."""
    full = silver(spark, sf_dir)
    return {**full, "stops": full["stops"].selectExpr(*CHECKED_STOPS)}


def vehicles(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    names = {"orders": _size(spark, sf_dir, "orders"), **SPARK}
    source = table(spark, sf_dir, "events") if events is None else events
    return source.selectExpr(*filled(VEHICLES, names))


# Every other id is a text.
def text_id(letter: str, column: str) -> str:
    return (
        f"case when {column} % 2 = 0 then '{letter}' || cast({column} as string)"
        f" else cast({column} as string) end"
    )


ID_LETTERS = {"agency_id": "A", "route_id": "R", "trip_id": "T", "stop_id": "S"}


def with_text_ids(df: DataFrame) -> DataFrame:
    """A table of numbers with text ids; feed ids that are no number stay as they are."""
    for name, letter in ID_LETTERS.items():
        if name in df.columns:
            text = F.expr(text_id(letter, f"try_cast({name} as bigint)"))
            df = df.withColumn(name, F.coalesce(text, F.col(name).cast("string")))
    return df


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, line = "l_orderkey", "l_linenumber"
    aggregated = [F.expr(text) for text in UPDATES[3:]]
    lines = table(spark, sf_dir, "lineitem").select(key, line, "l_quantity")
    # Few rows share an order's line: counting them before they are dealt would save nothing
    # and fill the memory of the tasks that read, of which a file may have but one.
    grouped = lines.repartition(key, line).groupBy(key, line).agg(*aggregated)
    return grouped.selectExpr(*UPDATES[:3], *grouped.columns[2:])


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed rows as a snapshot a day brings them."""
    return feed_rows(spark, sf_dir).withColumn("feed_timestamp", F.expr(SNAPSHOT_TIME))


def live_updates(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    """Stop updates of one of the three live snapshots."""
    rows = updates(spark, sf_dir).withColumn("feed_timestamp", F.lit(UPDATE_TIMES[snapshot]))
    shown = F.col("trip_id") % 3 == (2, 0, 1)[snapshot]
    if snapshot == 1:
        shown |= F.col("trip_id") % 3 == 1
        late = {c: F.col(c) + 600 for c in ("arrival_time", "departure_time")}
        rows = rows.withColumns(late)
    return rows.filter(shown)


def plain(df: DataFrame) -> DataFrame:
    """Instants as epoch seconds, so results do not depend on a time zone."""
    return df.select(
        *[
            F.unix_seconds(field.name).alias(field.name)
            if isinstance(field.dataType, TimestampType)
            else F.col(field.name)
            for field in df.schema
        ]
    )
