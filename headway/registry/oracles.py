"""The registered queries as plain SQL, for checking against another engine."""

from __future__ import annotations

from headway.constants import HISTORY_MODES, LIVE_MODES
from headway.operators.quality import (
    CRITICAL_COLUMNS,
    GOLD_FILLED,
    GOLD_GRAIN,
    REFERENCES,
    UNIQUE_KEYS,
)
from headway.registry import tables as t

_NAMES = {
    "stops": "(select count(*) from supplier)",
    "orders": "(select count(*) from orders)",
    **t.DUCKDB,
}


def _pick(expressions: list[str]) -> str:
    return ", ".join(t.filled(expressions, _NAMES))


def _case(mapping: dict, column: str, default: str) -> str:
    def literal(key) -> str:
        return f"'{key}'" if isinstance(key, str) else str(key)

    arms = " ".join(f"when {literal(k)} then '{v}'" for k, v in mapping.items())
    return f"case {column} {arms} else '{default}' end"


def half_up(number: str, count: str) -> str:
    """number / count with two decimals, halves away from zero."""
    number = f"cast({number} as bigint)"
    return (
        f"cast(sign({number}) * ((abs({number}) * 200 + {count}) // (2 * {count}))"
        " as double) / 100"
    )


def half_up_1(number: str, count: str) -> str:
    """Non-negative number / count with one decimal, halves up."""
    return f"cast((cast({number} as bigint) * 20 + {count}) // (2 * {count}) as double) / 10"


def pct(flag: str, count: str = "count(*)") -> str:
    return half_up(f"100 * count(case when {flag} then 1 end)", count)


def metrics(source: str, keys: str, count_name: str, where: str = "true") -> str:
    d = "arrival_delay_seconds"
    return (
        f"select {keys}, count(*) as {count_name},"
        f" {half_up(f'sum({d})', 'count(*)')} as avg_arrival_delay_seconds,"
        f" quantile_disc({d}, 0.5) as median_arrival_delay_seconds,"
        f" quantile_disc({d}, 0.95) as p95_arrival_delay_seconds,"
        f" {pct(f'abs({d}) <= 60')} as on_time_pct,"
        f" {pct(f'{d} > 300')} as over_5_min_late_pct,"
        f" {pct(f'{d} > 600')} as over_10_min_late_pct"
        f" from {source} where {d} is not null and {where} group by {keys}"
    )


def _seconds(column: str) -> str:
    def part(n: int) -> str:
        return f"try_cast(split_part({column}, ':', {n}) as int)"

    return f"{part(1)} * 3600 + {part(2)} * 60 + {part(3)}"


_ROUTE = "route_id, route_short_name, route_long_name, transport_mode"
_EVENT = (
    "service_date, trip_id, route_id, route_short_name, route_long_name, transport_mode,"
    " trip_headsign, direction_id, stop_id, stop_name, stop_sequence,"
    " scheduled_arrival_time, scheduled_departure_time, scheduled_arrival_seconds,"
    " scheduled_departure_seconds, arrival_time_actual, departure_time_actual,"
    " arrival_delay_seconds, departure_delay_seconds, feed_timestamp"
)
_NOW = t.NOW

# Views by name: SQL text and the views it reads.
VIEWS: dict[str, tuple[str, list[str]]] = {
    "raw_routes": (f"select {_pick(t.ROUTES)} from customer", []),
    "raw_trips": (f"select {_pick(t.TRIPS)} from orders", []),
    "raw_stop_times": (
        f"select {_pick(t.STOP_TIMES)} from"
        " (select distinct l_orderkey, l_linenumber from lineitem)",
        [],
    ),
    "raw_stops": (f"select {_pick(t.STOPS)} from supplier", []),
    "realtime": (
        f"select {_pick(t.REALTIME)} from lineitem join orders on l_orderkey = o_orderkey",
        [],
    ),
    "vehicles": (f"select {_pick(t.VEHICLES)} from events", []),
    "updates": (
        f"select {_pick(t.UPDATES)} from lineitem group by l_orderkey, l_linenumber",
        [],
    ),
    "routes": (
        "select route_id, route_short_name, route_long_name, route_type,"
        f" {_case(HISTORY_MODES, 'route_type', 'unknown')} as transport_mode"
        " from raw_routes where agency_id < 20",
        ["raw_routes"],
    ),
    "trips": (
        "select trip_id, route_id, service_id, trip_headsign, direction_id, shape_id"
        " from raw_trips where route_id in (select route_id from routes)",
        ["raw_trips", "routes"],
    ),
    "all_stop_events": (
        "select trip_id, stop_sequence, stop_id, arrival_time as arrival_time_raw,"
        f" departure_time as departure_time_raw, {_seconds('arrival_time')} as arrival_seconds,"
        f" {_seconds('departure_time')} as departure_seconds from raw_stop_times",
        ["raw_stop_times"],
    ),
    "stop_events": (
        "select * from all_stop_events where trip_id in (select trip_id from trips)",
        ["all_stop_events", "trips"],
    ),
    "stops": (
        "select * from raw_stops where stop_id in (select stop_id from stop_events)",
        ["raw_stops", "stop_events"],
    ),
    "scoped_realtime": (
        "select * from realtime where try_cast(trip_id as bigint) in (select trip_id from trips)",
        ["realtime", "trips"],
    ),
    "deduped": (
        "select * exclude (rn) from (select *, row_number() over ("
        "partition by feed_timestamp, trip_id, stop_sequence order by stop_id nulls last,"
        " arrival_time_actual nulls last, departure_time_actual nulls last,"
        " arrival_delay_seconds nulls last, departure_delay_seconds nulls last,"
        " start_date nulls last) as rn from scoped_realtime) where rn = 1",
        ["scoped_realtime"],
    ),
    "observations": (
        "select r.start_date as service_date, s.trip_id, t.route_id, rt.route_short_name,"
        " rt.route_long_name, rt.transport_mode, t.trip_headsign, t.direction_id, s.stop_id,"
        " st.stop_name, s.stop_sequence, r.feed_timestamp,"
        " s.arrival_time_raw as scheduled_arrival_time,"
        " s.departure_time_raw as scheduled_departure_time,"
        " s.arrival_seconds as scheduled_arrival_seconds,"
        " s.departure_seconds as scheduled_departure_seconds,"
        " r.arrival_time_actual, r.departure_time_actual, r.arrival_delay_seconds,"
        " r.departure_delay_seconds"
        " from realtime r"
        " join all_stop_events s on try_cast(r.trip_id as bigint) = s.trip_id"
        " and try_cast(r.stop_id as bigint) = s.stop_id and r.stop_sequence = s.stop_sequence"
        " join raw_trips t on s.trip_id = t.trip_id"
        " join routes rt on t.route_id = rt.route_id"
        " join raw_stops st on s.stop_id = st.stop_id",
        ["realtime", "all_stop_events", "raw_trips", "routes", "raw_stops"],
    ),
    "canonical": (
        f"select {_EVENT}, seconds_from_reported_arrival from (select *,"
        " abs(feed_timestamp - arrival_time_actual) as seconds_from_reported_arrival,"
        " row_number() over (partition by service_date, trip_id, stop_id, stop_sequence"
        " order by abs(feed_timestamp - arrival_time_actual), feed_timestamp desc,"
        " arrival_delay_seconds nulls last, departure_delay_seconds nulls last,"
        " arrival_time_actual nulls last, departure_time_actual nulls last) as rn"
        " from observations where arrival_time_actual is not null) where rn = 1",
        ["observations"],
    ),
    "propagation": (
        "select *, arrival_delay_seconds - previous_arrival_delay_seconds"
        " as delay_change_seconds,"
        " abs(arrival_delay_seconds - previous_arrival_delay_seconds) > 600"
        " as is_extreme_propagation from (select service_date, trip_id, route_id,"
        " route_short_name, route_long_name, transport_mode, trip_headsign, direction_id,"
        " stop_id, stop_name, stop_sequence, scheduled_arrival_seconds, arrival_delay_seconds,"
        " lag(stop_id) over w as previous_stop_id, lag(stop_name) over w as previous_stop_name,"
        " lag(arrival_delay_seconds) over w as previous_arrival_delay_seconds"
        " from canonical where arrival_delay_seconds is not null"
        " window w as (partition by service_date, trip_id order by stop_sequence, stop_id))",
        ["canonical"],
    ),
    "route_reliability": (metrics("canonical", _ROUTE, "observations"), ["canonical"]),
    "stop_reliability": (
        metrics("canonical", "stop_id, stop_name, transport_mode", "observations"),
        ["canonical"],
    ),
    "route_stop_reliability": (
        metrics("canonical", f"{_ROUTE}, stop_id, stop_name", "stop_events"),
        ["canonical"],
    ),
    "route_direction_reliability": (
        metrics("canonical", f"{_ROUTE}, direction_id", "stop_events", "direction_id is not null"),
        ["canonical"],
    ),
    "route_hourly_reliability": (
        metrics(
            "(select *, cast(floor(scheduled_arrival_seconds / 3600) as bigint)"
            " as scheduled_hour from canonical)",
            f"{_ROUTE}, scheduled_hour",
            "stop_events",
            "scheduled_arrival_seconds is not null",
        ),
        ["canonical"],
    ),
    "route_weekday_reliability": (
        metrics(
            "(select *, cast(dayofweek(service_date) + 1 as int) as day_of_week_number,"
            " dayname(service_date) as day_of_week from canonical)",
            f"{_ROUTE}, day_of_week_number, day_of_week",
            "stop_events",
        ),
        ["canonical"],
    ),
    "hourly_patterns": (
        metrics(
            "(select *, cast((scheduled_arrival_seconds // 3600) % 24 as int)"
            " as scheduled_hour from observations)",
            "transport_mode, scheduled_hour",
            "observations",
            "scheduled_arrival_seconds is not null",
        ),
        ["observations"],
    ),
    "daily_metrics": (
        metrics("observations", "service_date, transport_mode", "observations"),
        ["observations"],
    ),
    "route_propagation": (
        f"select {_ROUTE}, count(*) as propagation_events,"
        " count(case when is_extreme_propagation then 1 end) as extreme_propagation_events,"
        f" {pct('is_extreme_propagation')} as extreme_propagation_pct,"
        " case when count(u) > 0 then "
        + half_up("coalesce(sum(u), 0)", "greatest(count(u), 1)")
        + " end as avg_delay_change_seconds,"
        " quantile_disc(u, 0.5) as median_delay_change_seconds,"
        " case when count(u) > 0 then "
        + pct("u > 0", "greatest(count(u), 1)")
        + " end as pct_delay_accumulated,"
        " case when count(u) > 0 then "
        + pct("u < 0", "greatest(count(u), 1)")
        + " end as pct_delay_recovered"
        " from (select *, case when not is_extreme_propagation then delay_change_seconds end as u"
        " from propagation where delay_change_seconds is not null)"
        f" group by {_ROUTE}",
        ["propagation"],
    ),
    # Live
    "live_vehicles": (
        "select * from vehicles where vehicle_id is not null and trip_id is not null"
        " and latitude is not null"
        " and feed_timestamp = (select max(feed_timestamp) from vehicles)",
        ["vehicles"],
    ),
    "context": (
        "select t.trip_id, t.route_id, t.trip_headsign, r.route_short_name, r.route_long_name,"
        " r.route_type, f.stop_id as destination_stop_id, s.stop_name as destination_stop_name,"
        f" {_case(LIVE_MODES, 'cast(r.route_type as varchar)', 'other')} as transport_mode,"
        " coalesce(nullif(trim(t.trip_headsign), ''), s.stop_name, 'Unknown destination')"
        " as destination from raw_trips t left join raw_routes r on t.route_id = r.route_id"
        " left join (select trip_id, arg_max(stop_id, stop_sequence) as stop_id"
        " from raw_stop_times group by trip_id) f on t.trip_id = f.trip_id"
        " left join raw_stops s on f.stop_id = s.stop_id",
        ["raw_trips", "raw_routes", "raw_stop_times", "raw_stops"],
    ),
    "trip_stops": (
        "select st.trip_id, st.stop_sequence, st.stop_id, s.stop_name, s.stop_lat, s.stop_lon"
        " from raw_stop_times st left join raw_stops s on st.stop_id = s.stop_id",
        ["raw_stop_times", "raw_stops"],
    ),
    "board": (
        "select v.vehicle_id, v.trip_id, v.latitude, v.longitude, v.vehicle_timestamp,"
        " c.route_id, coalesce(c.route_short_name, 'Unknown') as route_short_name,"
        " c.route_long_name, coalesce(c.transport_mode, 'other') as transport_mode,"
        " coalesce(c.destination, 'Unknown destination') as destination"
        " from (select * from (select *, row_number() over (partition by vehicle_id"
        " order by entity_index) as rn from live_vehicles) where rn = 1) v"
        " left join context c on cast(v.trip_id as bigint) = c.trip_id",
        ["live_vehicles", "context"],
    ),
    "coming": (
        "select * from (select *, coalesce(arrival_time, departure_time) as event_time,"
        " row_number() over (partition by trip_id order by"
        " coalesce(arrival_time, departure_time), update_index) as rn from updates"
        f" where coalesce(arrival_time, departure_time) >= {_NOW}) where rn = 1",
        ["updates"],
    ),
    "live_board": (
        "select b.*, case when n.trip_id is null then 'Live position available'"
        " else coalesce(s.stop_name, 'Unknown stop') end as next_stop,"
        " case when n.event_time is null then '' else"
        " strftime(timezone('Europe/Stockholm', to_timestamp(n.event_time)), '%H:%M')"
        " end as next_time,"
        f" {{delay_text}} as delay_display, s.stop_id as next_stop_id,"
        " case when n.trip_id is null then 'position_only' else 'trip_update' end"
        " as realtime_status"
        " from board b left join coming n on cast(b.trip_id as bigint) = n.trip_id"
        " left join trip_stops s on n.trip_id = s.trip_id and n.stop_sequence = s.stop_sequence",
        ["board", "coming", "trip_stops"],
    ),
    "catalog": (
        "select l.route_id, coalesce(r.route_short_name, '') as route_short_name,"
        " coalesce(r.route_long_name, '') as route_long_name, l.transport_mode,"
        " case when l.transport_mode in ('subway', 'rail', 'tram', 'ferry')"
        " then coalesce(nullif(r.route_long_name, ''), r.route_short_name)"
        " else coalesce(nullif(r.route_short_name, ''), r.route_long_name) end"
        " || coalesce(' — ' || e.ends, '') as route_label"
        " from (select distinct route_id, transport_mode from context) l"
        " left join raw_routes r on l.route_id = r.route_id"
        " left join (select route_id, string_agg(destination, ' ↔ ' order by place)"
        " as ends from (select route_id, destination, row_number() over (partition by route_id"
        " order by min(trip_id)) as place from context"
        " where destination <> 'Unknown destination' group by route_id, destination)"
        " where place <= 2 group by route_id) e on l.route_id = e.route_id",
        ["context", "raw_routes"],
    ),
}


def _delay_text(column: str) -> str:
    minutes = f"cast(round_even({column} / 60.0, 0) as bigint)"
    return (
        f"case when {column} is null then '' when {minutes} > 0 then {minutes} || ' min late'"
        f" when {minutes} < 0 then abs({minutes}) || ' min early' else 'On time' end"
    )


def _age_text(column: str) -> str:
    age = f"greatest(0, {t.LATER} - {column})"
    return (
        f"case when {age} < 60 then {age} || ' sec ago' else ({age} // 60) || ' min ago' end"
    )


_LIVE_BOARD, _READS = VIEWS["live_board"]
VIEWS["live_board"] = (
    _LIVE_BOARD.replace(
        "{delay_text}", _delay_text("coalesce(n.arrival_delay, n.departure_delay)")
    ),
    _READS,
)

VIEWS["snapshot_rows"] = (
    f"select * replace ({t.SNAPSHOT_TIME} as feed_timestamp) from realtime",
    ["realtime"],
)
VIEWS["scoped_snapshots"] = (
    VIEWS["scoped_realtime"][0].replace("from realtime", "from snapshot_rows"),
    ["snapshot_rows", "trips"],
)
VIEWS["deduped_snapshots"] = (
    VIEWS["deduped"][0].replace("scoped_realtime", "scoped_snapshots"),
    ["scoped_snapshots"],
)
# What the live feeds leave: trips of the second snapshot are late, those of the first gone.
VIEWS["feed_updates"] = (
    f"select * replace (arrival_time + late as arrival_time, departure_time + late as"
    f" departure_time) from (select *, case trip_id % 3 when 0 then 600 else 0 end as late,"
    f" case trip_id % 3 when 0 then {t.UPDATE_TIMES[1]} else {t.UPDATE_TIMES[2]} end"
    " as feed_timestamp from updates where trip_id % 3 < 2)",
    ["updates"],
)
VIEWS["feed_coming"] = (
    VIEWS["coming"][0].replace("from updates", "from feed_updates"),
    ["feed_updates"],
)
VIEWS["feed_board"] = (
    VIEWS["live_board"][0].replace("join coming", "join feed_coming"),
    ["board", "feed_coming", "trip_stops"],
)

# Gold over the snapshots of landed files.
VIEWS["snapshot_observations"] = (
    VIEWS["observations"][0].replace("from realtime", "from deduped_snapshots"),
    [*(v for v in VIEWS["observations"][1] if v != "realtime"), "deduped_snapshots"],
)
VIEWS["snapshot_canonical"] = (
    VIEWS["canonical"][0].replace("from observations", "from snapshot_observations"),
    ["snapshot_observations"],
)


def query(body: str, *reads: str) -> str:
    """``body`` with the views it reads, and theirs, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][1]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in reads:
        add(name)
    # A view is read by several others; without this each would recompute it.
    views = ", ".join(f"{name} as materialized ({VIEWS[name][0]})" for name in ordered)
    return f"with {views} {body}" if views else body


def view(name: str) -> str:
    return query(f"select * from {name}", name)


def _result(check: str, table: str, subject: str, value: str, source: str, ok: str) -> str:
    return (
        f"select '{check}' as check_name, '{table}' as table_name, '{subject}' as subject,"
        f" v as value, {ok} as passed from (select {value} as v from {source})"
    )


# The quality checks read the unscoped tables; see tables.checked_tables.
_CHECKED = {
    "routes": "routes",
    "trips": "raw_trips",
    "stop_events": "all_stop_events",
    "stops": f"(select {', '.join(t.CHECKED_STOPS)} from raw_stops)",
    "realtime_stop_events": "realtime",
}
_CHECKED_READS = ["routes", "raw_trips", "all_stop_events", "raw_stops", "realtime"]
_GOLD = {
    "reliability_stop_observations": "observations",
    "reliability_stop_events": "canonical",
    "delay_propagation_stop_events": "propagation",
    "hourly_reliability_patterns": "hourly_patterns",
    "daily_reliability_metrics": "daily_metrics",
    "route_delay_propagation": "route_propagation",
    **{
        name: name
        for name in (
            "route_reliability",
            "stop_reliability",
            "route_stop_reliability",
            "route_direction_reliability",
            "route_hourly_reliability",
            "route_weekday_reliability",
        )
    },
}


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


def _nulls(tables: dict[str, str], rules: dict[str, list[str]]) -> str:
    return _union(
        [
            _result(
                "null_values",
                name,
                column,
                "count(*)",
                f"{source} where {column} is null",
                "v = 0",
            )
            for name, source in tables.items()
            for column in rules[name]
        ]
    )


def _duplicates(tables: dict[str, str], rules: dict[str, list[str]]) -> str:
    return _union(
        [
            _result(
                "duplicate_groups",
                name,
                " + ".join(rules[name]),
                "count(*)",
                f"(select 1 from {source} group by {', '.join(rules[name])} having count(*) > 1)",
                "v = 0",
            )
            for name, source in tables.items()
        ]
    )


def _gold_totals() -> str:
    parts = []
    for name, source in _GOLD.items():
        sums = {c: f"coalesce(sum(cast(round({c} * 100) as bigint)), 0)" for c in t.GOLD_NUMBERS[name]}
        for subject, value in {"rows": "count(*)", **sums}.items():
            parts.append(
                f"select '{name}' as table_name, '{subject}' as subject,"
                f" cast({value} as bigint) as value from {source}"
            )
    return _union(parts)


def _orphans(tables: dict[str, str]) -> str:
    parts = []
    for child, key, parent in REFERENCES:
        source = (
            f"(select distinct {key} as k from {tables[child]}) c where not exists"
            f" (select 1 from {tables[parent]} p where p.{key} = try_cast(c.k as bigint))"
        )
        parts.append(
            _result(
                "orphan_keys", child, f"{key} -> {parent}.{key}", "count(*)", source, "v = 0"
            )
        )
    return _union(parts)


def _times(events: str) -> str:
    counted = {
        "missing arrival": ("coalesce(trim(arrival_time_raw), '') = ''", "v = 0"),
        "missing departure": ("coalesce(trim(departure_time_raw), '') = ''", "v = 0"),
        "arrival past 24:00": ("arrival_seconds >= 86400", "true"),
        "departure past 24:00": ("departure_seconds >= 86400", "true"),
    }
    parts = [
        _result("times", "stop_events", subject, "count(*)", f"{events} where {rule}", ok)
        for subject, (rule, ok) in counted.items()
    ]
    short = f"(select 1 from {events} group by trip_id having count(*) < 2)"
    parts.append(
        _result("times", "stop_events", "trips below two stops", "count(*)", short, "v = 0")
    )
    return _union(parts)


def _counts(tables: dict[str, str]) -> str:
    return _union(
        [
            _result("row_count", name, "rows", "count(*)", source, "v > 0")
            for name, source in tables.items()
        ]
    )


def _profile(events: str) -> str:
    return (
        "select trip_id, count(*) as stop_count, min(stop_sequence) as min_sequence,"
        f" max(stop_sequence) as max_sequence from {events} group by trip_id"
    )


_PROFILE = _profile("all_stop_events")


def _issues(events: str) -> str:
    return f"select * from ({_profile(events)}) where min_sequence <> 1 or stop_count <> max_sequence"


_ISSUES = _issues("all_stop_events")


def _sequence(events: str) -> str:
    issues = f"({_issues(events)})"
    return _result("sequence_issues", "stop_events", "trip_id", "count(*)", issues, "v = 0")


def _report(tables: dict[str, str]) -> str:
    """All checks of the five source tables."""
    events = tables["stop_events"]
    return _union(
        [
            _counts(tables),
            _nulls(tables, CRITICAL_COLUMNS),
            _duplicates(tables, UNIQUE_KEYS),
            _orphans(tables),
            _sequence(events),
            _times(events),
        ]
    )


def _weighted(name: str, weight: str) -> str:
    # In whole hundredths of the rounded metric.
    number = f"cast(sum(cast(round({name} * 100) as bigint) * {weight}) as bigint)"
    whole = f"cast(sum({weight}) as bigint)"
    return f"cast(sign({number}) * ((abs({number}) * 2 + {whole}) // (2 * {whole})) as double) / 100"


def _hundredths(difference: str) -> str:
    return f"cast(round(({difference}) * 100) as bigint) / 100.0"


_IN_BOTH = "count(case when v is not null and u is not null then 1 end)"
_VISIBLE = "('bus', 'ferry', 'subway', 'tram')"
_SORT = (
    "case when regexp_matches(route_short_name, '^[0-9]') then 0 else 1 end,"
    " coalesce(try_cast(nullif(regexp_extract(route_short_name, '^[0-9]+'), '') as bigint), 0),"
    " lower(regexp_replace(route_short_name, '^[0-9]+', '')), route_id"
)
_CHANGES = (
    "select a.feed_timestamp, p.previous_timestamp, a.vehicle_id, a.vehicle_timestamp,"
    " (a.latitude is distinct from b.latitude or a.longitude is distinct from b.longitude) as moved,"
    " a.vehicle_timestamp is distinct from b.vehicle_timestamp as retimed"
    " from latest a join snapshots p on a.feed_timestamp = p.feed_timestamp"
    " join latest b on a.vehicle_id = b.vehicle_id"
    " and b.feed_timestamp = p.previous_timestamp"
)
# The snapshot before is the latest time below, found by a join on that.
_SNAPSHOTS = (
    "select a.feed_timestamp, max(b.feed_timestamp) as previous_timestamp"
    " from (select distinct feed_timestamp from latest) a"
    " join (select distinct feed_timestamp from latest) b on b.feed_timestamp < a.feed_timestamp"
    " group by a.feed_timestamp"
)
_LATEST = (
    "select * exclude (rn) from (select *, row_number() over (partition by feed_timestamp,"
    " vehicle_id order by entity_index desc) as rn from vehicles where vehicle_id is not null)"
    " where rn = 1"
)
# Every vehicle is followed, whether it is on the board or not.
_FOLLOWED = "(select distinct vehicle_id from vehicles)"
VIEWS["latest"] = (_LATEST, ["vehicles"])
VIEWS["snapshots"] = (_SNAPSHOTS, ["latest"])
VIEWS["changes"] = (_CHANGES, ["latest", "snapshots"])
VIEWS["followed"] = (
    f"select b.* from live_board b join {_FOLLOWED} f on b.vehicle_id = f.vehicle_id",
    ["live_board", "vehicles"],
)
# The headline figures twice: out of the route table, and of the events.
_SHARES = ("on_time_pct", "over_5_min_late_pct", "over_10_min_late_pct")
VIEWS["r"] = (
    "select cast(sum(observations) as double) as total_observations, "
    + ", ".join(
        f"{_weighted(name, 'observations')} as {name}"
        for name in ("avg_arrival_delay_seconds", *_SHARES)
    )
    + " from route_reliability",
    ["route_reliability"],
)
VIEWS["e"] = (
    "select cast(observations as double) as total_observations, avg_arrival_delay_seconds, "
    + ", ".join(_SHARES)
    + f" from ({metrics('(select *, 1 as whole from canonical)', 'whole', 'observations')})",
    ["canonical"],
)
_HISTORY_COLUMNS = (
    "trip_id, stop_id, stop_sequence, arrival_time_actual, departure_time_actual,"
    " arrival_delay_seconds, departure_delay_seconds, feed_timestamp, start_date"
)
_FEED_DATE = (
    "cast(date '1970-01-01' + cast(floor(feed_timestamp / 86400) as int) as date) as feed_date"
)


def oracle_queries() -> dict[str, str]:
    gold_reads = list(_GOLD.values())
    return {
        # Scope
        "routes_scope": view("routes"),
        "trips_scope": view("trips"),
        "stop_events_scope": view("stop_events"),
        "stops_used": view("stops"),
        "realtime_scope": view("scoped_realtime"),
        "observations_dedup": view("deduped"),
        **{
            name: query(f"select {_HISTORY_COLUMNS}, {_FEED_DATE} from deduped", "deduped")
            for name in ("append_new_snapshots", "history_after_lost_load", "history_compacted")
        },
        # Gold
        "stop_observations": view("observations"),
        "canonical_stop_events": view("canonical"),
        "canonical_from_observations": view("canonical"),
        "route_reliability": view("route_reliability"),
        "stop_reliability": view("stop_reliability"),
        "route_stop_reliability": view("route_stop_reliability"),
        "route_direction_reliability": view("route_direction_reliability"),
        "route_hourly_reliability": view("route_hourly_reliability"),
        "route_weekday_reliability": view("route_weekday_reliability"),
        "hourly_patterns": view("hourly_patterns"),
        "daily_metrics": view("daily_metrics"),
        "delay_propagation_events": view("propagation"),
        "route_delay_propagation": view("route_propagation"),
        # Quality
        "row_counts": query(_counts(_CHECKED), *_CHECKED_READS),
        "null_checks": query(_nulls(_CHECKED, CRITICAL_COLUMNS), *_CHECKED_READS),
        "uniqueness_checks": query(_duplicates(_CHECKED, UNIQUE_KEYS), *_CHECKED_READS),
        "orphan_checks": query(_orphans(_CHECKED), *_CHECKED_READS),
        "silver_report": query(_report(_CHECKED), *_CHECKED_READS),
        "silver_report_of_jobs": query(
            _report({**{n: n for n in _CHECKED}, "realtime_stop_events": "deduped"}),
            *("routes", "trips", "stop_events", "stops", "deduped"),
        ),
        "duplicate_examples": query(
            "select feed_timestamp, trip_id, stop_sequence, count(*) as row_count from realtime"
            " group by all having count(*) > 1 order by row_count desc, feed_timestamp, trip_id,"
            " stop_sequence nulls first limit 20",
            "realtime",
        ),
        "orphan_examples": query(
            "select distinct stop_id, trip_id, stop_sequence, feed_timestamp from realtime"
            " where try_cast(stop_id as bigint) not in (select stop_id from raw_stops"
            " where stop_lat is not null) order by stop_id, trip_id, stop_sequence nulls first,"
            " feed_timestamp limit 20",
            "realtime",
            "raw_stops",
        ),
        "sequence_profile": query(_PROFILE, "all_stop_events"),
        "sequence_issues": query(_ISSUES, "all_stop_events"),
        "delay_profile": query(
            "select "
            + ", ".join(
                f"{f}({s}_delay_seconds) as {s}_{f}"
                for s in ("arrival", "departure")
                for f in ("count", "min", "max", "avg")
            )
            + " from realtime",
            "realtime",
        ),
        "feed_profile": query(
            "select count(distinct feed_timestamp) as unique_feed_timestamps,"
            " min(feed_timestamp) as min_feed_timestamp,"
            " max(feed_timestamp) as max_feed_timestamp from realtime",
            "realtime",
        ),
        "handshake": query(
            "select count(*) as realtime_trip_ids, count(k) as matched,"
            f" count(*) - count(k) as unmatched, {half_up('100 * count(k)', 'count(*)')}"
            " as match_rate from (select distinct trip_id from realtime) r left join"
            " (select distinct cast(trip_id as varchar) as k from trips) t on r.trip_id = t.k",
            "realtime",
            "trips",
        ),
        "time_checks": query(_times("all_stop_events"), "all_stop_events"),
        "gold_rebuilt_days": query(_gold_totals(), *gold_reads),
        "not_null_gold": query(_nulls(_GOLD, GOLD_FILLED), *gold_reads),
        "unique_grain_gold": query(_duplicates(_GOLD, GOLD_GRAIN), *gold_reads),
        # Reports
        "tail_risk_routes": query(
            f"select {_ROUTE}, observations, avg_arrival_delay_seconds,"
            " p95_arrival_delay_seconds from route_reliability where observations >= 20"
            " and avg_arrival_delay_seconds <= 180 and p95_arrival_delay_seconds >= 600",
            "route_reliability",
        ),
        "tail_risk_share": query(
            "select q as qualified_routes, r as tail_risk_routes,"
            f" {half_up('100 * r', 'q')} as tail_risk_share_pct from"
            " (select count(*) as q, count(case when avg_arrival_delay_seconds <= 180"
            " and p95_arrival_delay_seconds >= 600 then 1 end) as r from route_reliability"
            " where observations >= 20)",
            "route_reliability",
        ),
        "direction_gap": query(
            f"select *, {_hundredths('abs(on_time_pct_0 - on_time_pct_1)')} as on_time_gap from ("
            f"select {_ROUTE}, max(case when direction_id = 0 then stop_events end)"
            " as stop_events_0, max(case when direction_id = 1 then stop_events end)"
            " as stop_events_1, max(case when direction_id = 0 then on_time_pct end)"
            " as on_time_pct_0, max(case when direction_id = 1 then on_time_pct end)"
            " as on_time_pct_1 from route_direction_reliability where stop_events >= 10"
            f" group by {_ROUTE}) where stop_events_0 is not null and stop_events_1 is not null",
            "route_direction_reliability",
        ),
        "worst_route_stops": query(
            "select * from route_stop_reliability where stop_events >= 2 order by on_time_pct,"
            " avg_arrival_delay_seconds desc, route_id, stop_id limit 20",
            "route_stop_reliability",
        ),
        "delay_tendency": query(
            "select *, case when pct_delay_accumulated > pct_delay_recovered then 'accumulates'"
            " when pct_delay_accumulated < pct_delay_recovered then 'recovers'"
            " when pct_delay_accumulated = pct_delay_recovered then 'stable' end as tendency"
            " from route_propagation where propagation_events >= 10",
            "route_propagation",
        ),
        "accumulating_routes": query(
            "select *, 'accumulates' as tendency from route_propagation"
            " where propagation_events >= 10 and pct_delay_accumulated > pct_delay_recovered"
            " order by pct_delay_accumulated desc, route_id limit 20",
            "route_propagation",
        ),
        "time_of_day": query(
            "select scheduled_hour, cast(sum(stop_events) as bigint) as stop_events,"
            f" {_weighted('avg_arrival_delay_seconds', 'stop_events')}"
            " as avg_arrival_delay_seconds,"
            f" {_weighted('on_time_pct', 'stop_events')} as on_time_pct,"
            f" {_weighted('over_5_min_late_pct', 'stop_events')} as over_5_min_late_pct"
            " from route_hourly_reliability group by scheduled_hour having sum(stop_events) >= 500",
            "route_hourly_reliability",
        ),
        "headline_kpis": query(
            "select cast(sum(observations) as bigint) as total_observations, count(*) as routes, "
            + ", ".join(
                f"{_weighted(name, 'observations')} as {name}"
                for name in (
                    "avg_arrival_delay_seconds",
                    "on_time_pct",
                    "over_5_min_late_pct",
                    "over_10_min_late_pct",
                )
            )
            + " from route_reliability",
            "route_reliability",
        ),
        "avg_vs_p95": query(
            f"select {_ROUTE}, observations, avg_arrival_delay_seconds,"
            " p95_arrival_delay_seconds, "
            + _hundredths("p95_arrival_delay_seconds - avg_arrival_delay_seconds")
            + " as tail_seconds from route_reliability where observations >= 20",
            "route_reliability",
        ),
        "weekday_coverage": query(
            "select * from (select day_of_week_number, day_of_week,"
            " cast(sum(stop_events) as bigint) as total_stop_events,"
            f" {_weighted('on_time_pct', 'stop_events')} as on_time_pct,"
            f" {_weighted('avg_arrival_delay_seconds', 'stop_events')}"
            " as avg_arrival_delay_seconds from route_weekday_reliability"
            " group by day_of_week_number, day_of_week) join"
            " (select cast(dayofweek(service_date) + 1 as int) as day_of_week_number,"
            " count(distinct service_date) as days_observed from canonical"
            " where arrival_delay_seconds is not null group by 1) using (day_of_week_number)",
            "route_weekday_reliability",
            "canonical",
        ),
        "kpi_cross_check": query(
            _union(
                [
                    f"select '{name}' as metric, r.{name} as from_routes, e.{name} as from_events,"
                    f" abs(round(r.{name} * 100) - round(e.{name} * 100)) <= 1 as matches"
                    " from r, e"
                    for name in (
                        "total_observations",
                        "avg_arrival_delay_seconds",
                        "on_time_pct",
                        "over_5_min_late_pct",
                        "over_10_min_late_pct",
                    )
                ]
            ),
            "r",
            "e",
        ),
        "filtered_routes": query(
            "select * from route_reliability where transport_mode in ('bus', 'subway')",
            "route_reliability",
        ),
        # Live
        "latest_vehicles": query("select * from latest", "latest"),
        "vehicles_by_trip": query(
            "select * exclude (rn) from (select *, row_number() over (partition by"
            " feed_timestamp, trip_id order by entity_index desc) as rn from vehicles"
            " where vehicle_id is not null and trip_id is not null) where rn = 1",
            "vehicles",
        ),
        "trip_context": view("context"),
        "trip_stop_places": view("trip_stops"),
        "vehicle_context": view("board"),
        "next_stops": view("live_board"),
        "next_stops_from_stored": view("live_board"),
        "live_board_from_feeds": query(
            "select * replace (cast(latitude as float) as latitude,"
            " cast(longitude as float) as longitude) from feed_board",
            "feed_board",
        ),
        "vehicle_cards": query(
            "select vehicle_id, route_short_name || ' → ' || destination as title,"
            " upper(transport_mode[1]) || lower(transport_mode[2:]) as subtitle,"
            " 'Next: ' || next_stop || case when next_time = '' then '' else ' · ' || next_time end"
            " || case when delay_display = '' then '' else ' · ' || delay_display end as detail"
            f" from live_board where transport_mode in {_VISIBLE}",
            "live_board",
        ),
        "board_kpis": query(
            f"select count(case when transport_mode in {_VISIBLE} then 1 end) as live_vehicles,"
            f" count(distinct case when transport_mode in {_VISIBLE} then route_id end)"
            " as routes_active,"
            f" {half_up_1('''100 * count(case when realtime_status = 'trip_update' then 1 end)''', 'count(*)')}"
            " as realtime_pct from live_board",
            "live_board",
        ),
        "route_catalog": view("catalog"),
        "observed_catalog": query(
            "select * from catalog where route_id in (select route_id from board)"
            f" and transport_mode in {_VISIBLE}",
            "catalog",
            "board",
        ),
        "route_search": query(
            "select * from catalog where contains(lower(route_label), 'urgent')"
            f" order by {_SORT} limit 8",
            "catalog",
        ),
        "followed_vehicles": query(
            "select f.vehicle_id, b.* exclude (vehicle_id), case when b.vehicle_id is null then"
            f" 'Unknown' else {_age_text('b.vehicle_timestamp')} end as updated, case when"
            " b.vehicle_id is null then 'temporarily missing' else 'live' end as follow_status"
            f" from {_FOLLOWED} f left join live_board b on f.vehicle_id = b.vehicle_id",
            "live_board",
            "vehicles",
        ),
        "followed_trip_stops": query(
            "select f.vehicle_id, s.trip_id, s.stop_sequence, s.stop_id, s.stop_name, s.stop_lat,"
            " s.stop_lon, coalesce(s.stop_id = f.next_stop_id, false) as is_next_stop"
            " from followed f join trip_stops s on cast(f.trip_id as bigint) = s.trip_id"
            " where s.stop_lat is not null and s.stop_lon is not null",
            "followed",
            "trip_stops",
        ),
        "missing_trip_profile": query(
            "select feed_timestamp, count(*) as total_vehicles, count(trip_id) as with_trip,"
            " count(*) - count(trip_id) as without_trip,"
            f" {half_up_1('100 * (count(*) - count(trip_id))', 'count(*)')} as missing_trip_pct"
            " from vehicles group by feed_timestamp",
            "vehicles",
        ),
        "missing_trip_examples": query(
            "select feed_timestamp, entity_index, vehicle_id, latitude, longitude,"
            " vehicle_timestamp, stop_id, current_status from vehicles where trip_id is null"
            " order by feed_timestamp, entity_index limit 20",
            "vehicles",
        ),
        "feed_freshness": query(
            "select p.feed_timestamp, p.previous_timestamp,"
            " p.feed_timestamp - p.previous_timestamp as feed_delta_seconds,"
            " (select count(*) from latest l where l.feed_timestamp = p.previous_timestamp)"
            " as vehicles_before,"
            " (select count(*) from latest l where l.feed_timestamp = p.feed_timestamp)"
            " as vehicles_now,"
            " count(c.vehicle_id) as vehicles_in_both,"
            " count(case when moved or retimed then 1 end) as updated_vehicles,"
            " count(case when moved then 1 end) as position_changes,"
            " count(case when retimed then 1 end) as timestamp_changes,"
            f" {half_up_1('100 * count(case when moved or retimed then 1 end)', 'count(c.vehicle_id)')}"
            " as updated_pct,"
            f" {half_up_1('100 * count(case when moved then 1 end)', 'count(c.vehicle_id)')}"
            " as position_pct"
            " from snapshots p left join changes c on p.feed_timestamp = c.feed_timestamp"
            " group by p.feed_timestamp, p.previous_timestamp",
            "latest",
            "snapshots",
            "changes",
        ),
        "change_examples": query(
            "select feed_timestamp, previous_timestamp, vehicle_id, vehicle_timestamp"
            " from changes where moved or retimed order by feed_timestamp, vehicle_id limit 10",
            "changes",
        ),
        "feed_overlap": query(
            "select count(v) as vehicle_trips, count(u) as update_trips,"
            f" {_IN_BOTH} as trips_in_both,"
            f" {half_up_1(f'100 * {_IN_BOTH}', 'count(v)')}"
            " as match_rate from (select distinct trip_id as v from vehicles"
            " where trip_id is not null) full join"
            " (select distinct cast(trip_id as varchar) as u from updates) on v = u",
            "vehicles",
            "updates",
        ),
        "overlap_examples": query(
            "select v.trip_id, vehicle_id, latitude, longitude, vehicle_timestamp,"
            " stop_update_count, first_stop_updates from (select *, row_number() over (partition"
            " by trip_id order by entity_index desc) as rn from vehicles where vehicle_id is not"
            " null and trip_id is not null"
            " and feed_timestamp = (select max(feed_timestamp) from vehicles)) v"
            " join (select cast(trip_id as varchar) as trip_id, cast(count(*) as int) as"
            " stop_update_count, array_to_string(list_slice(list(stop_sequence || '@' ||"
            " coalesce(cast(arrival_time + case trip_id % 3 when 0 then 600 else 0 end as"
            " varchar), '-') order by update_index), 1, 5), ' ') as first_stop_updates"
            " from updates group by updates.trip_id) u on v.trip_id = u.trip_id"
            " where rn = 1 order by v.trip_id limit 5",
            "vehicles",
            "updates",
        ),
        "route_match": query(
            "select v.vehicle_id, v.trip_id, v.latitude, v.longitude, v.vehicle_timestamp,"
            " t.trip_id is not null as matched, t.route_id, r.route_short_name,"
            " r.route_long_name, r.route_type, t.trip_headsign from vehicles v"
            " left join trips t on cast(v.trip_id as bigint) = t.trip_id"
            " left join routes r on t.route_id = r.route_id where v.trip_id is not null",
            "vehicles",
            "trips",
            "routes",
        ),
        "route_match_examples": query(
            "select v.vehicle_id, v.trip_id, v.latitude, v.longitude, v.vehicle_timestamp,"
            " t.trip_id is not null as matched, t.route_id, r.route_short_name,"
            " r.route_long_name, r.route_type, t.trip_headsign from vehicles v"
            " left join trips t on cast(v.trip_id as bigint) = t.trip_id"
            " left join routes r on t.route_id = r.route_id where v.trip_id is not null"
            " and t.trip_id is null order by v.vehicle_id, v.trip_id, v.vehicle_timestamp limit 10",
            "vehicles",
            "trips",
            "routes",
        ),
        "route_match_summary": query(
            "select count(*) as live_vehicles, count(t.trip_id) as matched,"
            " count(*) - count(t.trip_id) as unmatched,"
            f" {half_up_1('100 * count(t.trip_id)', 'count(*)')} as match_rate from vehicles v"
            " left join trips t on cast(v.trip_id as bigint) = t.trip_id"
            " where v.trip_id is not null",
            "vehicles",
            "trips",
        ),
        # Texts
        "delay_text": query(
            "select trip_id, feed_timestamp, arrival_delay_seconds,"
            f" {_delay_text('arrival_delay_seconds')} as delay_text from realtime",
            "realtime",
        ),
        "clock_text": query(
            "select trip_id, feed_timestamp, arrival_time_actual,"
            " case when arrival_time_actual is null then '' else"
            " strftime(timezone('Europe/Stockholm', to_timestamp(arrival_time_actual)), '%H:%M')"
            " end as clock_text, case when arrival_time_actual is null then null else"
            " strftime(timezone('Europe/Stockholm', to_timestamp(arrival_time_actual)),"
            " '%Y-%m-%d %H:%M:%S') end as moment_text from realtime",
            "realtime",
        ),
        "age_text": query(
            "select entity_index, vehicle_timestamp,"
            f" {_age_text('vehicle_timestamp')} as age_text from vehicles",
            "vehicles",
        ),
        "route_sort_key": query(
            "select route_id, route_short_name,"
            " cast(case when regexp_matches(route_short_name, '^[0-9]') then 0 else 1 end as int)"
            " as sort_rank, coalesce(try_cast(nullif(regexp_extract(route_short_name, '^[0-9]+'),"
            " '') as bigint), 0) as sort_number,"
            " lower(regexp_replace(route_short_name, '^[0-9]+', '')) as sort_text"
            " from raw_routes",
            "raw_routes",
        ),
        "clean_text": query(
            "select trip_id, coalesce(regexp_replace(trip_headsign, '^\\s+|\\s+$', '', 'g'), '')"
            " as clean_text from raw_trips",
            "raw_trips",
        ),
        # Files
        # A blank field of a file is NULL.
        "timetable_scan": query(
            "select * replace (nullif(arrival_time, '') as arrival_time) from raw_stop_times",
            "raw_stop_times",
        ),
        "decode_flatten": query(
            f"select {_HISTORY_COLUMNS} from realtime where true", "realtime"
        ),
        "decode_vehicles": query(
            "select feed_timestamp, vehicle_id, trip_id, route_id,"
            " cast(latitude as float) as latitude, cast(longitude as float) as longitude,"
            " vehicle_timestamp, stop_id, current_status from vehicles"
            " where trip_id is not null and latitude is not null",
            "vehicles",
        ),
        "archive_rows": query(f"select {_HISTORY_COLUMNS} from snapshot_rows", "snapshot_rows"),
        "archive_files": query(
            "select cast(date '2024-01-01' + cast(h // 24 as int) as date) as ingestion_date,"
            " cast(h % 24 as int) as hour, count(*) as files, count(*) as same_bytes"
            " from (select distinct feed_timestamp, (feed_timestamp % 172800) // 3600 as h"
            " from snapshot_rows) group by 1, 2",
            "snapshot_rows",
        ),
        "context_of_files": view("context"),
        "static_job": query(
            "select * replace (nullif(arrival_time_raw, '') as arrival_time_raw) from stop_events",
            "stop_events",
        ),
        "source_registry": query(
            _union(
                [
                    f"select '{name}' as table_name, count(*) as rows from {source}"
                    for name, source in {
                        **{n: n for n in _CHECKED},
                        "realtime_stop_events": "deduped",
                    }.items()
                ]
            ),
            *("routes", "trips", "stop_events", "stops", "deduped"),
        ),
        "publish_connector": view("route_reliability"),
        "timetable_text_ids": query(
            f"select {t.text_id('T', 'e.trip_id')} as trip_id, {t.text_id('R', 't.route_id')}"
            f" as route_id, {t.text_id('S', 'e.stop_id')} as stop_id, stop_sequence,"
            # An empty field of a file is a NULL.
            " nullif(arrival_time_raw, '') as arrival_time_raw, departure_time_raw,"
            " arrival_seconds, departure_seconds, trip_headsign, route_short_name, stop_name"
            " from stop_events e join trips t on e.trip_id = t.trip_id join routes r"
            " on t.route_id = r.route_id left join stops s on e.stop_id = s.stop_id",
            "stop_events",
            "trips",
            "routes",
            "stops",
        ),
        "gold_text_ids": query(
            f"select * replace ({t.text_id('R', 'route_id')} as route_id,"
            f" {t.text_id('S', 'stop_id')} as stop_id) from ("
            + metrics(
                "snapshot_canonical", f"{_ROUTE}, stop_id, stop_name", "stop_events"
            )
            + ")",
            "snapshot_canonical",
        ),
        "snapshot_scan": query(
            "select cast(date '1970-01-01' + cast(feed_timestamp // 86400 as int) as date)"
            " as ingestion_date, cast(feed_timestamp % 86400 // 3600 as int) as hour,"
            " feed_timestamp, count(distinct (trip_id, start_date)) as entities,"
            " count(*) as stop_updates from snapshot_rows group by feed_timestamp",
            "snapshot_rows",
        ),
        "latest_snapshot": query(
            f"select {_HISTORY_COLUMNS} from snapshot_rows"
            " where feed_timestamp = (select max(feed_timestamp) from snapshot_rows)",
            "snapshot_rows",
        ),
        **{
            name: query(
                f"select {_HISTORY_COLUMNS}, {_FEED_DATE} from deduped_snapshots",
                "deduped_snapshots",
            )
            for name in ("stream_snapshots", "realtime_job")
        },
        "stop_update_state": query(
            "select feed_timestamp, cast(trip_id as varchar) as trip_id,"
            " cast(row_number() over (partition by trip_id order by update_index) - 1 as int)"
            " as update_index, stop_sequence, cast(null as varchar) as stop_id,"
            " arrival_time, arrival_delay, departure_time, departure_delay from ("
            " select * exclude (late) from feed_updates union all by name"
            f" select *, {t.UPDATE_TIMES[0]} as feed_timestamp from updates where trip_id % 3 = 2)",
            "feed_updates",
            "updates",
        ),
        "feed_profile_estimate": query(
            "select count(*) as rows, min(feed_timestamp) as min_feed_timestamp,"
            " max(feed_timestamp) as max_feed_timestamp, true as feed_timestamps_within_2_pct,"
            " true as trip_ids_within_2_pct, true as stop_ids_within_2_pct from realtime",
            "realtime",
        ),
        "stream_hourly": query(
            "select feed_timestamp // 3600 * 3600 as hour_start, count(*) as observations,"
            f" {half_up('sum(arrival_delay_seconds)', 'count(*)')} as avg_arrival_delay_seconds,"
            f" {pct('abs(arrival_delay_seconds) <= 60')} as on_time_pct,"
            f" {pct('arrival_delay_seconds > 300')} as over_5_min_late_pct"
            " from realtime where arrival_delay_seconds is not null"
            " and (start_date >= date '2024-02-10' or stop_sequence is distinct from 2)"
            # The last hours stay open.
            " and feed_timestamp // 3600 * 3600 + 3600 <= (select max(feed_timestamp) - 7200"
            " from realtime where arrival_delay_seconds is not null) group by 1",
            "realtime",
        ),
        "handshake_of_feed": query(
            "select count(*) as realtime_trip_ids, count(k) as matched,"
            f" count(*) - count(k) as unmatched, {half_up('100 * count(k)', 'count(*)')}"
            " as match_rate from (select distinct trip_id from realtime) r left join"
            " (select distinct cast(trip_id as varchar) as k from trips) t on r.trip_id = t.k",
            "realtime",
            "trips",
        ),
        "archive_layout": query(
            "select cast(date '2024-01-01' + cast(h // 24 as int) as date) as ingestion_date,"
            " cast(h % 24 as int) as hour, count(*) as payloads"
            " from (select (feed_timestamp % 172800) // 3600 as h from realtime) group by all",
            "realtime",
        ),
        "publish_reconcile": query(
            _union(
                [
                    f"select '{name}' as table_name, count(*) as gold_rows,"
                    f" count(*) as served_rows, true as matches from {_GOLD[name]}"
                    for name in (
                        "route_reliability",
                        "stop_reliability",
                        "route_stop_reliability",
                        "route_direction_reliability",
                        "route_hourly_reliability",
                        "route_weekday_reliability",
                        "route_delay_propagation",
                    )
                ]
            ),
            *gold_reads,
        ),
        # Streams: the final table equals the batch result
        "stream_observations": query(
            f"select {_HISTORY_COLUMNS}, {_FEED_DATE} from deduped", "deduped"
        ),
        "stream_latest_vehicles": query(
            "select vehicle_id, trip_id, latitude, longitude, vehicle_timestamp from (select *,"
            " row_number() over (partition by vehicle_id order by feed_timestamp desc,"
            " entity_index desc) as rn from vehicles) where rn = 1",
            "vehicles",
        ),
        "stream_live_board": view("live_board"),
        "stream_board_interval": view("live_board"),
        "stream_known_routes": query(
            "select distinct t.route_id from vehicles v join raw_trips t"
            " on cast(v.trip_id as bigint) = t.trip_id",
            "vehicles",
            "raw_trips",
        ),
    }
