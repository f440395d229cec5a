"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

from check_oracles import TABLES, check
from headway.registry.oracles import oracle_queries
from tests.conftest import SMALL

CHECKED = [
    "stop_events_scope",
    "observations_dedup",
    "canonical_stop_events",
    "route_weekday_reliability",
    "hourly_patterns",
    "route_delay_propagation",
    "silver_report",
    "direction_gap",
    "vehicle_cards",
    "route_catalog",
    "feed_freshness",
    "clock_text",
    "decode_flatten",
    "stream_latest_vehicles",
    "history_after_lost_load",
    "gold_rebuilt_days",
    "live_board_from_feeds",
    "stream_hourly",
]


@pytest.fixture(scope="module")
def connection():
    session = duckdb.connect()
    for table in TABLES:
        session.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return session


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, connection, name):
    verdict, rows, _, detail = check(spark, connection, name, SMALL, oracle_queries()[name])
    assert verdict == "ok" and rows > 0, detail
