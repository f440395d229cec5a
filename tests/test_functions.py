import datetime

import pytest
from pyspark.sql import functions as F

from headway import functions as fn


def values(spark, cases, kind, expression):
    rows = [(i, case) for i, case in enumerate(cases)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_service_seconds(spark):
    cases = ["25:30:00", "00:00:00", "", "8:3", "08:03:05", "a:b:c", None, "9999999:00:00"]
    expected = [91800, 0, None, None, 28985, None, None, None]
    assert values(spark, cases, "string", fn.service_seconds) == expected


def test_hours_keep_or_wrap(spark):
    assert values(spark, [90000, 3599, None], "int", fn.service_hour) == [25, 0, None]
    assert values(spark, [90000, 86400, 3600, None], "int", fn.clock_hour) == [1, 0, 1, None]


def test_modes(spark):
    cases = [106, 401, 700, 900, 1000, 999, None]
    assert values(spark, cases, "int", fn.history_mode) == [
        "commuter_rail",
        "subway",
        "bus",
        "local_rail",
        "ferry",
        "unknown",
        "unknown",
    ]
    assert values(spark, [900, 106, 715, 42, None], "int", fn.live_mode) == [
        "tram",
        "rail",
        "bus",
        "other",
        "other",
    ]


def test_weekday(spark):
    days = [datetime.date(2024, 1, 7), datetime.date(2024, 1, 8)]
    assert values(spark, days, "date", fn.weekday_number) == [1, 2]
    assert values(spark, days, "date", fn.weekday_name) == ["Sunday", "Monday"]


def test_compact_date(spark):
    assert values(spark, ["20240131", "2024013", "", None], "string", fn.compact_date) == [
        datetime.date(2024, 1, 31),
        None,
        None,
        None,
    ]


def test_delay_flags(spark):
    delays = [-61, -60, 60, 61, 300, 301, 600, 601, None]
    on_time = values(spark, delays, "long", fn.is_on_time)
    assert on_time == [False, True, True, False, False, False, False, False, None]
    late = values(spark, delays, "long", fn.is_late)
    assert late == [False, False, False, False, False, True, True, True, None]
    very_late = values(spark, delays, "long", fn.is_very_late)
    assert very_late == [False] * 7 + [True, None]


def test_extreme_change(spark):
    cases = [600, 601, -601, -600, None]
    assert values(spark, cases, "long", fn.delay_change_is_extreme) == [
        False,
        True,
        True,
        False,
        None,
    ]


def test_delay_text(spark):
    cases = [30, 90, -90, 150, None, 0, -30, 61]
    assert values(spark, cases, "long", fn.delay_text) == [
        "On time",
        "2 min late",
        "2 min early",
        "2 min late",
        "",
        "On time",
        "On time",
        "1 min late",
    ]


def test_age_text(spark):
    now = 1_000_000
    ages = [0, 59, 60, 119, -5]
    got = values(
        spark, [now - a for a in ages] + [None, 0], "long", lambda x: fn.age_text(x, F.lit(now))
    )
    assert got == [
        "0 sec ago",
        "59 sec ago",
        "1 min ago",
        "1 min ago",
        "0 sec ago",
        "Unknown",
        "Unknown",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_clock_text_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        cases = [1704067200, 1720000000, 1711846800, None, 0]
        assert values(spark, cases, "long", fn.clock_text) == ["01:00", "11:46", "03:00", "", ""]
        assert values(spark, cases, "long", fn.moment_text)[:2] == [
            "2024-01-01 01:00:00",
            "2024-07-03 11:46:40",
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clean_text(spark):
    assert values(spark, [" a ", "nan", " NaN ", None, "\t"], "string", fn.clean_text) == [
        "a",
        "",
        "",
        "",
        "",
    ]


def test_route_sort_key(spark):
    names = ["B1", "10X", "7", "10", "b0", "10a"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    ordered = [r.n for r in df.orderBy(fn.route_sort_key(F.col("n"))).collect()]
    assert ordered == ["7", "10", "10a", "10X", "b0", "B1"]


def test_destination(spark):
    df = spark.createDataFrame(
        [(0, "A ", "X"), (1, " ", "X"), (2, None, None)], "i int, h string, s string"
    )
    got = df.select("i", fn.destination_text(F.col("h"), F.col("s")).alias("d")).orderBy("i")
    assert [r.d for r in got.collect()] == ["A", "X", "Unknown destination"]
