"""Fixed values of the domain, kept in one place."""

# Agencies whose routes are in scope by default.
SCOPE_AGENCIES = (505000000000000001, 500000000000000114)

# GTFS route_type to mode in the historical tables.
HISTORY_MODES = {
    106: "commuter_rail",
    401: "subway",
    700: "bus",
    900: "local_rail",
    1000: "ferry",
}
HISTORY_MODE_DEFAULT = "unknown"

# GTFS route_type (as text) to mode on the live board.
LIVE_MODES = {
    "0": "tram",
    "1": "subway",
    "2": "rail",
    "3": "bus",
    "4": "ferry",
    "100": "rail",
    "101": "rail",
    "102": "rail",
    "103": "rail",
    "105": "rail",
    "106": "rail",
    "109": "rail",
    "400": "subway",
    "401": "subway",
    "402": "subway",
    "700": "bus",
    "701": "bus",
    "702": "bus",
    "704": "bus",
    "705": "bus",
    "707": "bus",
    "710": "bus",
    "712": "bus",
    "715": "bus",
    "900": "tram",
    "901": "tram",
    "902": "tram",
    "1000": "ferry",
    "1200": "ferry",
}
LIVE_MODE_DEFAULT = "other"

# Modes the live board shows, and modes labelled by long name.
VISIBLE_MODES = ("bus", "ferry", "subway", "tram")
LONG_NAME_MODES = ("subway", "rail", "tram", "ferry")

# Delay thresholds in seconds.
ON_TIME_SECONDS = 60
LATE_SECONDS = 300
VERY_LATE_SECONDS = 600
EXTREME_CHANGE_SECONDS = 600

# Minimum sample sizes of the reports.
MIN_ROUTE_OBSERVATIONS = 100
MIN_DIRECTION_EVENTS = 50
MIN_ROUTE_STOP_EVENTS = 20
MIN_PROPAGATION_EVENTS = 50
MIN_HOUR_EVENTS = 500

# A tail-risk route has a calm average and a heavy P95.
TAIL_RISK_MAX_AVG_SECONDS = 180
TAIL_RISK_MIN_P95_SECONDS = 600

# Texts of the live board.
LOCAL_ZONE = "Europe/Stockholm"
UNKNOWN_DESTINATION = "Unknown destination"
UNKNOWN_STOP = "Unknown stop"
UNKNOWN_LINE = "Unknown"
POSITION_ONLY_TEXT = "Live position available"
STATUS_MATCHED = "trip_update"
STATUS_POSITION_ONLY = "position_only"
MISSING_VEHICLE_TEXT = "temporarily missing"
END_JOINER = " ↔ "
ARROW = " → "
DOT = " · "
DASH = " — "

# Tables copied to the serving layer.
SERVING_TABLES = (
    "route_reliability",
    "stop_reliability",
    "route_stop_reliability",
    "route_direction_reliability",
    "route_hourly_reliability",
    "route_weekday_reliability",
    "route_delay_propagation",
)

# Fixed value: vehicle status the feed specification assumes when none is sent.
DEFAULT_STATUS = 2
