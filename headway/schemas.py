"""Explicit schemas: nothing in this package infers a schema from data."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# Timetable files. Times stay text because service hours run past 24:00, and
# ids stay 64-bit because they do not fit into a double.
TIMETABLE = {
    "routes": _struct(
        agency_id=LongType(),
        route_id=LongType(),
        route_short_name=StringType(),
        route_long_name=StringType(),
        route_type=IntegerType(),
    ),
    "trips": _struct(
        route_id=LongType(),
        service_id=StringType(),
        trip_id=LongType(),
        trip_headsign=StringType(),
        direction_id=IntegerType(),
        shape_id=StringType(),
    ),
    "stop_times": _struct(
        trip_id=LongType(),
        stop_id=LongType(),
        stop_sequence=IntegerType(),
        arrival_time=StringType(),
        departure_time=StringType(),
    ),
    "stops": _struct(
        stop_id=LongType(),
        stop_name=StringType(),
        stop_lat=DoubleType(),
        stop_lon=DoubleType(),
        location_type=IntegerType(),
        parent_station=StringType(),
        platform_code=StringType(),
    ),
}

# Columns that the public format leaves optional. A file without
# one of them reads as NULL there.
OPTIONAL_COLUMNS = {
    "routes": ("agency_id", "route_short_name", "route_long_name"),
    "trips": ("trip_headsign", "direction_id", "shape_id"),
    "stop_times": (),
    "stops": ("location_type", "parent_station", "platform_code"),
}

# One stop update of the history.
OBSERVATION = _struct(
    trip_id=StringType(),
    stop_id=StringType(),
    stop_sequence=LongType(),
    arrival_time_actual=TimestampType(),
    departure_time_actual=TimestampType(),
    arrival_delay_seconds=LongType(),
    departure_delay_seconds=LongType(),
    feed_timestamp=TimestampType(),
    start_date=DateType(),
)

# The decoded feed message, one row per snapshot file; `error` says why there is none.
_STOP_TIME = _struct(delay=IntegerType(), time=LongType())
_TRIP = _struct(trip_id=StringType(), start_date=StringType(), route_id=StringType())
_VEHICLE_REF = _struct(id=StringType())
TRIP_UPDATE = _struct(
    trip=_TRIP,
    vehicle=_VEHICLE_REF,
    timestamp=LongType(),
    stop_time_update=ArrayType(
        _struct(
            stop_sequence=IntegerType(),
            stop_id=StringType(),
            arrival=_STOP_TIME,
            departure=_STOP_TIME,
        )
    ),
)
VEHICLE_POSITION = _struct(
    vehicle=_VEHICLE_REF,
    trip=_TRIP,
    position=_struct(latitude=FloatType(), longitude=FloatType()),
    timestamp=LongType(),
    stop_id=StringType(),
    current_status=IntegerType(),
)
FEED = _struct(
    path=StringType(),
    error=StringType(),
    header=_struct(timestamp=LongType()),
    entity=ArrayType(
        _struct(id=StringType(), trip_update=TRIP_UPDATE, vehicle=VEHICLE_POSITION)
    ),
)

# Landed snapshots.
SNAPSHOT = _struct(
    path=StringType(),
    modificationTime=TimestampType(),
    length=LongType(),
    content=BinaryType(),
)
SNAPSHOT_PARTITIONS = _struct(ingestion_date=DateType(), hour=IntegerType())
