"""Table schemas, upsert keys and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _LONG, _DBL, _STR = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_TS, _DATE, _BOOL, _FLT = T.TimestampType(), T.DateType(), T.BooleanType(), T.FloatType()
_INTS = T.ArrayType(T.IntegerType())


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


AUDIT = _struct(processed_date=_DATE, created_at=_TS, updated_at=_TS)

# Names and types of the raw tables.
RAW: dict[str, T.StructType] = {
    "meetings": _struct(
        meeting_key=_INT, circuit_key=_INT, circuit_short_name=_STR, country_name=_STR,
        meeting_name=_STR, meeting_official_name=_STR, date_start=_TS, year=_INT,
    ),
    "sessions": _struct(
        session_key=_INT, meeting_key=_INT, country_name=_STR, circuit_short_name=_STR,
        session_name=_STR, session_type=_STR, year=_INT, date_start=_TS, date_end=_TS,
    ),
    "drivers": _struct(
        session_key=_INT, driver_number=_INT, broadcast_name=_STR, first_name=_STR,
        last_name=_STR, full_name=_STR, name_acronym=_STR, team_name=_STR, team_colour=_STR,
        country_code=_STR,
    ),
    "laps": _struct(
        date_start=_TS, driver_number=_INT, meeting_key=_INT, session_key=_INT, lap_number=_INT,
        duration_sector_1=_DBL, duration_sector_2=_DBL, duration_sector_3=_DBL,
        lap_duration=_DBL, i1_speed=_INT, i2_speed=_INT, st_speed=_INT, is_pit_out_lap=_BOOL,
        segments_sector_1=_INTS, segments_sector_2=_INTS, segments_sector_3=_INTS,
    ),
    "car_data": _struct(
        meeting_key=_INT, session_key=_INT, driver_number=_INT, date=_TS, rpm=_INT, speed=_INT,
        throttle=_INT, brake=_INT, drs=_INT, n_gear=_INT,
    ),
    "intervals": _struct(
        date=_TS, driver_number=_INT, session_key=_INT, meeting_key=_INT, gap_to_leader=_STR,
        interval=_STR,
    ),
    "position": _struct(
        meeting_key=_INT, session_key=_INT, driver_number=_INT, position=_INT, date=_TS,
    ),
    "pit": _struct(
        date=_TS, driver_number=_INT, meeting_key=_INT, lap_number=_INT, pit_duration=_DBL,
        session_key=_INT,
    ),
    "stints": _struct(
        session_key=_INT, meeting_key=_INT, driver_number=_INT, stint_number=_INT,
        compound=_STR, lap_start=_INT, lap_end=_INT, tyre_age_at_start=_INT,
    ),
    "race_control": _struct(
        category=_STR, date=_TS, driver_number=_INT, flag=_STR, message=_STR, lap_number=_INT,
        meeting_key=_STR, scope=_STR, sector=_STR, session_key=_INT,
    ),
    "weather": _struct(
        session_key=_INT, date=_TS, air_temperature=_DBL, track_temperature=_DBL,
        humidity=_DBL, rainfall=_DBL, wind_speed=_DBL,
    ),
    "team_radio": _struct(
        meeting_key=_INT, session_key=_INT, driver_number=_INT, date=_TS, recording_url=_STR,
    ),
}

# Upsert keys per table; every other table uses DEFAULT_MERGE_KEYS.
DEFAULT_MERGE_KEYS = ["meeting_key", "session_key"]
MERGE_KEYS: dict[str, list[str]] = {
    "meetings": ["meeting_key"],
    "sessions": ["meeting_key", "session_key"],
    "laps": ["date_start", "driver_number", "session_key", "lap_number"],
    "pit": ["date", "driver_number", "session_key", "lap_number"],
    "race_control": [
        "date", "category", "driver_number", "session_key", "meeting_key", "message",
    ],
    "car_data": ["meeting_key", "session_key", "driver_number", "date"],
    "position": ["meeting_key", "session_key", "driver_number", "date"],
    "intervals": [
        "meeting_key", "session_key", "driver_number", "date", "gap_to_leader", "interval",
    ],
}


def merge_keys(table: str) -> list[str]:
    return MERGE_KEYS.get(table, DEFAULT_MERGE_KEYS)


# Fields a telemetry record must carry, and columns stored as text.
REQUIRED_FIELDS = {"car_data": ["meeting_key", "session_key", "driver_number", "date"]}
TEXT_COLUMNS = {"intervals": ["gap_to_leader", "interval"]}

# Championship points by finishing position, 0 from position 11 on.
POINTS = {1: 25, 2: 18, 3: 15, 4: 12, 5: 10, 6: 8, 7: 6, 8: 4, 9: 2, 10: 1}

# Accepted codes and compounds.
DRS_CODES = [0, 1, 2, 3, 8, 9, 10, 11, 12, 13, 14, 15]
COMPOUNDS = ["SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET"]

# Live record kinds with their payload fields in wire order.
STREAM: dict[str, T.StructType] = {
    "location": _struct(
        id=_STR, x=_FLT, y=_FLT, z=_FLT, driver_number=_INT, date=_STR, session_key=_INT,
        meeting_key=_INT,
    ),
    "position": _struct(
        id=_STR, position=_INT, driver_number=_INT, date=_STR, session_key=_INT,
        meeting_key=_INT,
    ),
    "car": _struct(
        id=_STR, brake=_INT, drs=_INT, n_gear=_INT, rpm=_INT, speed=_INT, throttle=_INT,
        driver_number=_INT, date=_STR, session_key=_INT, meeting_key=_INT,
    ),
    "intervals": _struct(
        id=_STR, driver_number=_INT, gap_to_leader=_FLT, time_interval=_FLT, date=_STR,
        session_key=_INT, meeting_key=_INT,
    ),
}
# Fields that a message must carry.
STREAM_REQUIRED = {"id", "driver_number", "session_key", "meeting_key"}

# Fixed values of the wire format: envelope names and topics per kind.
STREAM_NAMES = {
    "location": "f1_location_data",
    "position": "f1_position_data",
    "car": "f1_car_data",
    "intervals": "f1_intervals_data",
}
STREAM_TOPICS = {
    "location": "topic_0",
    "car": "topic_1",
    "intervals": "topic_2",
    "position": "topic_3",
}
