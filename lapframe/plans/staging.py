"""Staging models: projection, casts and null tokens over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.functions import add_whole_seconds


def stg_car_data(src: DataFrame) -> DataFrame:
    return src.select(
        "session_key",
        F.col("driver_number").cast("string").alias("driver_number"),
        F.col("date").cast("timestamp").alias("timestamp"),
        "rpm", "speed", "throttle", "brake", "drs",
    )


def stg_drivers(src: DataFrame) -> DataFrame:
    return src.select(
        "driver_number", "broadcast_name", "first_name", "last_name", "full_name",
        "name_acronym", "team_name", "team_colour", "country_code", "session_key",
    ).distinct()


def stg_intervals(src: DataFrame) -> DataFrame:
    none = F.lit("None")
    return src.select(
        "session_key",
        "driver_number",
        "date",
        F.nullif(F.col("gap_to_leader"), none).alias("gap_to_leader"),
        F.nullif(F.col("interval"), none).alias("gap_to_next"),
    )


def stg_laps(src: DataFrame) -> DataFrame:
    """Start cut to the second; end is the start plus the duration in rounded seconds."""
    start = F.date_trunc("second", "date_start")
    return src.select(
        "session_key",
        "driver_number",
        start.alias("date_start"),
        add_whole_seconds(start, "lap_duration").alias("date_end"),
        "lap_duration", "lap_number", "is_pit_out_lap",
        "duration_sector_1", "duration_sector_2", "duration_sector_3",
    )


def stg_meetings(src: DataFrame) -> DataFrame:
    return src.select(
        "meeting_key", "meeting_name", "meeting_official_name", "country_name",
        "circuit_short_name", "year", "date_start",
    )


def stg_pit(src: DataFrame) -> DataFrame:
    return src


def stg_position(src: DataFrame) -> DataFrame:
    return src.select("session_key", "driver_number", "position", "date")


def stg_sessions(src: DataFrame) -> DataFrame:
    return src.select(
        "session_key", "meeting_key", "country_name", "session_name", "session_type", "year",
        "circuit_short_name", "date_start", "date_end",
    )


def stg_stints(src: DataFrame) -> DataFrame:
    return src


def stg_weather(src: DataFrame) -> DataFrame:
    return src
