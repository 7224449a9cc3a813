"""Intermediate models over the staging models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.functions import numeric_gap
from lapframe.operators import (
    interval_matches,
    latest_per_key,
    nearest_event_in_interval,
    range_aggregate,
)

K2 = ["session_key", "driver_number"]
# Bucket widths in seconds for joining events to laps: a usual lap takes the first one.
LAP_WIDTHS = (60, 600, 6000)


def best_laps(laps: DataFrame) -> DataFrame:
    return laps.filter("lap_duration > 0").groupBy(*K2).agg(
        F.min("lap_duration").alias("best_lap_time")
    )


def telemetry_base(car: DataFrame, drivers: DataFrame) -> DataFrame:
    """Telemetry with driver and team; samples without a driver row are kept."""
    who = drivers.select(
        F.col("session_key").alias("__s"), F.col("driver_number").alias("__d"),
        "name_acronym", "team_name", "team_colour",
    )
    on = (F.col("driver_number").cast("int") == F.col("__d")) & (
        F.col("session_key") == F.col("__s")
    )
    return car.join(who, on, "left").select(
        "driver_number", "session_key", "name_acronym", "team_name", "team_colour", "timestamp",
        "rpm", "speed", "throttle", "brake", "drs",
    )


def final_intervals(intervals: DataFrame) -> DataFrame:
    """Greatest numeric gaps over the session; lapped texts count as NULL."""
    return intervals.groupBy(*K2).agg(
        F.max(numeric_gap("gap_to_leader")).alias("gap_to_leader"),
        F.max(numeric_gap("gap_to_next")).alias("gap_to_next"),
    )


def final_positions(position: DataFrame, tie_breakers: Sequence[str] = ("position",)) -> DataFrame:
    return latest_per_key(position, K2, "date", tie_breakers).select(
        *K2, "position", F.col("date").alias("latest_date")
    )


def lap_positions(
    position: DataFrame,
    laps: DataFrame,
    tie_breakers: Sequence[str] = ("date", "position"),
    widths: Sequence[int] = LAP_WIDTHS,
) -> DataFrame:
    spans = laps.select(*K2, "lap_number", "date_start", "date_end")
    return nearest_event_in_interval(
        position, spans, K2, "lap_number", tie_breakers=tie_breakers, widths=widths
    ).select(
        *K2, "position", "date", "lap_number", "date_start", "date_end", "start_time_diff",
        "end_time_diff", "start_position_rank", "end_position_rank",
    )


def pit_stops(pit: DataFrame) -> DataFrame:
    return pit.groupBy(*K2).agg(F.count(F.lit(1)).alias("pit_stop_count"))


def stints_enriched(
    stints: DataFrame, drivers: DataFrame, sessions: DataFrame, session_type: str = "Race"
) -> DataFrame:
    """Stints of the sessions of one type, with team, circuit and length in laps."""
    where = sessions.filter(F.col("session_type") == session_type).select(
        "session_key", "circuit_short_name", "country_name", "session_type"
    )
    team = drivers.select(*K2, "team_name")
    return (
        stints.join(where, "session_key").join(team, K2, "left")
        .select(
            *stints.columns, "team_name", "circuit_short_name", "country_name", "session_type"
        )
        .withColumn("stint_length", F.col("lap_end") - F.col("lap_start") + 1)
    )


STINT = [*K2, "stint_number", "compound", "lap_start", "lap_end"]


def stint_spans(stints: DataFrame, laps: DataFrame, width: int = 16) -> DataFrame:
    """Start of the first and of the last lap of each stint.

    Stints without laps are kept. ``width`` is the number of laps per bucket; a stint over many
    buckets, as from a wrong ``lap_end``, is matched on its driver alone.
    """
    starts = laps.select(*K2, "lap_number", "date_start")
    return (
        interval_matches(
            stints.select(*STINT), starts, K2, "lap_number", "lap_start", "lap_end", [width, None]
        )
        .groupBy(*STINT)
        .agg(F.min("date_start").alias("stint_start_time"), F.max("date_start").alias("stint_end_time"))
        .select(
            *STINT,
            (F.col("lap_end") - F.col("lap_start") + 1).alias("stint_length"),
            "stint_start_time",
            "stint_end_time",
        )
    )


def stint_weather(spans: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather during each stint; a stint without readings counts as ``Hot`` and ``Dry``.

    The join key is the session alone, so matching readings are never listed: they are
    aggregated over time nodes, see :func:`lapframe.operators.range_aggregate`.
    """
    averaged = {
        "avg_air_temp": "air_temperature",
        "avg_track_temp": "track_temperature",
        "avg_humidity": "humidity",
        "avg_wind_speed": "wind_speed",
    }
    measures = {"had_rainfall": ("rainfall", "max")}
    for out, column in averaged.items():
        measures[f"__sum_{out}"] = (column, "sum")
        measures[f"__n_{out}"] = (column, "count")
    group = [*STINT, "stint_length"]
    totals = range_aggregate(
        spans.select(*group, "stint_start_time", "stint_end_time"),
        weather, ["session_key"], "date", "stint_start_time", "stint_end_time", measures,
    )
    mean = {out: F.try_divide(f"__sum_{out}", f"__n_{out}").alias(out) for out in averaged}
    out = totals.select(
        *group, mean["avg_air_temp"], mean["avg_track_temp"], mean["avg_humidity"], "had_rainfall",
        mean["avg_wind_speed"],
    )
    track, rain, humidity = F.col("avg_track_temp"), F.col("had_rainfall"), F.col("avg_humidity")
    return out.withColumns(
        {
            "track_temp_category": F.when(track < 25, "Cold").when(track < 35, "Medium")
            .otherwise("Hot"),
            "weather_condition": F.when(rain > 0, "Wet").when(humidity > 70, "High Humidity")
            .otherwise("Dry"),
        }
    )
