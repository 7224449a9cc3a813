"""All models over one set of raw tables, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from lapframe.plans import intermediate as mid
from lapframe.plans import marts
from lapframe.plans import staging as stg
from lapframe.sources.tables import register_views


class Warehouse:
    """Each attribute is a model built on first use from the models it refers to."""

    MODELS = (
        "stg_car_data", "stg_drivers", "stg_intervals", "stg_laps", "stg_meetings", "stg_pit",
        "stg_position", "stg_sessions", "stg_stints", "stg_weather",
        "best_laps", "telemetry_base", "final_intervals", "final_positions", "lap_positions",
        "pit_stops", "stints_enriched", "stint_spans", "stint_weather",
        "car_telemetry", "first_positions", "lap_metrics", "historical_race_analysis",
        "leaderboard", "session_driver_count", "session_lap_count", "team_standings",
        "driver_stats", "race_summary", "race_summary_dedup", "session_driver_mapping",
        "session_filters", "session_name_mapping", "compound_performance",
    )

    def __init__(self, raw: Mapping[str, DataFrame]):
        self.raw = raw

    def register(self) -> None:
        """Expose every model as a temporary view."""
        register_views({name: getattr(self, name) for name in self.MODELS})

    @cached_property
    def stg_car_data(self) -> DataFrame:
        return stg.stg_car_data(self.raw["car_data"])

    @cached_property
    def stg_drivers(self) -> DataFrame:
        return stg.stg_drivers(self.raw["drivers"])

    @cached_property
    def stg_intervals(self) -> DataFrame:
        return stg.stg_intervals(self.raw["intervals"])

    @cached_property
    def stg_laps(self) -> DataFrame:
        return stg.stg_laps(self.raw["laps"])

    @cached_property
    def stg_meetings(self) -> DataFrame:
        return stg.stg_meetings(self.raw["meetings"])

    @cached_property
    def stg_pit(self) -> DataFrame:
        return stg.stg_pit(self.raw["pit"])

    @cached_property
    def stg_position(self) -> DataFrame:
        return stg.stg_position(self.raw["position"])

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return stg.stg_sessions(self.raw["sessions"])

    @cached_property
    def stg_stints(self) -> DataFrame:
        return stg.stg_stints(self.raw["stints"])

    @cached_property
    def stg_weather(self) -> DataFrame:
        return stg.stg_weather(self.raw["weather"])

    @cached_property
    def best_laps(self) -> DataFrame:
        return mid.best_laps(self.stg_laps)

    @cached_property
    def telemetry_base(self) -> DataFrame:
        return mid.telemetry_base(self.stg_car_data, self.stg_drivers)

    @cached_property
    def final_intervals(self) -> DataFrame:
        return mid.final_intervals(self.stg_intervals)

    @cached_property
    def final_positions(self) -> DataFrame:
        return mid.final_positions(self.stg_position)

    @cached_property
    def lap_positions(self) -> DataFrame:
        return mid.lap_positions(self.stg_position, self.stg_laps)

    @cached_property
    def pit_stops(self) -> DataFrame:
        return mid.pit_stops(self.stg_pit)

    @cached_property
    def stints_enriched(self) -> DataFrame:
        return mid.stints_enriched(self.stg_stints, self.stg_drivers, self.stg_sessions)

    @cached_property
    def stint_spans(self) -> DataFrame:
        return mid.stint_spans(self.stg_stints, self.stg_laps)

    @cached_property
    def stint_weather(self) -> DataFrame:
        return mid.stint_weather(self.stint_spans, self.stg_weather)

    @cached_property
    def car_telemetry(self) -> DataFrame:
        return marts.car_telemetry(self.telemetry_base, self.stg_sessions, self.stg_meetings)

    @cached_property
    def first_positions(self) -> DataFrame:
        return marts.first_positions(self.stg_position)

    @cached_property
    def lap_metrics(self) -> DataFrame:
        return marts.lap_metrics(
            self.stg_laps, self.first_positions, self.stg_intervals, self.stg_position
        )

    @cached_property
    def historical_race_analysis(self) -> DataFrame:
        return marts.historical_race_analysis(self.lap_metrics, sizes=self.stg_laps)

    @cached_property
    def leaderboard(self) -> DataFrame:
        return marts.leaderboard(
            self.final_positions, self.stg_drivers, self.final_intervals, self.best_laps,
            self.pit_stops, self.session_name_mapping,
        )

    @cached_property
    def session_driver_count(self) -> DataFrame:
        return marts.session_driver_count(self.stg_position)

    @cached_property
    def session_lap_count(self) -> DataFrame:
        return marts.session_lap_count(self.stg_laps)

    @cached_property
    def team_standings(self) -> DataFrame:
        results = marts.driver_results(self.final_positions, self.stg_drivers, self.pit_stops, self.session_name_mapping)
        return marts.team_standings(results)

    @cached_property
    def driver_stats(self) -> DataFrame:
        return marts.driver_stats(self.stg_car_data)

    def _summary(self, dedup: bool) -> DataFrame:
        return marts.race_summary(
            self.session_driver_count, self.session_lap_count, self.session_name_mapping,
            self.team_standings, self.driver_stats, dedup_fanout=dedup,
        )

    @cached_property
    def race_summary(self) -> DataFrame:
        return self._summary(False)

    @cached_property
    def race_summary_dedup(self) -> DataFrame:
        return self._summary(True)

    @cached_property
    def session_driver_mapping(self) -> DataFrame:
        return marts.session_driver_mapping(self.stg_drivers, self.stg_sessions)

    @cached_property
    def session_filters(self) -> DataFrame:
        return marts.session_filters(self.stg_sessions, self.stg_drivers, self.stg_meetings)

    @cached_property
    def session_name_mapping(self) -> DataFrame:
        return marts.session_name_mapping(self.stg_sessions)

    @cached_property
    def compound_performance(self) -> DataFrame:
        return marts.compound_performance(self.stints_enriched)
