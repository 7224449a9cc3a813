"""Mart models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapframe.functions import bracket_label, points_for, session_label
from lapframe.operators import (
    dense_levels,
    fill_forward,
    first_per_key,
    interval_matches,
    join_levels,
)
from lapframe.plans.intermediate import K2, LAP_WIDTHS

LAP = [*K2, "lap_number"]


def car_telemetry(base: DataFrame, sessions: DataFrame, meetings: DataFrame) -> DataFrame:
    meeting = sessions.select("session_key", F.col("meeting_key").alias("__m"))
    known = meetings.select("meeting_key")
    return (
        base.join(meeting, "session_key", "left")
        .join(known, F.col("__m") == known["meeting_key"], "left")
        .select(
            "timestamp",
            bracket_label("name_acronym", outer="team_name").alias("driver"),
            "driver_number",
            *[F.round(c).alias(c) for c in ("speed", "throttle", "brake", "drs")],
            "rpm",
            "session_key",
            "meeting_key",
        )
    )


def first_positions(position: DataFrame, tie_breakers: Sequence[str] = ("position",)) -> DataFrame:
    return first_per_key(position, K2, "date", tie_breakers).select(
        *K2, F.col("position").alias("first_position"), "date"
    )


def lap_metrics(
    laps: DataFrame,
    first_pos: DataFrame,
    intervals: DataFrame,
    position: DataFrame,
    widths: Sequence[int] = LAP_WIDTHS,
) -> DataFrame:
    """Per lap: first recorded position, extreme gaps, positions nearest to its start and end.

    Gap readings (compared as text) and positions are matched to laps in one interval join and
    reduced to one row per lap by partial aggregates. The nearest position is the least by the order
    of the ranks in ``lap_positions``: distance, then date, then position. Laps that share a number
    share their nearest positions.
    """
    columns = [
        "lap_number", *K2, "date_start", "date_end", "is_pit_out_lap", "duration_sector_1",
        "duration_sector_2", "duration_sector_3",
    ]
    no_text = F.lit(None).cast("string")
    points = position.select(
        *K2, F.col("date").alias("at"), F.struct("position").alias("here"),
        no_text.alias("gap_to_leader"), no_text.alias("gap_to_next"),
    ).unionByName(
        intervals.select(
            *K2, F.date_trunc("second", "date").alias("at"),
            F.lit(None).cast("struct<position:int>").alias("here"), "gap_to_leader", "gap_to_next",
        )
    )

    def nearest(bound: str) -> Column:
        distance = F.abs(F.unix_seconds("at") - F.unix_seconds(bound))
        place = F.col("here.position")
        return F.min(
            F.when(
                F.col("here").isNotNull(),
                F.struct(distance.alias("d"), F.col("at"), place.isNull().alias("n"),
                         place.alias("position")),
            )
        )

    per_lap = (
        interval_matches(laps.select(*columns), points, K2, "at", "date_start", "date_end", widths)
        .groupBy(*columns)
        .agg(
            F.min("gap_to_leader").alias("min_gap_to_leader"),
            F.max("gap_to_leader").alias("max_gap_to_leader"),
            F.min("gap_to_next").alias("min_gap_to_next"),
            F.max("gap_to_next").alias("max_gap_to_next"),
            nearest("date_start").alias("__start"),
            nearest("date_end").alias("__end"),
        )
    )
    same_number = Window.partitionBy(*LAP)

    def shared(name: str) -> Column:
        known = F.col("lap_number").isNotNull()
        return F.when(known, F.min(name).over(same_number)["position"])

    return (
        per_lap.withColumns({"start_position": shared("__start"), "end_position": shared("__end")})
        .join(first_pos.select(*K2, "first_position"), K2, "left")
        .select(
            *columns, "first_position", "min_gap_to_leader", "max_gap_to_leader",
            "min_gap_to_next", "max_gap_to_next", "start_position", "end_position",
        )
    )


def historical_race_analysis(
    metrics: DataFrame,
    laps_per_part: int = 4096,
    threshold: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Lap metrics with start and end positions filled from earlier laps.

    Lap 1 takes the first recorded position; others their own position, else the last known one,
    else the first recorded one. ``sizes`` may name the laps, to count large keys without building the
    metrics twice.
    """
    # laps without a number come last, cut by the day they start on
    part = [F.floor(F.col("lap_number") / F.lit(laps_per_part)), F.date_trunc("day", "date_start")]
    filled = fill_forward(
        metrics,
        {"__start": "start_position", "__end": "end_position"},
        K2,
        ["lap_number", "date_start"],
        part,
        threshold,
        sizes,
    )
    first = F.col("first_position")

    def choose(carried: str) -> Column:
        return F.when(F.col("lap_number") == 1, first).otherwise(F.coalesce(F.col(carried), first))

    return filled.withColumns(
        {"filled_start_position": choose("__start"), "filled_end_position": choose("__end")}
    ).drop("__start", "__end")


def leaderboard(
    final_positions: DataFrame,
    drivers: DataFrame,
    final_intervals: DataFrame,
    best_laps: DataFrame,
    pit_stops: DataFrame,
    session_names: DataFrame,
    ordered: bool = False,
) -> DataFrame:
    """Final standings with gaps, best lap, stops and points; ``ordered`` adds the final sort.

    All inputs that are keyed by session and driver meet first and share that partitioning.
    """
    places = final_positions.select(*K2, "position")
    ranks = dense_levels(places, ["session_key"], "position", "rank")
    who = drivers.select(*K2, "broadcast_name", "team_name", "team_colour")
    joined = (
        places.join(who, K2)
        .join(final_intervals, K2, "left")
        .join(best_laps, K2, "left")
        .join(pit_stops, K2, "left")
    )
    out = (
        join_levels(joined, ranks, ["session_key", "position"])
        .join(session_names, "session_key")
        .select(
            "session_key",
            "driver_number",
            F.col("broadcast_name").alias("driver_name"),
            "rank",
            "team_name",
            F.col("team_colour").alias("team_color"),
            F.when(F.col("position") == 1, F.lit(0.0)).otherwise(F.col("gap_to_leader"))
            .alias("gap_to_leader"),
            "gap_to_next",
            "best_lap_time",
            "pit_stop_count",
            "session_display_name",
            points_for("position").alias("points"),
        )
    )
    return out.orderBy("rank", "session_key", "driver_number") if ordered else out


def driver_results(
    final_positions: DataFrame, drivers: DataFrame, pit_stops: DataFrame, session_names: DataFrame
) -> DataFrame:
    """The columns of :func:`leaderboard` that team standings need, without ranks, gaps and laps.

    Its left joins add no rows, but a sum above them keeps the optimizer from leaving them out.
    """
    return (
        final_positions.select(*K2, "position")
        .join(drivers.select(*K2, "team_name"), K2)
        .join(pit_stops, K2, "left")
        .join(session_names.select("session_key"), "session_key")
        .select(*K2, "team_name", "pit_stop_count", points_for("position").alias("points"))
    )


def session_driver_count(position: DataFrame) -> DataFrame:
    # two aggregates instead of a distinct count, so a large session is spread by driver first
    return position.select(*K2).distinct().groupBy("session_key").agg(
        F.count("driver_number").alias("total_drivers")
    )


def session_lap_count(laps: DataFrame) -> DataFrame:
    return laps.groupBy("session_key").agg(F.max("lap_number").alias("total_laps"))


def team_standings(board: DataFrame) -> DataFrame:
    return board.groupBy("session_key", "team_name").agg(
        F.count_distinct("driver_number").alias("cars_finished"),
        F.sum("points").alias("constructor_points"),
        F.sum("pit_stop_count").alias("total_pit_stops"),
    )


def driver_stats(car: DataFrame) -> DataFrame:
    return car.groupBy(*K2).agg(
        F.max("speed").alias("top_speed"),
        F.avg("speed").alias("avg_speed"),
        F.count_if(F.col("drs") == 1).alias("drs_activations"),
    )


def race_summary(
    driver_count: DataFrame,
    lap_count: DataFrame,
    session_names: DataFrame,
    teams: DataFrame,
    stats: DataFrame,
    dedup_fanout: bool = False,
) -> DataFrame:
    """One row per session: drivers, laps, teams, stops, fastest and mean speed.

    Teams and drivers meet on the session only, so by definition ``total_pit_stops`` counts each team
    once per driver with telemetry; ``dedup_fanout`` counts it once. Both sides are reduced to one
    row per session first and the multiplicity is applied as a factor, so the teams x drivers
    pairs are never built.
    """
    by_team = teams.groupBy("session_key").agg(
        F.count_distinct("team_name").alias("total_teams"),
        F.sum("total_pit_stops").alias("__stops"),
    )
    by_driver = stats.groupBy("session_key").agg(
        F.count(F.lit(1)).alias("__drivers"),
        F.max("top_speed").alias("fastest_speed"),
        F.avg("avg_speed").alias("average_speed"),
    )
    copies = F.lit(1) if dedup_fanout else F.coalesce("__drivers", F.lit(1))
    return (
        driver_count.join(lap_count, "session_key")
        .join(session_names, "session_key")
        .join(by_team, "session_key", "left")
        .join(by_driver, "session_key", "left")
        .select(
            "session_key",
            "session_display_name",
            "total_drivers",
            "total_laps",
            F.coalesce("total_teams", F.lit(0)).alias("total_teams"),
            (F.col("__stops") * copies).alias("total_pit_stops"),
            "fastest_speed",
            "average_speed",
        )
    )


def session_driver_mapping(drivers: DataFrame, sessions: DataFrame) -> DataFrame:
    return (
        drivers.join(sessions.select("session_key"), "session_key")
        .select(
            "session_key",
            bracket_label("name_acronym", "full_name", outer="team_name")
            .alias("driver_display_name"),
            "driver_number",
        )
        .distinct()
    )


def session_filters(sessions: DataFrame, drivers: DataFrame, meetings: DataFrame) -> DataFrame:
    """Sessions with their meeting (by year and country) and the sorted list of their drivers.

    The drivers are collected once per session before the meetings multiply the rows.
    """
    labels = (
        drivers.select(
            "session_key",
            bracket_label("name_acronym", "full_name", outer="team_name").alias("label"),
        )
        .distinct()
        .groupBy("session_key")
        .agg(F.sort_array(F.collect_set("label")).alias("available_driver_names"))
    )
    return (
        sessions.join(labels, "session_key")
        .join(
            meetings.select("year", "country_name", "meeting_name", "meeting_official_name"),
            ["year", "country_name"],
        )
        .select(
            "year",
            "country_name",
            "circuit_short_name",
            "session_name",
            "session_type",
            session_label("year", "country_name", "session_name").alias("session_display_name"),
            "available_driver_names",
            "meeting_name",
            "meeting_official_name",
            "session_key",
            "date_start",
        )
        .distinct()
    )


def session_name_mapping(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        session_label("year", "country_name", "session_name").alias("session_display_name"),
        "session_key",
    ).distinct()


def compound_performance(enriched: DataFrame) -> DataFrame:
    """Stint length per circuit and compound, averaged over drivers first."""
    per_driver = enriched.groupBy(
        "circuit_short_name", "compound", "team_name", "driver_number"
    ).agg(
        F.avg("stint_length").alias("avg_stint_length"),
        F.max("stint_length").alias("max_stint_length"),
        F.avg("tyre_age_at_start").alias("avg_starting_age"),
        F.count(F.lit(1)).alias("number_of_stints"),
    )
    return per_driver.groupBy("circuit_short_name", "compound").agg(
        F.avg("avg_stint_length").alias("circuit_compound_avg_stint"),
        F.max("max_stint_length").alias("circuit_compound_max_stint"),
        F.avg("avg_starting_age").alias("avg_tire_age_start"),
        F.sum("number_of_stints").alias("total_stints"),
    )
