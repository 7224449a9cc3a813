import pytest
from pyspark.sql import functions as F

from lapframe.plans import Warehouse, intermediate, marts, staging
from lapframe.schemas import RAW
from lapframe.sources import load_sources, register_views


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture
def empty(spark):
    return {name: spark.createDataFrame([], schema) for name, schema in RAW.items()}


def test_every_model_handles_empty_tables(empty):
    house = Warehouse(empty)
    for name in house.MODELS:
        model = getattr(house, name)
        assert model.count() == 0, name
        assert model.columns


def test_final_gaps_are_numeric_maxima(frame):
    raw = frame(
        [("2024-01-01 00:00:00", 1, 1, 1, g, "None") for g in ("+1 LAP", "+2 LAPS", "None", "", "12.5", "9.1")],
        "date timestamp, driver_number int, session_key int, meeting_key int, gap_to_leader string,"
        " interval string",
    )
    assert rows(intermediate.final_intervals(staging.stg_intervals(raw))) == [(1, 1, 12.5, None)]


def _laps(frame, data):
    return frame(
        [(1, 1, a, b, 10.0, n, False, 1.0, 1.0, 1.0) for n, a, b in data],
        "session_key int, driver_number int, date_start timestamp, date_end timestamp,"
        " lap_duration double, lap_number int, is_pit_out_lap boolean, duration_sector_1 double,"
        " duration_sector_2 double, duration_sector_3 double",
    )


def test_history_fills_forward_and_compares_gaps_as_text(frame):
    laps = _laps(frame, [
        (n, f"2024-01-01 00:0{n}:00", f"2024-01-01 00:0{n}:30") for n in range(1, 6)
    ])
    position = frame(
        [(1, 1, 2, "2024-01-01 00:00:10"), (1, 1, 5, "2024-01-01 00:02:10"),
         (1, 1, 7, "2024-01-01 00:04:05"), (1, 1, 8, "2024-01-01 00:04:25")],
        "session_key int, driver_number int, position int, date timestamp",
    )
    gaps = frame(
        [(1, 1, "2024-01-01 00:01:00.4", g, None) for g in ("9.1", "12.5")]
        + [(1, 1, "2024-01-01 00:01:30.7", "99", "+1 LAP")],
        "session_key int, driver_number int, date timestamp, gap_to_leader string, gap_to_next string",
    )
    metrics = marts.lap_metrics(laps, marts.first_positions(position), gaps, position)
    history = marts.historical_race_analysis(metrics)
    assert rows(history, "lap_number", "filled_start_position", "filled_end_position") == [
        (1, 2, 2), (2, 5, 5), (3, 5, 5), (4, 7, 8), (5, 7, 8),
    ]
    first = metrics.filter("lap_number = 1").first()
    # compared as text; the reading at 30.7 s counts because its second is the lap's last
    assert (first["min_gap_to_leader"], first["max_gap_to_leader"]) == ("12.5", "99")
    assert first["max_gap_to_next"] == "+1 LAP"
    split = marts.historical_race_analysis(metrics, laps_per_part=2, threshold=1)
    assert rows(split, *history.columns) == rows(history)


def test_leading_gap_takes_first_recorded_position(frame):
    laps = _laps(frame, [(2, "2024-01-01 00:02:00", "2024-01-01 00:02:30")])
    position = frame([(1, 1, 4, "2024-01-01 00:00:10")],
                     "session_key int, driver_number int, position int, date timestamp")
    gaps = frame([], "session_key int, driver_number int, date timestamp, gap_to_leader string,"
                     " gap_to_next string")
    history = marts.historical_race_analysis(
        marts.lap_metrics(laps, marts.first_positions(position), gaps, position)
    )
    assert rows(history, "start_position", "filled_start_position") == [(None, 4)]


def test_repeated_laps_collapse_and_numbers_share_positions(frame):
    laps = _laps(frame, [
        (1, "2024-01-01 00:01:00", "2024-01-01 00:01:30"),
        (1, "2024-01-01 00:01:00", "2024-01-01 00:01:30"),
        (1, "2024-01-01 00:05:00", "2024-01-01 00:05:30"),
    ])
    position = frame([(1, 1, 4, "2024-01-01 00:01:05"), (1, 1, 6, "2024-01-01 00:05:01")],
                     "session_key int, driver_number int, position int, date timestamp")
    gaps = frame([], "session_key int, driver_number int, date timestamp, gap_to_leader string,"
                     " gap_to_next string")
    metrics = marts.lap_metrics(laps, marts.first_positions(position), gaps, position)
    assert rows(metrics, "start_position", "end_position") == [(6, 4), (6, 4)]


STINT = "session_key int, driver_number int, stint_number int, compound string, lap_start int, lap_end int"


def test_stint_without_weather_is_hot_and_dry(frame):
    stints = frame([(1, 1, 1, None, 1, 3), (1, 2, 1, "SOFT", 1, 1)], STINT)
    laps = _laps(frame, [(n, f"2024-01-01 00:0{n}:00.5", "2024-01-01 00:09:00") for n in (1, 2, 3)])
    laps = laps.withColumn("date_start", F.date_trunc("second", "date_start"))
    spans = intermediate.stint_spans(stints, laps)
    assert rows(spans, "driver_number", "stint_length", F.col("stint_end_time").cast("string")) == [
        (1, 3, "2024-01-01 00:03:00"), (2, 1, None),
    ]
    # only weather inside the last lap: after the start of that lap, so not counted
    weather = frame([(1, "2024-01-01 00:03:20", 20.0, 20.0, 90.0, 1.0, 2.0)],
                    "session_key int, date timestamp, air_temperature double,"
                    " track_temperature double, humidity double, rainfall double, wind_speed double")
    out = intermediate.stint_weather(spans, weather)
    assert rows(out, "avg_air_temp", "had_rainfall", "track_temp_category", "weather_condition") == [
        (None, None, "Hot", "Dry")] * 2
    edge = weather.withColumn("date", F.lit("2024-01-01 00:03:00").cast("timestamp"))
    out = intermediate.stint_weather(spans, edge).filter("driver_number = 1")
    assert rows(out, "avg_air_temp", "track_temp_category", "weather_condition") == [
        (20.0, "Cold", "Wet")]


def test_leaderboard_gap_of_the_winner_and_missing_driver(frame):
    places = frame([(1, 1, 1), (1, 2, 2), (1, 3, 2), (1, 4, 11), (1, 9, 5)],
                   "session_key int, driver_number int, position int")
    drivers = frame([(1, n, f"d{n}", "t", "c") for n in (1, 2, 3, 4)],
                    "session_key int, driver_number int, broadcast_name string, team_name string,"
                    " team_colour string")
    gaps = frame([(1, 2, 3.5, 1.0)],
                 "session_key int, driver_number int, gap_to_leader double, gap_to_next double")
    best = frame([(1, 2, 80.0)], "session_key int, driver_number int, best_lap_time double")
    stops = frame([(1, 2, 2)], "session_key int, driver_number int, pit_stop_count bigint")
    names = frame([(1, "s")], "session_key int, session_display_name string")
    board = marts.leaderboard(places, drivers, gaps, best, stops, names, ordered=True)
    assert [tuple(r) for r in board.select("driver_number", "rank", "gap_to_leader", "points").collect()] == [
        (1, 1, 0.0, 25), (2, 2, 3.5, 18), (3, 2, None, 18), (4, 4, None, 0),
    ]


def test_summary_fan_out(frame):
    count = frame([(1, 3), (2, 1)], "session_key int, total_drivers bigint")
    laps = frame([(1, 50), (2, 9)], "session_key int, total_laps int")
    names = frame([(1, "s"), (2, "q")], "session_key int, session_display_name string")
    teams = frame([(1, "a", 3), (1, "b", 1)],
                  "session_key int, team_name string, total_pit_stops bigint")
    stats = frame([(1, "1", 300, 200.0), (1, "2", 310, 210.0), (1, "3", 305, 190.0)],
                  "session_key int, driver_number string, top_speed int, avg_speed double")
    args = (count, laps, names, teams, stats)
    assert rows(marts.race_summary(*args)) == [
        (1, "s", 3, 50, 2, 12, 310, 200.0), (2, "q", 1, 9, 0, None, None, None)]
    assert rows(marts.race_summary(*args, dedup_fanout=True), "total_pit_stops") == [(4,), (None,)]


def test_telemetry_without_a_driver_keeps_its_row(frame):
    car = frame([(1, "44", 300)], "session_key int, driver_number string, speed int").select(
        "*", *[F.lit(1).alias(c) for c in ("timestamp", "rpm", "throttle", "brake", "drs")])
    drivers = frame([], "session_key int, driver_number int, name_acronym string, team_name string,"
                        " team_colour string")
    base = intermediate.telemetry_base(car, drivers)
    sessions = frame([(1, 7)], "session_key int, meeting_key int")
    out = marts.car_telemetry(base, sessions, frame([(7,)], "meeting_key int"))
    assert rows(out, "driver", "speed", "meeting_key") == [(None, 300, 7)]


def test_two_meetings_in_a_country_double_the_sessions(frame):
    sessions = frame([(1, 1, "X", "Race", "Race", 2024, "c", None, None)],
                     "session_key int, meeting_key int, country_name string, session_name string,"
                     " session_type string, year int, circuit_short_name string,"
                     " date_start timestamp, date_end timestamp")
    drivers = frame([(1, 1, "AAA", "full a", "t"), (1, 2, "BBB", "full b", "t"), (1, 3, None, "c", "t")],
                    "session_key int, driver_number int, name_acronym string, full_name string,"
                    " team_name string")
    meetings = frame([(2024, "X", "m1", "M1"), (2024, "X", "m2", "M2")],
                     "year int, country_name string, meeting_name string, meeting_official_name string")
    out = marts.session_filters(sessions, drivers, meetings)
    assert rows(out, "session_display_name", "meeting_name", "available_driver_names") == [
        ("2024 - X - Race", m, ["AAA - full a (t)", "BBB - full b (t)"]) for m in ("m1", "m2")]


def test_tables_load_with_declared_types_and_models_register(spark, empty, tmp_path):
    for name in ("sessions", "laps"):
        empty[name].write.parquet(f"{tmp_path}/{name}")
    tables = load_sources(spark, str(tmp_path), ["sessions", "laps"])
    assert tables["laps"].schema == RAW["laps"]
    register_views({"session_names": marts.session_name_mapping(tables["sessions"])}, "m_")
    assert spark.sql("select count(*) from m_session_names").first()[0] == 0
