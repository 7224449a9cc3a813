"""SQL for every query that SQL can express, run by another engine on the same tables.

Each entry of ``CTE`` may name others; :func:`sql` puts those it needs in front of a SELECT.
"""

from __future__ import annotations

import re

CTE: dict[str, str] = {}

# ---- raw tables ----
CTE["ev0"] = """
SELECT event_id, ts, event_type, value,
       CAST(((day(ts) - 1) // 3) + 1 AS INTEGER) AS session_key,
       CAST(user_id AS INTEGER) AS driver_number
FROM events"""
CTE["ev"] = """
SELECT *, CAST(row_number() OVER (PARTITION BY session_key, driver_number ORDER BY ts, event_id)
               AS INTEGER) AS rn
FROM ev0"""
CTE["sessions"] = """
SELECT n_nationkey AS session_key, n_nationkey + 1000 AS meeting_key, r_name AS country_name,
       n_name AS circuit_short_name,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Race' ELSE 'Qualifying' END AS session_name,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Race' ELSE 'Qualifying' END AS session_type,
       2024 AS year,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(3 * (n_nationkey - 1)) AS date_start,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(3 * n_nationkey) AS date_end
FROM nation JOIN region ON n_regionkey = r_regionkey"""
CTE["meetings"] = """
SELECT n_nationkey + 1000 AS meeting_key, n_nationkey AS circuit_key,
       n_name AS circuit_short_name, r_name AS country_name, n_name AS meeting_name,
       upper(n_name) AS meeting_official_name,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(3 * (n_nationkey - 1)) AS date_start, 2024 AS year
FROM nation JOIN region ON n_regionkey = r_regionkey"""
CTE["drivers"] = """
SELECT DISTINCT session_key, driver_number, c_name AS broadcast_name,
       substr(c_name, 1, 8) AS first_name, substr(c_name, 10) AS last_name, c_name AS full_name,
       upper(substr(c_name, 1, 3)) AS name_acronym, c_mktsegment AS team_name,
       'C' || CAST(driver_number AS VARCHAR) AS team_colour,
       CAST(c_nationkey AS VARCHAR) AS country_code
FROM ev0 JOIN customer ON c_custkey = driver_number"""
CTE["laps"] = """
SELECT ts AS date_start, driver_number, session_key + 1000 AS meeting_key, session_key,
       rn AS lap_number, value AS duration_sector_1, value / 2 AS duration_sector_2,
       value / 4 AS duration_sector_3, value * 100 AS lap_duration,
       event_id % 9 = 0 AS is_pit_out_lap
FROM ev"""
CTE["position"] = """
SELECT session_key + 1000 AS meeting_key, session_key, driver_number,
       CAST(event_id % 20 + 1 AS INTEGER) AS position,
       ts + to_seconds(event_id % 600) AS date
FROM ev0 WHERE event_type IN ('click', 'view')"""
CTE["intervals"] = """
SELECT ts + to_seconds(event_id % 600) AS date, driver_number, session_key,
       session_key + 1000 AS meeting_key,
       CASE WHEN event_id % 10 = 0 THEN 'None' WHEN event_id % 10 = 1 THEN '+1 LAP'
            ELSE CAST(event_id % 90 AS VARCHAR) || '.' || CAST(event_id % 7 AS VARCHAR)
       END AS gap_to_leader,
       CASE WHEN event_id % 8 = 0 THEN 'None' WHEN event_id % 8 = 1 THEN '+2 LAPS'
            ELSE CAST(event_id % 9 AS VARCHAR) || '.' || CAST(event_id % 5 AS VARCHAR)
       END AS "interval"
FROM ev0 WHERE event_type IN ('purchase', 'signup')"""
CTE["pit"] = """
SELECT ts AS date, driver_number, session_key + 1000 AS meeting_key, rn AS lap_number,
       value AS pit_duration, session_key
FROM ev WHERE event_type = 'signup'"""
CTE["weather"] = """
SELECT session_key, ts AS date,
       CAST(10 AS DOUBLE) + round(value * 100) / CAST(2048 AS DOUBLE) AS air_temperature,
       CAST(15 AS DOUBLE) + round(value * 100) / CAST(1024 AS DOUBLE) AS track_temperature,
       CAST(event_id % 100 AS DOUBLE) AS humidity,
       CAST(CASE WHEN event_id % 701 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS rainfall,
       CAST(event_id % 12 AS DOUBLE) AS wind_speed
FROM ev0 WHERE event_type = 'error'"""
CTE["car"] = """
SELECT event_id, event_type, value, session_key + 1000 AS meeting_key, session_key, driver_number,
       ts AS date,
       CAST(event_id * 37 % 16000 AS INTEGER) AS rpm, CAST(event_id * 13 % 420 AS INTEGER) AS speed,
       CAST(event_id * 7 % 115 AS INTEGER) AS throttle,
       CAST(event_id * 11 % 115 AS INTEGER) AS brake, CAST(event_id % 16 AS INTEGER) AS drs,
       CAST(event_id % 9 AS INTEGER) AS n_gear
FROM ev0"""
CTE["car_data"] = """
SELECT meeting_key, session_key, driver_number, date, rpm, speed, throttle, brake, drs, n_gear
FROM car"""
CTE["stints"] = """
SELECT session_key, session_key + 1000 AS meeting_key, driver_number, g + 1 AS stint_number,
       CASE g % 7 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HARD'
            WHEN 3 THEN 'INTERMEDIATE' WHEN 4 THEN 'WET' WHEN 6 THEN 'UNKNOWN' END AS compound,
       lap_start, lap_end, g * 5 % 30 AS tyre_age_at_start
FROM (SELECT session_key, driver_number, CAST((rn - 1) // 3 AS INTEGER) AS g,
             min(rn) AS lap_start, max(rn) AS lap_end
      FROM ev GROUP BY session_key, driver_number, g)"""

# ---- staging ----
CTE["stg_car_data"] = """
SELECT session_key, CAST(driver_number AS VARCHAR) AS driver_number, date AS "timestamp",
       rpm, speed, throttle, brake, drs
FROM car_data"""
CTE["stg_drivers"] = "SELECT DISTINCT * FROM drivers"
CTE["stg_intervals"] = """
SELECT session_key, driver_number, date, nullif(gap_to_leader, 'None') AS gap_to_leader,
       nullif("interval", 'None') AS gap_to_next
FROM intervals"""
CTE["stg_laps"] = """
SELECT session_key, driver_number, date_trunc('second', date_start) AS date_start,
       date_trunc('second', date_start) + to_seconds(CAST(round(lap_duration) AS BIGINT))
           AS date_end,
       lap_duration, lap_number, is_pit_out_lap, duration_sector_1, duration_sector_2,
       duration_sector_3
FROM laps"""
CTE["stg_meetings"] = """
SELECT meeting_key, meeting_name, meeting_official_name, country_name, circuit_short_name, year,
       date_start
FROM meetings"""
CTE["stg_pit"] = "SELECT * FROM pit"
CTE["stg_position"] = "SELECT session_key, driver_number, position, date FROM position"
CTE["stg_sessions"] = """
SELECT session_key, meeting_key, country_name, session_name, session_type, year,
       circuit_short_name, date_start, date_end
FROM sessions"""
CTE["stg_stints"] = "SELECT * FROM stints"
CTE["stg_weather"] = "SELECT * FROM weather"

# ---- intermediate ----
CTE["best_laps"] = """
SELECT session_key, driver_number, min(lap_duration) AS best_lap_time
FROM stg_laps WHERE lap_duration > 0 GROUP BY session_key, driver_number"""
CTE["telemetry_base"] = """
SELECT c.driver_number, c.session_key, d.name_acronym, d.team_name, d.team_colour, c."timestamp",
       c.rpm, c.speed, c.throttle, c.brake, c.drs
FROM stg_car_data c
LEFT JOIN stg_drivers d
  ON CAST(c.driver_number AS INTEGER) = d.driver_number AND c.session_key = d.session_key"""
CTE["final_intervals"] = """
SELECT session_key, driver_number,
       max(CASE WHEN gap_to_leader LIKE '%L%' THEN NULL ELSE TRY_CAST(gap_to_leader AS DOUBLE) END)
           AS gap_to_leader,
       max(CASE WHEN gap_to_next LIKE '%L%' THEN NULL ELSE TRY_CAST(gap_to_next AS DOUBLE) END)
           AS gap_to_next
FROM stg_intervals GROUP BY session_key, driver_number"""
CTE["final_positions"] = """
SELECT session_key, driver_number, position, date AS latest_date FROM stg_position
QUALIFY row_number() OVER (PARTITION BY session_key, driver_number
                           ORDER BY date DESC NULLS FIRST, position NULLS LAST) = 1"""
# Every event in every lap that contains it; the rank is the number of that lap's events that come before it, plus one.
CTE["lap_events"] = """
SELECT lap.session_key, lap.driver_number, lap.lap_number, lap.date_start, lap.date_end, event.position, event.date,
       abs(epoch(date_trunc('second', event.date)) - epoch(lap.date_start))::BIGINT AS from_start,
       abs(epoch(date_trunc('second', event.date)) - epoch(lap.date_end))::BIGINT AS from_end
FROM stg_position event JOIN stg_laps lap USING (driver_number, session_key)
WHERE event.date >= lap.date_start AND event.date <= lap.date_end"""
CTE["lap_positions"] = """
SELECT mine.session_key, mine.driver_number, mine.position, mine.date, mine.lap_number, mine.date_start, mine.date_end,
       mine.from_start AS start_time_diff, mine.from_end AS end_time_diff,
       (1 + count(*) FILTER ((other.from_start, other.date, other.position) < (mine.from_start, mine.date, mine.position)))::INTEGER
           AS start_position_rank,
       (1 + count(*) FILTER ((other.from_end, other.date, other.position) < (mine.from_end, mine.date, mine.position)))::INTEGER
           AS end_position_rank
FROM lap_events mine JOIN lap_events other USING (session_key, driver_number, lap_number)
GROUP BY ALL"""
CTE["pit_stops"] = """
SELECT session_key, driver_number, count(*) AS pit_stop_count
FROM stg_pit GROUP BY session_key, driver_number"""
CTE["race_venues"] = """
SELECT session_key, circuit_short_name, country_name, session_type FROM stg_sessions WHERE session_type = 'Race'"""
CTE["stints_enriched"] = """
SELECT stint.*, crew.team_name, circuit_short_name, country_name, session_type, 1 + lap_end - lap_start AS stint_length
FROM race_venues JOIN stg_stints stint USING (session_key)
LEFT JOIN (SELECT DISTINCT session_key, driver_number, team_name FROM stg_drivers) crew USING (session_key, driver_number)"""
CTE["stint_spans"] = """
SELECT DISTINCT session_key, driver_number, stint_number, compound, lap_start, lap_end,
       1 + lap_end - lap_start AS stint_length, inside.first_start AS stint_start_time, inside.last_start AS stint_end_time
FROM stg_stints stint, LATERAL (
    SELECT min(date_start) AS first_start, max(date_start) AS last_start FROM stg_laps lap
    WHERE lap.driver_number = stint.driver_number AND lap.session_key = stint.session_key
      AND lap.lap_number >= stint.lap_start AND lap.lap_number <= stint.lap_end) inside"""
# A stint without readings compares as hot and dry.
CTE["stint_weather"] = """
SELECT span.* EXCLUDE (stint_start_time, stint_end_time), seen.*,
       CASE WHEN coalesce(avg_track_temp, 35) >= 35 THEN 'Hot' WHEN avg_track_temp >= 25 THEN 'Medium' ELSE 'Cold' END
           AS track_temp_category,
       CASE WHEN coalesce(had_rainfall, 0) <= 0 AND coalesce(avg_humidity, 0) <= 70 THEN 'Dry'
            WHEN had_rainfall > 0 THEN 'Wet' ELSE 'High Humidity' END AS weather_condition
FROM (SELECT DISTINCT * FROM stint_spans) span, LATERAL (
    SELECT avg(air_temperature) AS avg_air_temp, avg(track_temperature) AS avg_track_temp, avg(humidity) AS avg_humidity,
           max(rainfall) AS had_rainfall, avg(wind_speed) AS avg_wind_speed
    FROM stg_weather reading
    WHERE reading.session_key = span.session_key
      AND reading.date >= span.stint_start_time AND reading.date <= span.stint_end_time) seen"""

# ---- marts ----
CTE["car_telemetry"] = """
SELECT t."timestamp", t.name_acronym || ' (' || t.team_name || ')' AS driver, t.driver_number,
       CAST(round(t.speed) AS INTEGER) AS speed, CAST(round(t.throttle) AS INTEGER) AS throttle,
       CAST(round(t.brake) AS INTEGER) AS brake, CAST(round(t.drs) AS INTEGER) AS drs,
       t.rpm, t.session_key, m.meeting_key
FROM telemetry_base t
LEFT JOIN stg_sessions s ON t.session_key = s.session_key
LEFT JOIN stg_meetings m ON s.meeting_key = m.meeting_key"""
CTE["first_positions"] = """
SELECT session_key, driver_number, position AS first_position, date FROM stg_position
QUALIFY row_number() OVER (PARTITION BY session_key, driver_number
                           ORDER BY date NULLS LAST, position NULLS LAST) = 1"""
# The place at a lap's start is that of the event with the least distance to it; gaps compare as texts.
CTE["lap_places"] = """
SELECT session_key, driver_number, lap_number,
       arg_min(position, (from_start, date, position)) AS start_position, arg_min(position, (from_end, date, position)) AS end_position
FROM lap_events GROUP BY session_key, driver_number, lap_number"""
CTE["lap_gaps"] = """
SELECT lap.session_key, lap.driver_number, lap.date_start, lap.date_end,
       min(gap_to_leader) AS min_gap_to_leader, max(gap_to_leader) AS max_gap_to_leader,
       min(gap_to_next) AS min_gap_to_next, max(gap_to_next) AS max_gap_to_next
FROM stg_intervals gap JOIN (SELECT DISTINCT session_key, driver_number, date_start, date_end FROM stg_laps) lap USING (driver_number, session_key)
WHERE floor(epoch(gap.date)) >= epoch(lap.date_start) AND floor(epoch(gap.date)) <= epoch(lap.date_end)
GROUP BY lap.session_key, lap.driver_number, lap.date_start, lap.date_end"""
CTE["lap_metrics"] = """
SELECT DISTINCT lap_number, lap.session_key, lap.driver_number, lap.date_start, lap.date_end, is_pit_out_lap,
       duration_sector_1, duration_sector_2, duration_sector_3, start.first_position,
       min_gap_to_leader, max_gap_to_leader, min_gap_to_next, max_gap_to_next, start_position, end_position
FROM stg_laps lap
LEFT JOIN lap_places USING (session_key, driver_number, lap_number)
LEFT JOIN lap_gaps USING (session_key, driver_number, date_start, date_end)
LEFT JOIN first_positions start USING (session_key, driver_number)"""
CTE["historical_race_analysis"] = """
SELECT *,
       CASE WHEN lap_number = 1 THEN first_position
            ELSE coalesce(start_position, last_value(start_position IGNORE NULLS) OVER w,
                          first_position) END AS filled_start_position,
       CASE WHEN lap_number = 1 THEN first_position
            ELSE coalesce(end_position, last_value(end_position IGNORE NULLS) OVER w,
                          first_position) END AS filled_end_position
FROM lap_metrics
WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY lap_number
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
CTE["session_name_mapping"] = """
SELECT DISTINCT CAST(year AS VARCHAR) || ' - ' || country_name || ' - ' || session_name
           AS session_display_name, session_key
FROM stg_sessions"""
# Points are the place's entry in a list; a rank is the number of different better places, plus one.
CTE["leaderboard"] = """
WITH placed AS (
  SELECT session_key, driver_number, position,
         (1 + len(list_filter(list(DISTINCT position) OVER (PARTITION BY session_key), lambda better: position IS NULL OR better < position)))::INTEGER AS rank
  FROM final_positions)
SELECT session_key, driver_number, broadcast_name AS driver_name, rank, team_name, team_colour AS team_color,
       if(position = 1, 0::DOUBLE, gap_to_leader) AS gap_to_leader, gap_to_next, best_lap_time, pit_stop_count,
       session_display_name, coalesce([25, 18, 15, 12, 10, 8, 6, 4, 2, 1][position], 0)::INTEGER AS points
FROM session_name_mapping
JOIN stg_drivers USING (session_key)
JOIN placed USING (session_key, driver_number)
LEFT JOIN pit_stops USING (session_key, driver_number)
LEFT JOIN final_intervals USING (session_key, driver_number)
LEFT JOIN best_laps USING (session_key, driver_number)"""
CTE["session_driver_count"] = """
SELECT session_key, count(DISTINCT driver_number) AS total_drivers
FROM stg_position GROUP BY session_key"""
CTE["session_lap_count"] = """
SELECT session_key, max(lap_number) AS total_laps FROM stg_laps GROUP BY session_key"""
CTE["team_standings"] = """
SELECT session_key, team_name, count(DISTINCT driver_number) AS cars_finished,
       CAST(sum(points) AS BIGINT) AS constructor_points,
       CAST(sum(pit_stop_count) AS BIGINT) AS total_pit_stops
FROM leaderboard GROUP BY session_key, team_name"""
CTE["driver_stats"] = """
SELECT session_key, driver_number, max(speed) AS top_speed, avg(speed) AS avg_speed,
       CAST(sum(CASE WHEN drs = 1 THEN 1 ELSE 0 END) AS BIGINT) AS drs_activations
FROM stg_car_data GROUP BY session_key, driver_number"""
# Each team meets every driver with telemetry, so the stops count once per such driver.
CTE["race_summary"] = """
WITH team AS (
  SELECT session_key, count(DISTINCT team_name) AS teams, sum(total_pit_stops) AS stops FROM team_standings GROUP BY session_key),
driver AS (
  SELECT session_key, count(*) AS n, max(top_speed) AS fastest, sum(avg_speed) / count(avg_speed) AS mean FROM driver_stats GROUP BY session_key)
SELECT session_key, session_display_name, total_drivers, total_laps, coalesce(teams, 0) AS total_teams,
       (stops * coalesce(n, 1))::BIGINT AS total_pit_stops, fastest AS fastest_speed, round(mean, 6) AS average_speed
FROM session_name_mapping JOIN session_lap_count USING (session_key) JOIN session_driver_count USING (session_key)
LEFT JOIN team USING (session_key) LEFT JOIN driver USING (session_key)"""
CTE["race_summary_dedup"] = """
SELECT r.* REPLACE (t.stops AS total_pit_stops)
FROM race_summary r
LEFT JOIN (SELECT session_key, CAST(sum(total_pit_stops) AS BIGINT) AS stops
           FROM team_standings GROUP BY session_key) t ON r.session_key = t.session_key"""
CTE["session_driver_mapping"] = """
SELECT DISTINCT d.session_key,
       d.name_acronym || ' - ' || d.full_name || ' (' || d.team_name || ')' AS driver_display_name,
       d.driver_number
FROM stg_drivers d JOIN stg_sessions s ON d.session_key = s.session_key"""
CTE["session_filters"] = """
SELECT held.year, held.country_name, held.circuit_short_name, held.session_name, held.session_type,
       concat_ws(' - ', held.year, held.country_name, held.session_name) AS session_display_name, names.available_driver_names,
       place.meeting_name, place.meeting_official_name, held.session_key, held.date_start
FROM (SELECT session_key, array_to_string(list_sort(list_distinct(list(driver_display_name))), ';') AS available_driver_names
      FROM session_driver_mapping GROUP BY session_key) names
JOIN (SELECT DISTINCT * FROM stg_sessions) held USING (session_key)
JOIN (SELECT DISTINCT year, country_name, meeting_name, meeting_official_name FROM stg_meetings) place
  ON (place.country_name, place.year) = (held.country_name, held.year)"""
# A driver's stints on a compound count as one value each in the mean over drivers.
CTE["compound_performance"] = """
WITH driver AS (
  SELECT circuit_short_name, compound, list(stint_length) AS lengths, list(tyre_age_at_start) AS ages
  FROM stints_enriched GROUP BY circuit_short_name, compound, team_name, driver_number)
SELECT circuit_short_name, compound,
       round(list_avg(list(list_avg(lengths))), 6) AS circuit_compound_avg_stint,
       list_max(flatten(list(lengths))) AS circuit_compound_max_stint,
       round(list_avg(list(list_avg(ages))), 6) AS avg_tire_age_start, sum(len(lengths))::BIGINT AS total_stints
FROM driver GROUP BY circuit_short_name, compound"""

# ---- quality ----
_COMPOUNDS = "('SOFT', 'MEDIUM', 'HARD', 'INTERMEDIATE', 'WET')"
_DRS = "(0, 1, 2, 3, 8, 9, 10, 11, 12, 13, 14, 15)"
# A record counts if at least one other hard record lies less than the gap away.
_BURST = """
SELECT * EXCLUDE (near) FROM (
  SELECT *, count(*) OVER (ORDER BY epoch_ms(date) RANGE BETWEEN {gap} - 1 PRECEDING AND {gap} - 1 FOLLOWING) AS near
  FROM car_data WHERE {condition})
WHERE near > 1"""
CTE["dq_sustained_burst"] = _BURST.format(
    condition="brake > 50 AND throttle > 50 AND speed > 50 AND rpm > 5000", gap=60000
)
CTE["stock_burst"] = _BURST.format(
    condition="brake > 105 AND throttle > 105 AND speed > 50 AND rpm > 5000", gap=500
)
CTE["dq_not_null"] = "SELECT * FROM stg_intervals WHERE gap_to_leader IS NULL"
CTE["dq_unique"] = """
SELECT driver_number, count(*) AS n_records FROM stg_drivers
WHERE driver_number IS NOT NULL GROUP BY driver_number HAVING count(*) > 1"""
CTE["dq_relationships"] = """
SELECT * FROM car_data
WHERE driver_number IS NOT NULL
  AND driver_number NOT IN (SELECT driver_number FROM drivers WHERE team_name = 'MACHINERY')"""
CTE["dq_accepted_values"] = "SELECT * FROM stints WHERE compound NOT IN ('SOFT', 'MEDIUM', 'HARD')"
CTE["dq_range"] = "SELECT * FROM car_data WHERE rpm < 0 OR rpm > 15000"
CTE["dq_range_count"] = """
SELECT count(*) AS n_failed FROM car_data WHERE brake < 0 OR brake > 100"""
CTE["dq_valid_codes"] = f"SELECT * FROM car_data WHERE drs NOT IN {_DRS}"


def _line(table: str, check: str, column: str, bad: str, where: str = "true") -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
        f"count(*) FILTER (WHERE {where}) AS n_checked, "
        f"count(*) FILTER (WHERE ({where}) AND ({bad})) AS n_failed FROM {table}"
    )


def _report() -> str:
    required = {
        "position": ["date", "driver_number", "meeting_key", "position", "session_key"],
        "laps": ["driver_number", "lap_number"],
        "car_data": ["date", "driver_number", "drs", "rpm", "speed", "throttle"],
        "intervals": ["date", "driver_number", "session_key"],
        "pit": ["date", "driver_number", "lap_number"],
        "meetings": [
            "circuit_key", "circuit_short_name", "country_name", "date_start", "meeting_name",
            "year",
        ],
        "sessions": ["session_key", "meeting_key", "session_name", "session_type"],
        "drivers": ["driver_number", "broadcast_name", "full_name", "name_acronym"],
        "stints": ["lap_start", "lap_end", "stint_number"],
    }
    lines = [
        _line(table, "not_null", column, f"{column} IS NULL")
        for table, columns in required.items()
        for column in columns
    ]
    lines += [
        _line("stints", "not_null", "driver_number", "driver_number IS NULL", "driver_number != 0"),
        _line("stints", "not_null", "tyre_age_at_start", "tyre_age_at_start IS NULL",
              "tyre_age_at_start IS NOT NULL"),
        _line("stints", "accepted_values", "compound", f"compound NOT IN {_COMPOUNDS}",
              f"compound IS NULL OR compound IN {_COMPOUNDS}"),
        _line("car_data", "valid_drs", "drs", f"drs NOT IN {_DRS}"),
        _line("car_data", "rpm_range", "rpm", "rpm < 0 OR rpm > 15000"),
        _line("car_data", "speed_range", "speed", "speed < 0 OR speed > 410"),
        _line("car_data", "throttle_range", "throttle", "throttle < 0 OR throttle > 110"),
        _line("stints", "range_check", "lap_start", "lap_start < 1 OR lap_start > 71"),
        _line("stints", "range_check", "lap_end", "lap_end < 0 OR lap_end > 79"),
        _line("stints", "range_check", "stint_number", "stint_number < 1 OR stint_number > 9"),
        _line("stints", "range_check", "tyre_age_at_start",
              "tyre_age_at_start < 0 OR tyre_age_at_start > 28"),
        """SELECT 'sessions', 'unique', 'session_key', count(*),
           (SELECT count(*) FROM (SELECT session_key FROM sessions WHERE session_key IS NOT NULL
                                  GROUP BY 1 HAVING count(*) > 1)) FROM sessions""",
        """SELECT 'car_data', 'brake_throttle_combination', 'date', count(*),
           (SELECT count(*) FROM stock_burst) FROM car_data""",
    ]
    lines += [
        _line(table, "relationships", "driver_number",
              "driver_number IS NOT NULL AND driver_number NOT IN "
              "(SELECT driver_number FROM drivers WHERE driver_number IS NOT NULL)", where)
        for table, where in (("car_data", "true"), ("stints", "driver_number IS NOT NULL"))
    ]
    return "SELECT *, n_failed = 0 AS passed FROM (" + "\nUNION ALL ".join(lines) + ")"


CTE["dq_report"] = _report()

# ---- load path ----
_OLD, _NEW = "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-02-02 00:00:00'"
CTE["merge_upsert"] = f"""
SELECT coalesce(s.meeting_key, t.meeting_key) AS meeting_key,
       coalesce(s.session_key, t.session_key) AS session_key,
       coalesce(s.driver_number, t.driver_number) AS driver_number,
       coalesce(s.date, t.date) AS date,
       CASE WHEN s.date IS NULL THEN t.speed ELSE s.speed + 1 END AS speed,
       CASE WHEN s.date IS NULL THEN t.rpm ELSE s.rpm END AS rpm,
       CASE WHEN t.date IS NULL THEN {_NEW} ELSE {_OLD} END AS created_at,
       CASE WHEN s.date IS NULL THEN {_OLD} ELSE {_NEW} END AS updated_at
FROM (SELECT * FROM car WHERE event_type <> 'signup') t
FULL JOIN (SELECT * FROM car WHERE event_type <> 'click') s
  ON t.event_id = s.event_id"""
CTE["upsert_table"] = f"""
WITH old AS (SELECT * FROM car WHERE event_type <> 'signup' AND session_key < 9),
     new AS (SELECT * FROM car WHERE event_type <> 'click' AND session_key > 4)
SELECT meeting_key, session_key, driver_number, date, speed + 1 AS speed, rpm,
       CASE WHEN event_id IN (SELECT event_id FROM old) THEN {_OLD} ELSE {_NEW} END AS created_at,
       {_NEW} AS updated_at, true AS marked
FROM new
UNION ALL
SELECT meeting_key, session_key, driver_number, date, speed, rpm, {_OLD}, {_OLD}, CAST(NULL AS BOOLEAN)
FROM old WHERE event_id NOT IN (SELECT event_id FROM new)"""
CTE["race_control"] = """
SELECT event_type AS category, ts AS date, CASE WHEN event_id % 3 <> 0 THEN driver_number END AS driver_number,
       CASE event_id % 4 WHEN 0 THEN 'YELLOW' WHEN 1 THEN 'GREEN' END AS flag,
       'message ' || (event_id % 50)::VARCHAR AS message, CAST(event_id % 60 AS INTEGER) AS lap_number,
       (session_key + 1000)::VARCHAR AS meeting_key, 'Track' AS scope, CAST(NULL AS VARCHAR) AS sector, session_key
FROM ev0"""
# A message about no driver matches nothing, so both loads bring it; of the others the second changes the flag.
CTE["upsert_race_control"] = f"""
SELECT * EXCLUDE (second) REPLACE (CASE WHEN c.category <> 'click' AND driver_number IS NOT NULL OR l.second THEN 'RED' ELSE flag END AS flag),
       CASE WHEN l.second THEN {_NEW} ELSE {_OLD} END AS created_at,
       CASE WHEN l.second OR c.category <> 'click' AND driver_number IS NOT NULL THEN {_NEW} ELSE {_OLD} END AS updated_at,
       CASE WHEN l.second THEN 'load 2' ELSE 'load 1' END AS load_id
FROM race_control c JOIN (VALUES (false), (true)) AS l(second)
  ON CASE WHEN l.second THEN c.category <> 'click' AND (c.category = 'signup' OR c.driver_number IS NULL)
          ELSE c.category <> 'signup' END"""
CTE["load_counts"] = """
SELECT 'pit' AS endpoint, session_key, count(*) AS n FROM pit GROUP BY ALL
UNION ALL SELECT 'intervals', session_key, count(*) FROM intervals GROUP BY ALL
UNION ALL SELECT 'race_control', session_key, count(*) FROM race_control GROUP BY ALL
UNION ALL SELECT 'car_data', session_key, count(*) FROM ev0 WHERE event_id % 11 <> 0 GROUP BY ALL
UNION ALL SELECT DISTINCT 'team_radio', session_key, 1 FROM ev0 WHERE event_type = 'view' AND session_key <> 4"""
CTE["load_failures"] = """
SELECT 'weather' AS endpoint, 'ValueError: merge keys missing in weather: [''meeting_key'']' AS reason
UNION ALL SELECT 'position', 'CheckFailed: range_check(position): ' || count(*) FROM position WHERE position > 15"""
CTE["load_batch"] = """
SELECT 'load 2' AS load_id, e.endpoint, meeting_key, session_key,
       CASE WHEN f.reason IS NOT NULL THEN 'error' WHEN held OR n IS NULL THEN 'skipped' ELSE 'success' END AS status,
       CASE WHEN f.reason IS NOT NULL THEN f.reason WHEN held THEN 'data_exists' WHEN n IS NULL THEN 'no_data' END AS reason,
       CASE WHEN f.reason IS NOT NULL OR held OR n IS NULL THEN 0 ELSE n END AS records
FROM (SELECT DISTINCT endpoint FROM load_counts UNION SELECT endpoint FROM load_failures) e
CROSS JOIN sessions
LEFT JOIN load_counts USING (endpoint, session_key)
LEFT JOIN load_failures f USING (endpoint)
CROSS JOIN LATERAL (SELECT endpoint = 'pit' AND session_key <= 3 AND n IS NOT NULL AS held)"""
CTE["load_published"] = f"""
SELECT endpoint AS name, session_key, n AS records,
       CASE WHEN endpoint = 'race_control' THEN drivers ELSE n END AS with_driver, 1::BIGINT AS days,
       CASE WHEN endpoint = 'pit' AND session_key <= 3 THEN {_OLD} ELSE {_NEW} END AS created_at
FROM load_counts
LEFT JOIN (SELECT session_key, count(driver_number) AS drivers FROM race_control GROUP BY ALL) USING (session_key)
UNION ALL SELECT 'pit: malformed JSON', NULL, count(*), NULL, NULL, NULL FROM ev0 WHERE event_id % 97 = 0 HAVING count(*) > 0
UNION ALL SELECT 'car_data: required field missing', NULL, count(*), NULL, NULL, NULL FROM ev0 WHERE event_id % 11 = 0 HAVING count(*) > 0"""
CTE["only_new"] = """
SELECT * FROM car_data
WHERE (meeting_key, session_key) NOT IN
      (SELECT (meeting_key, session_key) FROM pit WHERE pit_duration > 350)"""
CTE["schema_evolution"] = """
SELECT *, DATE '2024-02-02' AS processed_date, TIMESTAMP '2024-02-02 00:00:00' AS created_at,
       TIMESTAMP '2024-02-02 00:00:00' AS updated_at
FROM pit"""
CTE["required_fields"] = """
SELECT event_id, date IS NOT NULL AND driver_number IS NOT NULL AS valid
FROM (SELECT event_id, CASE WHEN value < 5 THEN NULL ELSE ts END AS date,
             CASE WHEN event_type = 'error' THEN NULL ELSE driver_number END AS driver_number
      FROM ev0)"""
CTE["coerce_strings"] = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'None' ELSE CAST(event_id % 90 AS VARCHAR) END
           AS gap_to_leader, '' AS "interval"
FROM ev0"""
CTE["calendar_filter"] = """
SELECT * FROM car_data
WHERE CAST(date AS DATE) IN (SELECT CAST(date_start AS DATE) FROM sessions)"""
CTE["session_dates"] = "SELECT DISTINCT CAST(date_start AS DATE) AS session_date FROM sessions"
CTE["time_slices"] = """
SELECT session_key, CAST(n AS INTEGER) AS slice, date_start + to_minutes(5 * n) AS slice_start,
       least(date_start + to_minutes(5 * (n + 1)), date_end) AS slice_end
FROM sessions, range(0, 864) r(n)
WHERE date_start + to_minutes(5 * n) < date_end"""
CTE["slice_rows"] = """
SELECT c.*, t.slice FROM car_data c
JOIN time_slices t
  ON c.session_key = t.session_key AND c.date BETWEEN t.slice_start AND t.slice_end"""
CTE["latest_meeting"] = """
SELECT * FROM meetings ORDER BY date_start DESC NULLS LAST, meeting_key DESC LIMIT 1"""
CTE["load_report"] = """
SELECT 'pit' AS endpoint, s.meeting_key, s.session_key,
       CASE WHEN e.session_key IS NOT NULL OR b.n IS NULL THEN 'skipped' ELSE 'success' END
           AS status,
       CASE WHEN e.session_key IS NOT NULL THEN 'data_exists' WHEN b.n IS NULL THEN 'no_data' END
           AS reason,
       CASE WHEN e.session_key IS NOT NULL OR b.n IS NULL THEN 0 ELSE b.n END AS records
FROM sessions s
LEFT JOIN (SELECT DISTINCT session_key FROM pit WHERE pit_duration > 350) e
  ON s.session_key = e.session_key
LEFT JOIN (SELECT session_key, count(*) AS n FROM pit GROUP BY 1) b
  ON s.session_key = b.session_key"""
CTE["infer_schema"] = """
SELECT CAST(event_id AS DOUBLE) AS event_id, ts AS event_date, CAST(user_id AS DOUBLE) AS user_id,
       event_type, value
FROM events"""
CTE["read_records"] = "SELECT event_id, ts AS date, event_type, value FROM events"
CTE["rejected_records"] = """
SELECT '{"event_id' AS record, 'malformed JSON' AS reason FROM events WHERE event_id % 7 = 0"""
CTE["staged_publish"] = "SELECT * FROM position"
CTE["point_lookup"] = "SELECT * FROM car_data WHERE driver_number = 55"
CTE["table_layout"] = "SELECT * FROM laps"

# ---- live path ----
CTE["payload_car"] = """
SELECT CAST(event_id AS VARCHAR) AS id, brake, drs, n_gear, rpm, speed, throttle, driver_number,
       strftime(date, '%Y-%m-%d %H:%M:%S') AS date, session_key, meeting_key
FROM car"""
CTE["format_records"] = """
SELECT date, driver_number, session_key, meeting_key,
       CAST(TRY_CAST(CASE WHEN gap_to_leader = '+1 LAP' THEN NULL ELSE gap_to_leader END AS FLOAT)
            AS DOUBLE) AS gap_to_leader,
       CAST(TRY_CAST(CASE WHEN "interval" = '+1 LAP' THEN NULL ELSE "interval" END AS FLOAT)
            AS DOUBLE) AS time_interval
FROM (SELECT * REPLACE (strftime(date, '%Y-%m-%d %H:%M:%S') AS date) FROM intervals)"""
CTE["encode_decode"] = "SELECT * FROM payload_car"
CTE["route_types"] = """
SELECT 'car' AS kind, driver_number, count(*) AS messages FROM car_data GROUP BY 2
UNION ALL SELECT 'position', driver_number, count(*) FROM position GROUP BY 2
UNION ALL SELECT 'intervals', driver_number, count(*) FROM intervals GROUP BY 2"""
CTE["replay_slice"] = """
SELECT * FROM car_data
WHERE session_key = 4 AND driver_number = 5 AND date > TIMESTAMP '2024-01-10 06:00:00.200'
  AND date < TIMESTAMP '2024-01-11 06:00:00.200'"""
CTE["stream_dedup"] = "SELECT * FROM payload_car"
CTE["stream_dedup_batches"] = "SELECT * FROM payload_car"
CTE["live_values"] = """
SELECT 'car' AS kind, event_id, event_id * 13 % 420 AS value FROM ev0
UNION ALL SELECT 'position', event_id, event_id % 20 + 1 FROM ev0 WHERE event_type IN ('click', 'view')
UNION ALL SELECT 'intervals', event_id, CASE WHEN event_id % 10 <> 1 THEN event_id % 90 END FROM ev0 WHERE event_type IN ('purchase', 'signup')
UNION ALL SELECT 'location', event_id, (event_id % 4000) / 4 FROM ev0 WHERE event_type <> 'error'"""
CTE["live_messages"] = """
SELECT kind, event_id, kind || ' ' || event_id AS id, session_key, driver_number, live_values.value,
       CASE WHEN kind = 'location' THEN ts + to_seconds(event_id % 600) ELSE ts END AS happened
FROM live_values JOIN ev0 USING (event_id)"""
CTE["live_pipeline"] = """
SELECT kind, id, driver_number, strftime(happened, '%Y-%m-%d %H:%M:%S') AS date, session_key, session_key + 1000 AS meeting_key,
       value::DOUBLE AS value
FROM live_messages"""
CTE["live_throttle"] = """
SELECT kind, id, driver_number % 3 AS driver_number, strftime(slow, '%Y-%m-%d %H:%M:%S') AS date
FROM (SELECT *, date_trunc('hour', ts) + (happened - ts) AS slow FROM live_messages JOIN (SELECT event_id, ts FROM ev0) USING (event_id))
QUALIFY date_trunc('second', slow) IS DISTINCT FROM
        lag(date_trunc('second', slow)) OVER (PARTITION BY driver_number % 3, (session_key - 1) * 3 // 10 ORDER BY slow, id)"""
CTE["bad_messages"] = """
SELECT event_id, event_id % 7 AS cut, event_id % 5 AS fault,
       '{"payload": {"id": "' || event_id || '", "position": ' || CASE WHEN event_id % 5 = 1 THEN '"first"' ELSE '1' END
       || ', "driver_number": ' || CASE WHEN event_id % 5 = 2 THEN '4.5' ELSE '7' END
       || ', "date": "2024-01-01 00:00:00", "session_key": 1, "meeting_key": '
       || CASE WHEN event_id % 5 = 3 THEN '3000000000' ELSE '1001' END || '}}' AS message
FROM ev0 WHERE event_type = 'signup'"""
CTE["rejected_fields"] = """
SELECT CASE cut WHEN 1 THEN left(message, 20) WHEN 2 THEN '{"schema": {}}' ELSE message END AS record,
       CASE WHEN cut = 1 THEN 'malformed JSON' WHEN cut = 2 THEN 'no payload'
            WHEN fault = 1 THEN 'position: int wanted, found STRING'
            WHEN fault = 2 THEN 'driver_number: int wanted, found DECIMAL(2,1)'
            WHEN fault = 3 THEN 'meeting_key: int wanted, found BIGINT' END AS reason
FROM bad_messages WHERE cut IN (1, 2) OR cut <> 3 AND fault IN (1, 2, 3)"""
CTE["live_rejects"] = """
SELECT * FROM rejected_fields
UNION ALL SELECT '{"payload": {"id": "a", "driver_number": 1}}', 'no kind' FROM bad_messages WHERE cut = 3"""
CTE["rejected_numbers"] = """
SELECT 'speed' AS field, 'fast' AS value FROM ev0 WHERE event_id % 13 = 0
UNION ALL SELECT 'rpm', '1e99' FROM ev0 WHERE event_id % 19 = 0"""
CTE["stream_throttle"] = """
SELECT event_id, driver_number, date
FROM (SELECT event_id, driver_number % 3 AS driver_number, date_trunc('hour', ts) AS date FROM ev0)
QUALIFY date IS DISTINCT FROM lag(date) OVER (PARTITION BY driver_number ORDER BY date, event_id)"""
CTE["throttle_batch"] = CTE["stream_throttle"]
CTE["stream_throttle_state"] = CTE["stream_throttle"]
CTE["stream_counts"] = """
SELECT event_type AS kind, driver_number, count(*) AS messages FROM ev0 GROUP BY 1, 2"""
CTE["stream_sink"] = "SELECT * FROM payload_car"
CTE["stream_load_metrics"] = """
SELECT event_type AS kind, 'success' AS status, CAST(NULL AS VARCHAR) AS error,
       CAST(count(*) + count(*) FILTER (WHERE value > 100) AS BIGINT) AS records_processed,
       count(*) AS records_inserted
FROM ev0 GROUP BY 1"""

_NAMES = re.compile(r"[a-z_0-9]+")


def _needs(name: str, seen: list[str]) -> list[str]:
    for word in dict.fromkeys(_NAMES.findall(CTE[name])):
        if word in CTE and word != name and word not in seen and _reads(CTE[name], word):
            _needs(word, seen)
    if name not in seen:
        seen.append(name)
    return seen


def _reads(text: str, name: str) -> bool:
    return re.search(rf"(FROM|JOIN)\s+{name}\b", text) is not None


def sql(name: str) -> str:
    """The SELECT of one query with the common table expressions it reads."""
    order = _needs(name, [])
    head = ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in order)
    return f"WITH {head}\nSELECT * FROM {name}"
