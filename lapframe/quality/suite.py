"""The checks declared for each raw table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.quality.checks import (
    Check,
    accepted_values,
    not_null,
    range_check,
    relationships,
    run_checks,
    sustained,
    unique,
)
from lapframe.schemas import COMPOUNDS, DRS_CODES


def _required(*columns: str) -> list[Check]:
    return [not_null(c) for c in columns]


# Sensor and domain limits.
RPM = range_check("rpm", 0, 15000, name="rpm_range")
SPEED = range_check("speed", 0, 410, name="speed_range")
THROTTLE = range_check("throttle", 0, 110, name="throttle_range")
BRAKE = range_check("brake", 0, 100, name="brake_range")
VALID_DRS = accepted_values("drs", DRS_CODES, name="valid_drs")


def pedal_overlap(
    brake: int = 105, throttle: int = 105, speed: int = 50, rpm: int = 5000, gap_ms: int = 500
) -> Check:
    """Brake and throttle both very high at speed, for more than one reading in a row."""
    return sustained(
        "brake_throttle_combination",
        lambda: (F.col("brake") > brake)
        & (F.col("throttle") > throttle)
        & (F.col("speed") > speed)
        & (F.col("rpm") > rpm),
        "date",
        gap_ms,
    )


SUITE: dict[str, list[Check]] = {
    "position": _required("date", "driver_number", "meeting_key", "position", "session_key"),
    "laps": _required("driver_number", "lap_number"),
    "car_data": [
        *_required("date", "driver_number", "drs", "rpm", "speed", "throttle"),
        relationships("driver_number", "drivers", "driver_number"),
        VALID_DRS, RPM, SPEED, THROTTLE,
        pedal_overlap(),
    ],
    "intervals": _required("date", "driver_number", "session_key"),
    "pit": _required("date", "driver_number", "lap_number"),
    "meetings": _required(
        "circuit_key", "circuit_short_name", "country_name", "date_start", "meeting_name", "year"
    ),
    "sessions": [
        *_required("session_key", "meeting_key", "session_name", "session_type"),
        unique("session_key"),
    ],
    "drivers": _required("driver_number", "broadcast_name", "full_name", "name_acronym"),
    "stints": [
        # the condition admits accepted values only, so this one cannot fail
        accepted_values(
            "compound",
            COMPOUNDS,
            where="compound IS NULL OR compound IN ('"
            + "', '".join(COMPOUNDS) + "')",
        ),
        not_null("driver_number", where="driver_number != 0"),
        relationships("driver_number", "drivers", "driver_number", "driver_number is not null"),
        *_required("lap_start", "lap_end", "stint_number"),
        range_check("lap_start", 1, 71),
        range_check("lap_end", 0, 79),
        range_check("stint_number", 1, 9),
        not_null("tyre_age_at_start", where="tyre_age_at_start is not null"),
        range_check("tyre_age_at_start", 0, 28),
    ],
}


def run_suite(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The report of every declared check over the tables given."""
    return reduce(
        DataFrame.unionByName,
        [run_checks(tables[t], checks, tables, t) for t, checks in SUITE.items() if t in tables],
    )
