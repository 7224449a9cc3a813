from lapframe.functions.expr import (  # noqa: F401
    add_whole_seconds,
    bracket_label,
    case_lookup,
    millis_between,
    nulls_high,
    numeric_gap,
    points_for,
    seconds_between,
    session_label,
)
