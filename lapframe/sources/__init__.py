from lapframe.sources.calendar import (  # noqa: F401
    filter_session_days,
    latest_meeting,
    meetings_by_start,
    session_dates,
    slice_rows,
    time_slices,
)
from lapframe.sources.records import (  # noqa: F401
    coerce_to_string,
    infer_schema,
    normalize_columns,
    only_new,
    read_records,
    rejected_records,
    require_fields,
)
from lapframe.sources.tables import load_sources, register_views  # noqa: F401
