from lapframe.operators.burst import sustained_burst  # noqa: F401
from lapframe.operators.carry import fill_forward, previous_value  # noqa: F401
from lapframe.operators.intervals import (  # noqa: F401
    interval_join,
    interval_matches,
    nearest_event_in_interval,
    range_aggregate,
)
from lapframe.operators.keys import same_keys  # noqa: F401
from lapframe.operators.ranking import (  # noqa: F401
    dense_levels,
    dense_rank_by,
    first_per_key,
    join_levels,
    latest_per_key,
    numbered,
)
