from lapframe.quality.checks import (  # noqa: F401
    Check,
    accepted_values,
    not_null,
    range_check,
    range_violation_count,
    relationships,
    run_checks,
    sustained,
    unique,
)
from lapframe.quality.suite import SUITE, run_suite  # noqa: F401
