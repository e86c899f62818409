"""Column-level building blocks (no I/O, no UDFs)."""

from growthloom.functions.periods import (  # noqa: F401
    ENGAGEMENT_TYPES,
    GRAINS,
    engagement_bucket,
    engagement_types,
    period_from_index,
    period_index,
    period_start,
)
from growthloom.functions.picks import (  # noqa: F401
    any_value_det,
    approx_top_value,
    first_by_time,
    flag_any,
    most_frequent,
    most_frequent_with_null,
)
