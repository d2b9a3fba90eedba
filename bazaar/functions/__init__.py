"""Column helpers with pinned semantics (types, rounding, NULL handling)."""

from bazaar.functions.numeric import (
    count_where,
    decimal_avg,
    double_avg,
    double_sum,
    money_sum,
    ratio_pct,
    round2,
)
from bazaar.functions.temporal import hour_boundaries_between, minus_days
from bazaar.functions.text import normalized

__all__ = [
    "count_where",
    "decimal_avg",
    "double_avg",
    "double_sum",
    "money_sum",
    "ratio_pct",
    "round2",
    "hour_boundaries_between",
    "minus_days",
    "normalized",
]
