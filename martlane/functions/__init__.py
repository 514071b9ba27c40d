"""Column-level building blocks (pure ``Column -> Column`` functions)."""

from martlane.functions.text import (
    normalize_column_name,
    normalize_flag,
    normalize_space,
    fill_postal,
    strip_ws,
)
from martlane.functions.dates import coerce_date, serial_to_timestamp
from martlane.functions.numeric import (
    as_double,
    null_out_of_range,
    pct,
    profit_margin,
    ratio,
    round_half_away,
    to_money,
)

__all__ = [
    "as_double",
    "coerce_date",
    "fill_postal",
    "normalize_column_name",
    "normalize_flag",
    "normalize_space",
    "null_out_of_range",
    "pct",
    "profit_margin",
    "ratio",
    "round_half_away",
    "serial_to_timestamp",
    "strip_ws",
    "to_money",
]
