"""Column expressions shared by the jobs (all JVM-side built-ins)."""

from fieldnotes.functions.arith import integer_delta, null_safe_ratio, zero_guarded_ratio
from fieldnotes.functions.arrays import array_get, coordinates, parse_int_array, split_text
from fieldnotes.functions.keys import row_id, surrogate_key
from fieldnotes.functions.calendar import (
    day_of_week_name,
    day_of_week_sunday0,
    month_key,
    ts_trunc_day,
    week_start_sunday,
)

__all__ = [
    "array_get", "coordinates", "day_of_week_name", "day_of_week_sunday0",
    "integer_delta", "month_key", "null_safe_ratio", "parse_int_array", "row_id",
    "split_text", "surrogate_key", "ts_trunc_day", "week_start_sunday", "zero_guarded_ratio",
]
