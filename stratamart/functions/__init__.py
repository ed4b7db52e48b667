"""Column helpers shared by every job. All are built-in expressions; none is a Python UDF."""

from stratamart.functions.keys import in_key_slice, line_key
from stratamart.functions.numbers import exact_mean, exact_sum, flag_sum, nz, pct, ratio, rounded_sum
from stratamart.functions.text import code, mixed_case, parse_date, parse_number, parse_timestamp, tidy

__all__ = [
    "code", "exact_mean", "exact_sum", "flag_sum", "in_key_slice", "line_key", "mixed_case", "nz",
    "parse_date", "parse_number", "parse_timestamp", "pct", "ratio", "rounded_sum", "tidy",
]
