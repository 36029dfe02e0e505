"""Column expressions shared by batch and streaming plans."""

from hostvigil.functions.columns import (
    alert_label,
    clock_of,
    day_second,
    finite_number,
    is_finite,
    is_number_text,
    round_half_up,
    second_of_day,
    time_of_day,
)
from hostvigil.functions.records import encode_record, may_hold_more, one_value, parse_value

__all__ = [
    "alert_label",
    "clock_of",
    "day_second",
    "encode_record",
    "finite_number",
    "is_finite",
    "is_number_text",
    "may_hold_more",
    "one_value",
    "parse_value",
    "round_half_up",
    "second_of_day",
    "time_of_day",
]
