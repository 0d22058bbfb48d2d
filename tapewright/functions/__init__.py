"""Column expressions shared by the operators."""

from tapewright.functions.text import (
    clock_time,
    decimal_price,
    is_json_line,
    is_one_object,
    json_doubtful,
    json_price,
    json_record,
    json_texts,
    plain_date,
    whole_number,
)
from tapewright.functions.timegrid import DAY_SECONDS, SLOT_SECONDS, exact_mean, seconds, time_slot

__all__ = [
    "DAY_SECONDS",
    "SLOT_SECONDS",
    "clock_time",
    "decimal_price",
    "exact_mean",
    "is_json_line",
    "is_one_object",
    "json_doubtful",
    "json_price",
    "json_record",
    "json_texts",
    "plain_date",
    "seconds",
    "time_slot",
    "whole_number",
]
