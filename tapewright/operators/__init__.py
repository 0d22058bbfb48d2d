"""Operators: functions from DataFrame to DataFrame."""

from tapewright.operators.asof import asof_last_trade
from tapewright.operators.closing import closing_price, price_moves
from tapewright.operators.delivery import latest_delivery
from tapewright.operators.history import first_status, job_report, recent_status
from tapewright.operators.pairing import range_join
from tapewright.operators.parsing import parse_events
from tapewright.operators.rolling import leading_avg, range_stats, trailing_avg
from tapewright.operators.selection import (
    day_slice,
    drop_bad,
    event_counts,
    lookup_symbols,
    preview,
    previous_day,
    project_trades,
    split_quotes,
    split_trades,
)

__all__ = [
    "asof_last_trade",
    "closing_price",
    "day_slice",
    "drop_bad",
    "event_counts",
    "first_status",
    "job_report",
    "latest_delivery",
    "leading_avg",
    "lookup_symbols",
    "parse_events",
    "preview",
    "previous_day",
    "price_moves",
    "project_trades",
    "range_join",
    "range_stats",
    "recent_status",
    "split_quotes",
    "split_trades",
    "trailing_avg",
]
