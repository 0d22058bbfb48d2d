"""Sources and sinks."""

from tapewright.sources.lines import read_raw_lines
from tapewright.sources.tables import (
    read_enriched,
    read_events,
    read_quotes,
    read_trades,
    write_by_day,
    write_events,
)

__all__ = [
    "read_enriched",
    "read_events",
    "read_quotes",
    "read_raw_lines",
    "read_trades",
    "write_by_day",
    "write_events",
]
