"""Time slots, and exact means over decimal sums.

A slot is a fixed stretch of time. Operators that follow a series through time split it into
slots, so that a series holding a large share of all rows is still spread over many tasks. A slot
of ten seconds has at most ten million distinct microseconds, and a day has 8,640 slots: both levels
of such an operator are bounded whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

SLOT_SECONDS = 10
DAY_SECONDS = 86_400

# Before every time the feed can hold, so that slots count upward from zero without a sign change.
_ORIGIN = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"


def seconds(n: int) -> Column:
    return F.expr(f"INTERVAL '{int(n)}' SECOND")


def time_slot(time: str, width: int = SLOT_SECONDS) -> Column:
    """Number of the slot of ``width`` seconds that holds ``time`` (a column name)."""
    return F.expr(f"(`{time}` - {_ORIGIN}) DIV INTERVAL '{int(width)}' SECOND")


def micros(time: str) -> Column:
    """``time`` (a column name) in microseconds since the year 1."""
    return F.expr(f"(`{time}` - {_ORIGIN}) DIV INTERVAL '0.000001' SECOND")


def exact_mean(total: Column, count: Column, value_type: DataType) -> Column:
    """Mean with the result type AVG gives for ``value_type``, null where the count is zero."""
    if isinstance(value_type, DecimalType):
        p, s = value_type.precision, value_type.scale
        total = total.cast(DecimalType(min(p + 10, 38), s))
        result = DecimalType(min(p + 4, 38), min(s + 4, 38))
        mean = (total / count.cast(DecimalType(20, 0))).cast(result)
    else:
        mean = total.cast("double") / count
    return F.when(count > 0, mean)
