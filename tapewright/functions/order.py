"""Orders of rows as single numbers, so that the greatest is found by a hash aggregate.

An order by several columns would be a struct, which Spark aggregates only after a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapewright.functions.timegrid import micros

_BELOW_INT = 2_147_483_649


def _sequence(name: str) -> Column:
    """From 1 on; 0 where the number is unknown."""
    known = F.col(name).cast("decimal(10,0)") + F.lit(_BELOW_INT).cast("decimal(10,0)")
    return F.coalesce(known.cast("decimal(10,0)"), F.lit(0).cast("decimal(10,0)"))


def _settled(values: Sequence[str], width: int) -> Column:
    """A number below 10**width that tells rows of other values apart, for ties."""
    number = F.pmod(F.xxhash64(*values), F.lit(10**width)) if values else F.lit(0)
    return number.cast(f"decimal({width},0)")


def _shifted(number: Column, width: int) -> Column:
    return number * F.lit(10**width).cast(f"decimal({width + 1},0)")


def sequence_order(values: Sequence[str], sequence: str = "event_seq_nb") -> Column:
    """By sequence number, an unknown one first; ties are settled by the values alone."""
    number = F.coalesce(F.col(sequence).cast("long") + F.lit(_BELOW_INT), F.lit(0).cast("long"))
    settled = F.pmod(F.xxhash64(*values), F.lit(1 << 30)) if values else F.lit(0).cast("long")
    return F.shiftleft(number, 30).bitwiseOR(settled)


def moment_order(time: str, order: Column) -> Column:
    """By time, an unknown one first, then by ``order``, a number of :func:`sequence_order`."""
    at = F.coalesce((micros(time) + 1).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    later = F.lit(1 << 62).cast("decimal(19,0)")
    return ((at * later).cast("decimal(37,0)") + order.cast("decimal(19,0)")).cast("decimal(38,0)")


def instant_order(time: str, values: Sequence[str], sequence: str = "event_seq_nb") -> Column:
    """By time, an unknown one first, then by sequence number; ties are settled by the values."""
    at = F.coalesce((micros(time) + 1).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    moment = (_shifted(at, 10) + _sequence(sequence)).cast("decimal(28,0)")
    return (_shifted(moment, 10).cast("decimal(38,0)") + _settled(values, 10)).cast("decimal(38,0)")
