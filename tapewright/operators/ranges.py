"""Time ranges of about equal numbers of rows, for following series of any size.

The rows of all series together are cut into ranges of time by quantiles. A series in a range, a
cell, is one piece of work, which holds at most the range's rows: a fair share of the table, however
large the series is, and with no need to know which series are large. What a cell must know of the
ranges before it comes from a carry table of one row per cell, reduced within tasks before its
shuffle; followed through the ranges it gives each cell its opening values. A series has at most
``MAX_RANGES`` rows there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.functions.timegrid import micros

RANGE = "_range"
RANGE_ROWS = 1_000_000
MAX_RANGES = 1_000
# Quantiles are right to one in so many of all rows.
ACCURACY = 10_000


class Ranges:
    """``starts``: where all ranges but the first begin, in microseconds, rising."""

    def __init__(self, starts: Sequence[int] = ()) -> None:
        self.starts = sorted(set(starts))

    @classmethod
    def measured(cls, *tables: DataFrame, time: str = "event_tm", rows: int = RANGE_ROWS) -> Ranges:
        """Ranges of about ``rows`` rows, or ``MAX_RANGES`` larger ones.

        One job over the time column alone, reduced in tasks to a sketch; nothing is shuffled by
        key. The quantiles need not be exact, as any ranges give the same results.
        """
        times = reduce(DataFrame.union, [t.select(micros(time).alias("at")) for t in tables])
        shares = [i / MAX_RANGES for i in range(1, MAX_RANGES)]
        found = times.agg(
            F.count("at").alias("n"), F.percentile_approx("at", shares, ACCURACY).alias("quantiles")
        ).first()
        n = min(MAX_RANGES, -(-found["n"] // rows))
        return cls([found["quantiles"][i * MAX_RANGES // n - 1] for i in range(1, n)])

    def of(self, time: str = "event_tm") -> Column:
        """Number of the range of a time, 0 where it is unknown; by binary search."""
        n = len(self.starts)
        if not n:
            return F.lit(0)
        starts = F.array(*map(F.lit, self.starts))
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])

        def forth(at: Column, step: Column) -> Column:
            begun = F.get(starts, at + step - 1) <= micros(time)
            return F.when((at + step <= n) & begun, at + step).otherwise(at)

        return F.aggregate(steps, F.lit(0), forth)


def openings(
    cells: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), lasts: Sequence[str] = ()
) -> DataFrame:
    """What the ranges before hold for each cell, of ``asked`` cells to which they hold anything.

    ``cells`` has one row for each (keys, range) with a flag ``asked``. The columns in ``sums`` add
    up over the ranges before; of those in ``lasts`` the last known one is taken.
    """
    before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    opened = cells.select(
        *keys,
        RANGE,
        "asked",
        *[F.sum(name).over(before).alias(name) for name in sums],
        *[F.last(name, ignorenulls=True).over(before).alias(name) for name in lasts],
    )
    return opened.where("asked").drop("asked").dropna("all", subset=[*sums, *lasts])
