"""Splitting work by how many rows a series holds.

Following a series through time needs its rows side by side. A series of up to ``SPLIT_ROWS`` rows
is small enough for one task: it takes one shuffle by series and one sort. Busier series are
worked on in time slots instead, at the price of more shuffles.

Which of the two a table needs is measured first: one job counts the rows of each series (reading
the key columns only, reduced in each task) and brings a single row to the driver. Where no series
is busy, which is the usual case, the slot branch is not planned at all. Otherwise the busy series
are separated by joins with their list, of at most (all rows / ``SPLIT_ROWS``) keys; the same job
counts them, and only a list of up to ``BROADCAST_KEYS`` is broadcast. Both branches give the same result, so a series may be
counted as busy or not as one likes.

One :class:`Load` can be measured from stored tables and given to every operator over them;
``Load.light`` says without any job that no series is busy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLIT_ROWS = 1_000_000
BROADCAST_KEYS = 1_000_000


def _all_known(columns: Sequence[str]) -> str:
    return " AND ".join(f"`{c}` IS NOT NULL" for c in columns)


def with_known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have all of ``columns``. As in a join, a null key or time matches nothing."""
    return df.filter(_all_known(columns))


def with_unknown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(f"NOT ({_all_known(columns)})")


class Load:
    """How many rows each series of some tables holds, measured when constructed."""

    def __init__(self, keys: Sequence[str], split_rows: int, *tables: DataFrame) -> None:
        self.keys = list(keys)
        rows = reduce(DataFrame.union, [t.select(*self.keys) for t in tables])
        counts = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("rows"))
        known = F.expr(_all_known(self.keys))
        measured = counts.agg(
            F.count(F.when(known & (F.col("rows") > split_rows), 1)).alias("busy"),
        ).first()
        self._has_busy = measured["busy"] > 0
        self._busy = counts.filter(known & (F.col("rows") > split_rows)).select(*self.keys)
        if measured["busy"] <= BROADCAST_KEYS:
            self._busy = F.broadcast(self._busy)
        else:
            # The branches meet in a union. Where adaptive execution turns one of their joins by
            # key into a broadcast, the union must not pass for partitioned by that key.
            tables[0].sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")

    @classmethod
    def light(cls, keys: Sequence[str]) -> Load:
        """No series is busy; nothing is measured."""
        load = cls.__new__(cls)
        load.keys, load._has_busy, load._busy = list(keys), False, None
        return load

    def apply(
        self,
        tables: Sequence[DataFrame],
        ordinary: Callable[..., DataFrame],
        busy: Callable[..., DataFrame],
        unknown: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> DataFrame:
        """Union of ``ordinary`` and ``busy`` over the rows with known keys of ``tables``, each
        given its share, and of ``unknown`` over the first table's rows without known keys."""
        known = [with_known(t, self.keys) for t in tables]
        if not self._has_busy:
            result = ordinary(*known)
        else:
            result = ordinary(
                *[t.join(self._busy, self.keys, "left_anti") for t in known]
            ).unionByName(busy(*[t.join(self._busy, self.keys, "left_semi") for t in known]))
        if not any(tables[0].schema[k].nullable for k in self.keys):
            return result
        rest = unknown(with_unknown(tables[0], self.keys))
        return result.unionByName(rest, allowMissingColumns=True)
