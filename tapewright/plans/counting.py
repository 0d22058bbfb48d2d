"""Row counts taken while a step writes its rows, at no job of their own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The condition that every row meets.
ROWS = True


class Counts:
    """Counts of named conditions over the frames that pass through :meth:`of`.

    Rows are counted where they pass. A frame is to be counted once, as the last thing before its
    write (then the counts are those of the rows written) or right behind its scan; a task that runs
    again after a failure may be counted again in the latter case. ``taken`` waits for the writes.
    """

    def __init__(self) -> None:
        self._observed: list[tuple[Observation, list[str]]] = []

    def of(self, df: DataFrame, **conditions: Column | bool) -> DataFrame:
        """``df``, with the number of its rows that meet each condition taken in passing."""
        seen = Observation()
        self._observed.append((seen, list(conditions)))
        return df.observe(
            seen,
            *[
                F.count(F.lit(1) if meets is ROWS else F.when(meets, 1)).alias(name)
                for name, meets in conditions.items()
            ],
        )

    def taken(self) -> Mapping[str, int]:
        return {name: seen.get[name] for seen, names in self._observed for name in names}
