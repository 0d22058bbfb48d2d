"""Keep the latest delivery of each event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.schema import DELIVERY_KEYS

_TIE_BREAK = ("trade_pr", "bid_pr", "bid_size", "ask_pr", "ask_size")


def latest_delivery(events: DataFrame) -> DataFrame:
    """One row for each delivery key: the one that arrived last.

    Equal arrival times are settled by the greater prices and sizes, so the result depends on the
    data alone. It is one aggregate, the greatest of (arrival, prices, sizes): a task sends at most
    one row of each key to the shuffle, however many copies it reads.
    """
    others = [c for c in events.columns if c not in DELIVERY_KEYS]
    ranking = ["arrival_tm", *[c for c in _TIE_BREAK if c in others]]
    ranking += [c for c in others if c not in ranking]
    latest = F.max(F.struct(*ranking)).alias("_latest")
    return (
        events.groupBy(*DELIVERY_KEYS)
        .agg(latest)
        .select(*DELIVERY_KEYS, "_latest.*")
        .select(*events.columns)
    )
