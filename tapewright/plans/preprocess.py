"""Stored events to deduplicated trades and quotes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.operators.delivery import latest_delivery
from tapewright.operators.selection import drop_bad, split_quotes, split_trades
from tapewright.plans.counting import ROWS, Counts
from tapewright.schema import QUOTE, TRADE
from tapewright.sources.tables import read_events, read_quotes, read_trades, write_by_day


def preprocess(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trades and quotes, each with its latest delivery only.

    The partition is fixed before the dedupe, so each branch reads one folder of the event table
    and only the columns its layout has.
    """
    good = drop_bad(events)
    trades = latest_delivery(split_trades(good.filter(F.col("partition") == TRADE)))
    quotes = latest_delivery(split_quotes(good.filter(F.col("partition") == QUOTE)))
    return trades, quotes


def run_preprocess(
    spark: SparkSession,
    source: str,
    target: str,
    files: int | None = None,
    only_days_present: bool = False,
) -> Mapping[str, int]:
    """Store ``trade`` and ``quote`` under ``target``, by day, from the events under ``source``.

    Returns the number of ``trades_read`` and ``quotes_read`` (all deliveries) and of ``trades`` and
    ``quotes`` stored, counted on the way.
    """
    counts = Counts()
    for kind, name, split in _TABLES:
        read = split(drop_bad(read_events(spark, source, [kind])))
        latest = latest_delivery(counts.of(read, **{f"{name}s_read": ROWS}))
        write_by_day(
            latest, f"{target}/{name}", files, only_days_present,
            last=lambda df, name=name: counts.of(df, **{f"{name}s": ROWS}),
        )
    return counts.taken()


def run_late_deliveries(
    spark: SparkSession, source: str, target: str, files: int | None = None
) -> Mapping[str, int]:
    """Bring the events under ``source``, which arrived later, into the tables stored under ``target``.

    Only the days that the new events belong to are read and written: their stored rows are ranked
    again together with the new ones, and each of those days is replaced by the result. Other days
    are not touched. Two runs, the second over the late events alone, store what one run over all of
    them would; running the same late events again changes nothing. Days are replaced one after the
    other when the write commits, so a reader may meet some days before and some after.

    Returns the number of ``trades_read`` and ``quotes_read`` (new deliveries) and of ``trades`` and
    ``quotes`` stored in the days touched.
    """
    counts = Counts()
    for kind, name, split in _TABLES:
        path = f"{target}/{name}"
        new = split(drop_bad(read_events(spark, source, [kind])))
        # one row for each day of the late events: the folders to read and to replace
        days = [row["trade_dt"] for row in new.select("trade_dt").distinct().collect()]
        stored = (read_trades if kind == TRADE else read_quotes)(spark, path)
        stored = stored.where(F.col("trade_dt").isin(days)) if days else stored.limit(0)
        new = counts.of(new, **{f"{name}s_read": ROWS})
        write_by_day(
            latest_delivery(stored.unionByName(new)), path, files, only_days_present=True,
            last=lambda df, name=name: counts.of(df, **{f"{name}s": ROWS}),
        )
    return counts.taken()


_TABLES = ((TRADE, "trade", split_trades), (QUOTE, "quote", split_quotes))
