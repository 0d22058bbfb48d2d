"""Filters, projections, counts and previews over event, trade and quote tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.schema import BAD, QUOTE, QUOTE_COLUMNS, TRADE, TRADE_COLUMNS


def as_date(date: str | dt.date) -> dt.date:
    if isinstance(date, dt.datetime):
        return date.date()
    return date if isinstance(date, dt.date) else dt.date.fromisoformat(date)


def drop_bad(events: DataFrame) -> DataFrame:
    """Events without the bad lines. A null partition is dropped too."""
    return events.filter(F.col("partition") != BAD)


def project_trades(events: DataFrame) -> DataFrame:
    """The seven columns that describe a trade, for every event."""
    return events.select(*[c for c in TRADE_COLUMNS if c not in ("rec_type", "partition")])


def split_trades(events: DataFrame) -> DataFrame:
    return events.filter(F.col("rec_type") == TRADE).select(*TRADE_COLUMNS)


def split_quotes(events: DataFrame) -> DataFrame:
    return events.filter(F.col("rec_type") == QUOTE).select(*QUOTE_COLUMNS)


def previous_day(date: str | dt.date) -> dt.date:
    """The calendar day before, which on a Monday has no trades."""
    return as_date(date) - dt.timedelta(days=1)


def day_slice(df: DataFrame, date: str | dt.date) -> DataFrame:
    """Rows of one trading day; prunes the folders of a table stored by day."""
    return df.filter(F.col("trade_dt") == F.lit(as_date(date)))


def lookup_symbols(df: DataFrame, symbols: Iterable[str]) -> DataFrame:
    """Rows of the chosen symbols, sorted by symbol and exchange."""
    return df.filter(F.col("symbol").isin(list(symbols))).orderBy("symbol", "exchange")


def event_counts(events: DataFrame) -> DataFrame:
    """Number of events in each partition."""
    return events.groupBy("partition").agg(F.count(F.lit(1)).alias("events"))


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 100) -> DataFrame:
    """The first ``n`` rows in ``order``: each task keeps its own ``n``, nothing is fully sorted."""
    return df.orderBy(*order).limit(n)
