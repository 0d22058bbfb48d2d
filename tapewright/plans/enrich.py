"""Quotes with last trade, its trailing average, and the move against the day-before close."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.functions.order import sequence_order
from tapewright.functions.timegrid import seconds
from tapewright.operators.asof import (
    CARRIED,
    LEFT,
    QUOTED,
    TRADED,
    carry_last,
    in_ranges,
    last_of_instant,
    one_per_instant,
    time_order,
)
from tapewright.operators.closing import add_moves, closing_price
from tapewright.operators.rolling import (
    average,
    entering_and_leaving,
    rolling_in_ranges,
    rolling_instants,
)
from tapewright.operators.ranges import RANGE_ROWS, Ranges
from tapewright.operators.selection import day_slice, previous_day
from tapewright.operators.series import Load, with_known
from tapewright.plans.counting import ROWS, Counts
from tapewright.schema import DAY_SERIES, ENRICHED_SCHEMA, PRICE, QUOTE_VALUES
from tapewright.sources.tables import read_quotes, read_trades, write_by_day

_AT = (*DAY_SERIES, "event_tm")
_LAST_TRADE = {"trade_pr": "last_trade_pr", "mov_avg_trade_pr": "last_mov_avg_pr"}
_ENRICHED = (*_AT, "event_seq_nb", *QUOTE_VALUES, *_LAST_TRADE.values(), "close_pr")


def _ordinary(
    quotes: DataFrame, trades: DataFrame, close: DataFrame, minutes: int, keep_all_quotes: bool
) -> DataFrame:
    """All three lookups in one time order of quotes, trades and the opening close.

    One shuffle by series and one sort: the running sum gives the average at each trade, and the
    last trade and the close are carried to the quotes after them. Of trades at one instant the
    last in order is carried, whose sum takes in the whole instant.
    """
    trade_rows = entering_and_leaving(
        trades.select(*_AT, "trade_pr", sequence_order(["trade_pr"]).alias("_order")),
        F.when(F.col("trade_pr").isNotNull(), 1).otherwise(0),
        F.col("trade_pr"),
        DAY_SERIES,
        "event_tm",
        seconds(minutes * 60),
        (TRADED, LEFT),
    )
    rows = (
        quotes.withColumns({"_step": F.lit(QUOTED), "_order": sequence_order(QUOTE_VALUES)})
        .unionByName(trade_rows, allowMissingColumns=True)
        .unionByName(close.withColumn("_step", F.lit(CARRIED)), allowMissingColumns=True)
    )
    order = ("_step", "_order")
    so_far = time_order(DAY_SERIES, *order)
    chosen = F.lit(True) if keep_all_quotes else last_of_instant(DAY_SERIES, *order)
    summed = rows.withColumns(
        {
            "_n": F.sum("_n").over(so_far),
            "_total": F.sum("_total").over(so_far),
            "close_pr": F.last("close_pr", ignorenulls=True).over(so_far),
            "_chosen": chosen,
        }
    )
    trade = F.struct(
        F.col("trade_pr").alias("last_trade_pr"), average(PRICE).alias("last_mov_avg_pr")
    )
    carried = F.last(F.when(F.col("_step") == TRADED, trade), ignorenulls=True)
    return (
        summed.withColumn("_trade", carried.over(so_far))
        .filter((F.col("_step") == QUOTED) & F.col("_chosen"))
        .select("*", "_trade.*")
        .select(*_ENRICHED)
    )


def _in_ranges(
    quotes: DataFrame,
    trades: DataFrame,
    close: DataFrame,
    minutes: int,
    keep_all_quotes: bool,
    ranges: Ranges,
) -> DataFrame:
    """The same by time ranges: averages at the trades first, which the quotes then look up."""
    own = trades.select(*_AT, "event_seq_nb", "trade_pr")
    averaged = rolling_in_ranges(own, "trade_pr", DAY_SERIES, ranges, minutes=minutes).withColumn(
        "mov_avg_trade_pr", average(PRICE)
    )
    found = in_ranges(
        quotes, averaged, DAY_SERIES, _LAST_TRADE, keep_all_quotes, ranges, ["trade_pr"], close
    )
    return found.select(*_ENRICHED)


def _busy(
    quotes: DataFrame, trades: DataFrame, close: DataFrame, minutes: int, keep_all_quotes: bool
) -> DataFrame:
    """The same in time slots, for series of any size."""
    instants = rolling_instants(
        trades,
        "trade_pr",
        DAY_SERIES,
        minutes=minutes,
        also=[F.max_by("trade_pr", sequence_order(["trade_pr"])).alias("trade_pr")],
    ).withColumn("mov_avg_trade_pr", average(PRICE))
    asked = (
        quotes.select(*_AT).distinct()
        if keep_all_quotes
        else one_per_instant(quotes, DAY_SERIES, QUOTE_VALUES)
    )
    found = carry_last(asked, instants, DAY_SERIES, _LAST_TRADE, opening=close)
    if keep_all_quotes:
        same = [quotes[c] == found[c] for c in DAY_SERIES]
        same.append(quotes["event_tm"].eqNullSafe(found["event_tm"]))
        found = quotes.join(found, same, "left").drop(*[found[c] for c in _AT])
    return found.select(*_ENRICHED)


def enrich_quotes(
    trades: DataFrame,
    quotes: DataFrame,
    date: str | dt.date | None = None,
    minutes: int = 30,
    keep_all_quotes: bool = False,
    split_rows: int | None = None,
    load: Load | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Enriched quotes of ``date``, or of every day at once where no date is given.

    Trades and quotes are taken as deduplicated. The last trade and its average never cross
    midnight; the close is that of the calendar day before (also for a quote without a time). Quotes at one instant of a series
    become one row unless ``keep_all_quotes``. No step joins the quotes to anything: last trade,
    average and close are all carried forward in time order. Tables of more than ``range_rows`` rows
    are followed through time ranges of about that many, so that no series is too large for its
    task. With ``split_rows`` or a ``load`` (of trading day, symbol and exchange), the series that
    are busy by these are worked on in time slots instead, and the others whole.
    """
    closing_trades = trades
    if date is not None:
        closing_trades = day_slice(trades, previous_day(date))
        trades = day_slice(trades, date)
        quotes = day_slice(quotes, date)
    close = closing_price(with_known(closing_trades, DAY_SERIES), DAY_SERIES).withColumn(
        "trade_dt", F.date_add("trade_dt", 1)
    )
    quotes = quotes.select(*_AT, "event_seq_nb", *QUOTE_VALUES)

    def ordinary(quotes: DataFrame, trades: DataFrame) -> DataFrame:
        if ranges.starts:
            return _in_ranges(quotes, trades, close, minutes, keep_all_quotes, ranges)
        return _ordinary(quotes, trades, close, minutes, keep_all_quotes)

    def busy(quotes: DataFrame, trades: DataFrame) -> DataFrame:
        return _busy(quotes, trades, close, minutes, keep_all_quotes)

    def unknown(quotes: DataFrame) -> DataFrame:
        return quotes if keep_all_quotes else one_per_instant(quotes, DAY_SERIES, QUOTE_VALUES)

    trades = with_known(trades, ["event_tm"])
    ranges = Ranges()
    if load is None and split_rows is None:
        ranges, load = Ranges.measured(quotes, trades, rows=range_rows), Load.light(DAY_SERIES)
    load = load or Load(DAY_SERIES, split_rows, quotes, trades)
    joined = load.apply([quotes, trades], ordinary, busy, unknown)
    return add_moves(joined).select(*ENRICHED_SCHEMA.names)


def run_enrich(
    spark: SparkSession,
    source: str,
    target: str,
    date: str | dt.date | None = None,
    files: int | None = None,
    only_days_present: bool = False,
    minutes: int = 30,
    keep_all_quotes: bool = False,
) -> Mapping[str, int]:
    """Store enriched quotes under ``target`` from the ``trade`` and ``quote`` under ``source``.

    Returns the number of ``enriched`` quotes, of those ``with_trade`` and of those ``with_close``
    before them, counted while they are written.
    """
    counts = Counts()
    enriched = enrich_quotes(
        read_trades(spark, f"{source}/trade"), read_quotes(spark, f"{source}/quote"), date, minutes, keep_all_quotes
    )
    write_by_day(
        enriched, target, files, only_days_present,
        last=lambda df: counts.of(
            df,
            enriched=ROWS,
            with_trade=F.col("last_trade_pr").isNotNull(),
            with_close=F.col("bid_pr_mv").isNotNull() | F.col("ask_pr_mv").isNotNull(),
        ),
    )
    return counts.taken()
