"""Closing prices, and quote moves against them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions.order import instant_order
from tapewright.schema import PRICE_MOVE, SERIES


def closing_price(trades: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Last trade price of each series: ``keys`` plus ``close_pr``.

    Give one day of trades, or several with ``trade_dt`` among the keys. Trades at one instant are
    settled by the greatest sequence number, an unknown one being the smallest. Each task reduces
    its rows to one per series before the shuffle, by hash and without a sort.
    """
    latest = F.max_by("trade_pr", instant_order("event_tm", ["trade_pr"]))
    return trades.groupBy(*keys).agg(latest.alias("close_pr"))


def add_moves(df: DataFrame) -> DataFrame:
    """Replace ``close_pr`` by the bid's and ask's distance from it (null without a close)."""
    for side in ("bid_pr", "ask_pr"):
        move = (F.col(side) - F.col("close_pr")).cast(PRICE_MOVE)
        df = df.withColumn(f"{side}_mv", move)
    return df.drop("close_pr")


def price_moves(quotes: DataFrame, close: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Left join of quotes to closes, with ``bid_pr_mv`` and ``ask_pr_mv``.

    No broadcast is forced: Spark broadcasts the closes if they are below its size threshold and
    otherwise joins by sort and merge, where adaptive execution splits a series with very many
    quotes.
    """
    return add_moves(quotes.join(close.select(*keys, "close_pr"), list(keys), "left"))
