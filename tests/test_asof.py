"""As-of join and enrichment against pairing every quote with every earlier trade."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from frames import make_quotes, make_trades
from test_rolling import HALF_HOUR, SPLITS, in_window, key, mean

from tapewright import (
    asof_last_trade,
    closing_price,
    enrich_quotes,
    leading_avg,
    price_moves,
    range_stats,
    trailing_avg,
)
from tapewright.functions.timegrid import micros
from tapewright.operators.ranges import Ranges
from tapewright.schema import DAY_SERIES, ENRICHED_SCHEMA, QUOTE_SCHEMA, SERIES, TRADE_SCHEMA


# Time slots for busy series, or time ranges: many small ones, some, and one.
WAYS = [*({"split_rows": n} for n in SPLITS), {"range_rows": 1}, {"range_rows": 40}, {}]


def last_before(trades, quote, keys=DAY_SERIES):
    earlier = [
        t
        for t in trades
        if key(t, keys) is not None
        and key(t, keys) == key(quote, keys)
        and t["event_tm"] < quote["event_tm"]
    ]
    return max(earlier, key=lambda t: (t["event_tm"], t["event_seq_nb"]), default=None)


def kept_quotes(quotes, keep_all):
    if keep_all:
        return quotes
    best = {}
    for q in quotes:
        instant = tuple(q[c] for c in (*DAY_SERIES, "event_tm"))
        if instant not in best or q["event_seq_nb"] > best[instant]["event_seq_nb"]:
            best[instant] = q
    return list(best.values())


@pytest.mark.parametrize("way", WAYS, ids=str)
@pytest.mark.parametrize("keep_all", [False, True])
@pytest.mark.parametrize("seed", [1, 6])
def test_asof(spark, seed, keep_all, way):
    quotes, trades = make_quotes(spark, seed), make_trades(spark, seed + 1)
    result = asof_last_trade(quotes, trades, keep_all_quotes=keep_all, **way).collect()
    rows = trades.collect()
    expected = sorted(
        (q["event_seq_nb"], q["bid_pr"], getattr(last_before(rows, q), "trade_pr", None))
        for q in kept_quotes(quotes.collect(), keep_all)
    )
    assert sorted((r["event_seq_nb"], r["bid_pr"], r["last_trade_pr"]) for r in result) == expected


def test_null_value_of_the_last_trade_is_not_skipped(spark):
    def at(minute):
        return dt.datetime(2024, 1, 15, 10, minute)

    trades = spark.createDataFrame(
        [("A", "N", at(1), 1, Decimal(5)), ("A", "N", at(2), 2, None)],
        "symbol string, exchange string, event_tm timestamp_ntz, event_seq_nb int, "
        "trade_pr decimal(24,14)",
    )
    quotes = spark.createDataFrame(
        [("A", "N", at(2), 8), ("A", "N", at(3), 9)],
        "symbol string, exchange string, event_tm timestamp_ntz, event_seq_nb int",
    )
    for way in WAYS:
        rows = asof_last_trade(quotes, trades, SERIES, **way).collect()
        assert {r["event_seq_nb"]: r["last_trade_pr"] for r in rows} == {8: Decimal(5), 9: None}


def brute_enrich(quotes, trades, keep_all):
    closes = {}
    for t in trades:
        if None in (t["symbol"], t["exchange"]):
            continue
        series = (t["trade_dt"] + dt.timedelta(days=1), t["symbol"], t["exchange"])
        rank = (t["event_tm"] or dt.datetime.min, t["event_seq_nb"])
        if series not in closes or rank > closes[series][0]:
            closes[series] = (rank, t["trade_pr"])
    for q in kept_quotes(quotes, keep_all):
        last = last_before(trades, q)
        close = closes.get(tuple(q[c] for c in DAY_SERIES), (None, None))[1]
        prices = last and in_window(trades, last, DAY_SERIES, -HALF_HOUR, HALF_HOUR * 0)
        yield (
            q["event_seq_nb"],
            q["ask_size"],
            last and last["trade_pr"],
            mean(prices) if last else None,
            None if close is None else q["bid_pr"] - close,
            None if close is None else q["ask_pr"] - close,
        )


@pytest.mark.parametrize("way", WAYS, ids=str)
@pytest.mark.parametrize("keep_all", [False, True])
def test_enrich(spark, keep_all, way):
    quotes, trades = make_quotes(spark, 11), make_trades(spark, 12)
    result = enrich_quotes(trades, quotes, keep_all_quotes=keep_all, **way)
    assert result.schema.simpleString() == ENRICHED_SCHEMA.simpleString()
    columns = (
        "event_seq_nb",
        "ask_size",
        "last_trade_pr",
        "last_mov_avg_pr",
        "bid_pr_mv",
        "ask_pr_mv",
    )
    found = {r["event_seq_nb"]: tuple(r[c] for c in columns) for r in result.collect()}
    expected = {
        row[0]: row for row in brute_enrich(quotes.collect(), trades.collect(), keep_all)
    }
    assert found == expected


@pytest.mark.parametrize("seed", [3, 8])
def test_ordinary_and_busy_series_agree(spark, seed):
    """Null prices, and null and equal sequence numbers, give the same rows on either branch."""
    trades = make_trades(spark, seed, untidy=True)
    quotes = make_quotes(spark, seed + 20, untidy=True)
    slots, ways = WAYS[: len(SPLITS)], [WAYS[0], *WAYS[2:5]]
    for run, others in (
        (lambda way: trailing_avg(trades, **way), slots),
        (lambda way: leading_avg(trades, **way), slots),
        (lambda way: range_stats(quotes, trades, "trade_pr", **way), slots),
        (lambda way: asof_last_trade(quotes, trailing_avg(trades), **way), ways),
        (lambda way: asof_last_trade(quotes, trades, keep_all_quotes=True, **way), ways),
        (lambda way: enrich_quotes(trades, quotes, **way), ways),
        (lambda way: enrich_quotes(trades, quotes, keep_all_quotes=True, **way), ways),
    ):
        ordinary = Counter(run(others[0]).collect())
        assert ordinary
        for way in others[1:]:
            assert Counter(run(way).collect()) == ordinary


def test_ranges(spark):
    quotes, trades = make_quotes(spark, 1), make_trades(spark, 2)
    ranges = Ranges.measured(quotes, trades, rows=30)
    assert 3 < len(ranges.starts) < 8
    known = quotes.dropna(subset=["event_tm"])
    placed = quotes.select("event_tm", micros("event_tm").alias("at"), ranges.of().alias("range")).collect()
    for row in placed:
        expected = 0 if row["at"] is None else sum(start <= row["at"] for start in ranges.starts)
        assert row["range"] == expected
    assert Ranges.measured(quotes, trades).starts == []
    assert Ranges.measured(known.limit(0)).starts == []


def test_a_hot_series_is_spread_over_ranges(spark):
    """No window is partitioned by series keys alone, but that over one row for each cell."""
    trades, quotes = make_trades(spark, 2), make_quotes(spark, 1)
    for result in (
        asof_last_trade(quotes, trades, range_rows=10),
        enrich_quotes(trades, quotes, range_rows=10),
    ):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "_range" in plan and "Python" not in plan and "Join" not in plan
        windows = [line for line in plan.splitlines() if "+- Window " in line or ":- Window " in line]
        for line in windows:
            spec = line.split("windowspecdefinition(")[1].split(" ASC")[0]
            keys = [part.strip().split("#")[0] for part in spec.split(",")]
            assert "_range" in keys, line


def test_null_prices_and_sequence_numbers(spark):
    """A null price is in no mean; a null sequence number comes before all others."""
    at = dt.datetime(2024, 1, 15, 10)
    minute = dt.timedelta(minutes=1)
    trades = spark.createDataFrame(
        [
            trade(at, 1, 100),
            (at.date(), "T", "A", "N", at + minute, 2, at, None, "T"),
            trade(at + 2 * minute, 3, 200),
            trade(at + 2 * minute, None, 900),
            trade(at, None, 7, "B"),
        ],
        TRADE_SCHEMA,
    )
    quotes = spark.createDataFrame(
        [quote(at + 3 * minute, None, 5, "A"), quote(at + 3 * minute, None, 6, "B")], QUOTE_SCHEMA
    )
    for way in WAYS:
        rows = enrich_quotes(trades, quotes, **way).collect()
        found = {r["symbol"]: (r["bid_pr"], r["last_trade_pr"], r["last_mov_avg_pr"]) for r in rows}
        assert found == {"A": (5, 200, 400), "B": (6, 7, 7)}


def trade(time, seq, price, symbol="A"):
    return (time.date(), "T", symbol, "N", time, seq, time, Decimal(price), "T")


def quote(time, seq, bid, symbol="A"):
    price = Decimal(bid)
    return (time.date(), "Q", symbol, "N", time, seq, time, price, 1, price, 1, "Q")


def test_rules_of_enrichment(spark):
    """The date, strictness, ties, midnight and missing close rules, one row each."""
    friday, monday = dt.datetime(2024, 1, 12, 15), dt.datetime(2024, 1, 15, 10)
    sunday = dt.datetime(2024, 1, 14, 15)
    minute = dt.timedelta(minutes=1)
    trades = spark.createDataFrame(
        [
            trade(friday, 1, 7),  # two calendar days before Sunday's successor: no close
            trade(sunday, 2, 9, "B"),
            trade(sunday, 3, 8, "B"),  # same instant, greater sequence number: the close
            trade(monday, 4, 20, "B"),  # exactly at the quote's time: not its last trade
            trade(monday - 30 * minute, 5, 10, "A"),
            trade(monday, 6, 20, "A"),
        ],
        TRADE_SCHEMA,
    )
    quotes = spark.createDataFrame(
        [
            quote(monday, 10, 11, "B"),
            quote(monday, 11, 12, "B"),  # same instant: this one stays
            quote(monday + minute, 12, 13, "A"),
            quote(friday + minute, 13, 14, "A"),  # another day
        ],
        QUOTE_SCHEMA,
    )
    for way in WAYS:
        rows = enrich_quotes(trades, quotes, "2024-01-15", **way).collect()
        found = {
            r["event_seq_nb"]: (r["last_trade_pr"], r["last_mov_avg_pr"], r["bid_pr_mv"])
            for r in rows
        }
        assert found == {11: (None, None, Decimal(4)), 12: (Decimal(20), Decimal(15), None)}


def test_price_moves_and_close(spark):
    day = dt.datetime(2024, 1, 15, 10)
    close = closing_price(
        spark.createDataFrame(
            [trade(day, 1, 5), trade(day, 2, 6), trade(day, 9, 4, None)], TRADE_SCHEMA
        )
    )
    assert {r["symbol"]: r["close_pr"] for r in close.collect()} == {"A": 6, None: 4}
    quotes = spark.createDataFrame(
        [quote(day, 1, 7), quote(day, 2, 8, "Z"), quote(day, 3, 9, None)], QUOTE_SCHEMA
    )
    moves = price_moves(quotes, close).collect()
    assert {r["event_seq_nb"]: r["bid_pr_mv"] for r in moves} == {1: 1, 2: None, 3: None}
