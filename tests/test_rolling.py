"""Rolling statistics against pairing every row with every other."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from frames import make_quotes, make_trades

from pyspark.sql import functions as F
from tapewright import leading_avg, range_stats, trailing_avg
from tapewright.schema import DAY_SERIES, MEAN_PRICE, SERIES

HALF_HOUR = dt.timedelta(minutes=30)
# No busy series; some; only busy series.
SPLITS = [10**6, 15, 0]


def mean(prices):
    if not prices:
        return None
    exact = Decimal(sum(prices)) / len(prices)
    return exact.quantize(Decimal("1e-18"), ROUND_HALF_UP)


def key(row, keys):
    values = tuple(row[k] for k in keys)
    return None if None in values or row["event_tm"] is None else values


def in_window(rows, row, keys, low, high):
    if key(row, keys) is None:
        return []
    return [
        r["trade_pr"]
        for r in rows
        if key(r, keys) == key(row, keys)
        and row["event_tm"] + low <= r["event_tm"] <= row["event_tm"] + high
    ]


@pytest.mark.parametrize("split_rows", SPLITS)
@pytest.mark.parametrize("seed", [1, 5])
def test_trailing_avg(spark, seed, split_rows):
    trades = make_trades(spark, seed)
    rows = trades.collect()
    result = trailing_avg(trades, split_rows=split_rows)
    assert result.columns == [*trades.columns, "mov_avg_trade_pr"]
    assert result.schema["mov_avg_trade_pr"].dataType == MEAN_PRICE
    expected = {
        r["event_seq_nb"]: mean(in_window(rows, r, DAY_SERIES, -HALF_HOUR, HALF_HOUR * 0))
        for r in rows
    }
    found = {r["event_seq_nb"]: r["mov_avg_trade_pr"] for r in result.collect()}
    assert found == expected
    assert result.drop("mov_avg_trade_pr").exceptAll(trades).count() == 0
    assert result.count() == trades.count()


@pytest.mark.parametrize("split_rows", SPLITS)
def test_leading_avg_crosses_midnight(spark, split_rows):
    trades = make_trades(spark, 3)
    rows = trades.collect()
    expected = {
        r["event_seq_nb"]: mean(in_window(rows, r, SERIES, HALF_HOUR * 0, HALF_HOUR))
        for r in rows
    }
    result = leading_avg(trades, split_rows=split_rows)
    assert {r["event_seq_nb"]: r["moving_average"] for r in result.collect()} == expected


@pytest.mark.parametrize("minutes", [1, 7, 45])
def test_leading_avg_is_the_descending_range_frame(spark, minutes):
    trades = make_trades(spark, 4).dropna(subset=["symbol", "exchange", "event_tm"])
    framed = trades.withColumn(
        "framed",
        F.expr(
            f"""avg(trade_pr) OVER (PARTITION BY symbol, exchange ORDER BY event_tm DESC
            RANGE BETWEEN INTERVAL {minutes} MINUTES PRECEDING AND CURRENT ROW)"""
        ),
    )
    expected = {r["event_seq_nb"]: r["framed"] for r in framed.collect()}
    for split_rows in SPLITS:
        result = leading_avg(trades, minutes, split_rows=split_rows).collect()
        assert {r["event_seq_nb"]: r["moving_average"] for r in result} == expected


@pytest.mark.parametrize("split_rows", SPLITS)
def test_range_stats(spark, split_rows):
    quotes, trades = make_quotes(spark, 7), make_trades(spark, 8)
    rows = trades.collect()
    result = range_stats(quotes, trades, "trade_pr", split_rows=split_rows)
    assert result.columns == [*quotes.columns, "matches", "match_sum"]
    assert result.count() == quotes.count()
    found = {r["event_seq_nb"]: (r["matches"], r["match_sum"]) for r in result.collect()}
    for q in quotes.collect():
        prices = in_window(rows, q, DAY_SERIES, -HALF_HOUR, HALF_HOUR * 0)
        assert found[q["event_seq_nb"]] == (len(prices), sum(prices) if prices else None)


@pytest.mark.parametrize("minutes", [30, 1441, 4000])
@pytest.mark.parametrize("ahead", [False, True])
def test_busy_series_over_many_days(spark, ahead, minutes):
    """The slots of one day hand over to the next, also where a window spans several days."""
    rng = random.Random(minutes)
    start = dt.datetime(2024, 1, 14)
    rows = []
    for seq in range(150):
        at = start + dt.timedelta(days=rng.choice([0, 0, 1, 2, 5, 6]), seconds=rng.randrange(86_400))
        if rng.random() < 0.4:  # about midnight, and on it
            at = at.replace(hour=0, minute=0, second=0) + dt.timedelta(seconds=rng.choice([-10, -1, 0, 0, 5, 10]))
        rows.append(("HOT" if rng.random() < 0.8 else "B", "N", at, seq, Decimal(rng.randrange(1, 999))))
    trades = spark.createDataFrame(
        rows,
        "symbol string, exchange string, event_tm timestamp_ntz, event_seq_nb int, "
        "trade_pr decimal(24,14)",
    )
    span = dt.timedelta(minutes=minutes)
    low, high = (span * 0, span) if ahead else (-span, span * 0)
    kept = trades.collect()
    expected = {r["event_seq_nb"]: mean(in_window(kept, r, SERIES, low, high)) for r in kept}
    average = leading_avg if ahead else trailing_avg
    result = average(trades, minutes, keys=SERIES, split_rows=0).collect()
    assert {r["event_seq_nb"]: r[-1] for r in result} == expected


def test_window_ends_are_inclusive(spark):
    trades = spark.createDataFrame(
        [
            ("A", "N", dt.datetime(2024, 1, 15, 10, 0), 1, Decimal(1)),
            ("A", "N", dt.datetime(2024, 1, 15, 10, 30), 2, Decimal(3)),
            ("A", "N", dt.datetime(2024, 1, 15, 10, 30, 0, 1), 3, Decimal(5)),
        ],
        "symbol string, exchange string, event_tm timestamp_ntz, event_seq_nb int, "
        "trade_pr decimal(24,14)",
    )
    for split_rows in SPLITS:
        rows = trailing_avg(trades, keys=SERIES, split_rows=split_rows).collect()
        assert {r["event_seq_nb"]: r["mov_avg_trade_pr"] for r in rows} == {1: 1, 2: 2, 3: 4}


def test_floating_values_are_refused(spark):
    trades = make_trades(spark).withColumn("trade_pr", F.col("trade_pr").cast("double"))
    with pytest.raises(TypeError, match="exact running sums"):
        trailing_avg(trades)
