"""Small random tables with ties, repeated times, nulls and every kind of series size.

Untidy ones also have null prices, and null and repeated sequence numbers.
"""

import datetime as dt
import random
from decimal import Decimal

from tapewright.schema import QUOTE_SCHEMA, TRADE_SCHEMA

START = dt.datetime(2024, 1, 14, 23, 0)


def random_rows(seed, count, untidy=False):
    rng = random.Random(seed)
    # A third of all rows belongs to one series, and many of those to one instant.
    series = [("HOT", "NYSE")] * 4 + [("A", "NYSE"), ("A", "NASDAQ"), ("B", "NYSE")]
    series += [(None, "NYSE"), ("B", None)]
    instants = [START + dt.timedelta(minutes=rng.randrange(150)) for _ in range(12)]
    for seq in range(count):
        symbol, exchange = rng.choice(series)
        time = rng.choice(instants)
        kind = rng.random()
        if kind < 0.4:  # off the minute grid, down to the microsecond
            time += dt.timedelta(microseconds=rng.choice([-1, 1, 7_000_000, 123_456]))
        elif kind < 0.43:
            time = None
        day = (time or START).date()
        price = Decimal(rng.randrange(1, 250_000)) / Decimal(100)
        number = seq
        if untidy:
            price = None if rng.random() < 0.15 else price
            number = rng.choice([seq, seq, None, -5, 7])
        yield day, symbol, exchange, time, number, price


def make_trades(spark, seed=1, count=120, untidy=False):
    rows = [
        (day, "T", symbol, exchange, time, seq, START, price, "T")
        for day, symbol, exchange, time, seq, price in random_rows(seed, count, untidy)
    ]
    return spark.createDataFrame(rows, TRADE_SCHEMA)


def make_quotes(spark, seed=2, count=120, untidy=False):
    rows = [
        (
            *(day, "Q", symbol, exchange, time, number, START, price, i),
            *(None if price is None else price + 1, i + 1, "Q"),
        )
        for i, (day, symbol, exchange, time, number, price) in enumerate(
            random_rows(seed, count, untidy)
        )
    ]
    return spark.createDataFrame(rows, QUOTE_SCHEMA)
