"""Table layouts of the feed: common events, trades, quotes, enriched quotes, job status.

Every time is TIMESTAMP_NTZ (wall time, never shifted by the session zone) and every price is
DECIMAL(24,14). All columns are nullable: a bad line is kept as nulls plus its partition mark.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Fixed values of the feed.
QUOTE = "Q"
TRADE = "T"
BAD = "B"

DATE = DateType()
TIME = TimestampNTZType()
TEXT = StringType()
INT = IntegerType()
PRICE = DecimalType(24, 14)
MEAN_PRICE = DecimalType(28, 18)
PRICE_MOVE = DecimalType(25, 14)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


EVENT_SCHEMA = _struct(
    trade_dt=DATE,
    rec_type=TEXT,
    symbol=TEXT,
    exchange=TEXT,
    event_tm=TIME,
    event_seq_nb=INT,
    arrival_tm=TIME,
    trade_pr=PRICE,
    bid_pr=PRICE,
    bid_size=INT,
    ask_pr=PRICE,
    ask_size=INT,
    partition=TEXT,
)

TRADE_COLUMNS = (
    "trade_dt",
    "rec_type",
    "symbol",
    "exchange",
    "event_tm",
    "event_seq_nb",
    "arrival_tm",
    "trade_pr",
    "partition",
)

QUOTE_COLUMNS = (
    "trade_dt",
    "rec_type",
    "symbol",
    "exchange",
    "event_tm",
    "event_seq_nb",
    "arrival_tm",
    "bid_pr",
    "bid_size",
    "ask_pr",
    "ask_size",
    "partition",
)

TRADE_SCHEMA = StructType([EVENT_SCHEMA[name] for name in TRADE_COLUMNS])
QUOTE_SCHEMA = StructType([EVENT_SCHEMA[name] for name in QUOTE_COLUMNS])

# What a quote carries besides its key and time.
QUOTE_VALUES = ("bid_pr", "bid_size", "ask_pr", "ask_size")

ENRICHED_SCHEMA = _struct(
    trade_dt=DATE,
    symbol=TEXT,
    exchange=TEXT,
    event_tm=TIME,
    event_seq_nb=INT,
    bid_pr=PRICE,
    bid_size=INT,
    ask_pr=PRICE,
    ask_size=INT,
    last_trade_pr=PRICE,
    last_mov_avg_pr=MEAN_PRICE,
    bid_pr_mv=PRICE_MOVE,
    ask_pr_mv=PRICE_MOVE,
)

JOB_STATUS_SCHEMA = _struct(
    job_status_id=INT,
    job_name=TEXT,
    job_status_timestamp=TIME,
    job_status=TEXT,
    job_id=TEXT,
)

# One price series: an instrument on an exchange, within a trading day.
SERIES = ("symbol", "exchange")
DAY_SERIES = ("trade_dt", "symbol", "exchange")

# Rows that are the same event delivered again differ only in arrival, prices and sizes.
DELIVERY_KEYS = ("trade_dt", "rec_type", "symbol", "exchange", "event_tm", "event_seq_nb")
