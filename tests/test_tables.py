"""Sources and sinks, and the three steps run from folder to folder."""

import datetime as dt
from decimal import Decimal

import pytest
from frames import make_quotes, make_trades
from test_parsing import CSV_QUOTE, CSV_TRADE, json_line, json_quote

import tapewright as tw
from tapewright.schema import (
    ENRICHED_SCHEMA,
    EVENT_SCHEMA,
    QUOTE_SCHEMA,
    TRADE_COLUMNS,
    TRADE_SCHEMA,
)


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def feed(tmp_path):
    files = {
        "data/a.txt": f"{CSV_TRADE}\n{json_line()}\n",
        "data/deep/er/b.txt": f"{CSV_QUOTE}\r\n{json_quote()}\r\n\r\n",
        "data2/part-00000": "not an event",
        "data2/c.txt": "not an event\n",
        "data/decoy.csv": "decoy",
        "other/d.txt": "decoy",
    }
    for name, text in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, newline="")
    return tmp_path


def values(df):
    return sorted(r["value"] for r in df.collect())


def test_read_raw_lines(spark, feed):
    a, b = [CSV_TRADE, json_line()], [CSV_QUOTE, json_quote(), ""]
    bad = "not an event"
    assert values(tw.read_raw_lines(spark, f"{feed}/data")) == sorted(a + b)
    assert values(tw.read_raw_lines(spark, f"{feed}/data", recursive=False)) == sorted(a)
    assert values(tw.read_raw_lines(spark, f"{feed}/data*")) == sorted([*a, *b, bad])
    assert values(tw.read_raw_lines(spark, str(feed), glob="part-*")) == [bad]
    joined = f"{feed}/data/a.txt,{feed}/data2/c.txt"
    assert values(tw.read_raw_lines(spark, joined)) == sorted([*a, bad])
    assert values(tw.read_raw_lines(spark, joined.split(","))) == sorted([*a, bad])


def test_events_round_trip_and_pruning(spark, feed, tmp_path):
    target = f"{tmp_path}/events"
    tw.run_ingest(spark, f"{feed}/data*", target)
    events = tw.read_events(spark, target)
    assert events.schema.simpleString() == EVENT_SCHEMA.simpleString()
    counts = {r["partition"]: r["events"] for r in tw.event_counts(events).collect()}
    assert counts == {"T": 2, "Q": 2, "B": 2}
    chosen = tw.read_events(spark, target, ["T", "Q"])
    assert chosen.count() == 4
    assert "PartitionFilters: [partition" in plan_of(chosen)
    # run again: replaced, not added to
    tw.run_ingest(spark, f"{feed}/data", target)
    assert tw.read_events(spark, target).count() == 5


def test_steps_from_feed_to_enriched_quotes(spark, feed, tmp_path):
    events, tables, enriched = (f"{tmp_path}/{name}" for name in ("ev", "tables", "out"))
    tw.run_ingest(spark, f"{feed}/data", events)
    tw.run_preprocess(spark, events, tables, files=1)
    assert tw.read_trades(spark, f"{tables}/trade").count() == 1  # one event, delivered twice
    tw.run_enrich(spark, tables, enriched, "2020-08-06")
    (row,) = tw.read_enriched(spark, enriched).collect()
    assert tw.read_enriched(spark, enriched).schema.simpleString() == (
        ENRICHED_SCHEMA.simpleString()
    )
    assert row["bid_pr"] == Decimal("78.9") and row["last_trade_pr"] is None


def test_write_by_day_replaces_all_or_only_its_days(spark, tmp_path):
    trades = make_trades(spark).dropna(subset=["event_tm"])
    days = sorted({r["trade_dt"] for r in trades.select("trade_dt").collect()})
    assert len(days) == 2
    path = f"{tmp_path}/trades"
    tw.write_by_day(trades, path)
    stored = tw.read_trades(spark, path)
    assert stored.schema.simpleString() == TRADE_SCHEMA.simpleString()
    assert stored.exceptAll(trades).count() == 0 and stored.count() == trades.count()

    first = tw.day_slice(trades, days[0])
    tw.write_by_day(first.limit(1), path, only_days_present=True)
    assert tw.day_slice(tw.read_trades(spark, path), days[0]).count() == 1
    assert (
        tw.day_slice(tw.read_trades(spark, path), days[1]).count()
        == tw.day_slice(trades, days[1]).count()
    )
    tw.write_by_day(first, path, files=4)
    assert tw.read_trades(spark, path).count() == first.count()


def test_day_slice_prunes_folders(spark, tmp_path):
    path = f"{tmp_path}/quotes"
    tw.write_by_day(make_quotes(spark), path, files=1)
    sliced = tw.day_slice(tw.read_quotes(spark, path), "2024-01-15")
    assert "PartitionFilters: [isnotnull(trade_dt" in plan_of(sliced)
    assert sliced.schema.simpleString() == QUOTE_SCHEMA.simpleString()
    assert tw.previous_day("2024-03-01") == dt.date(2024, 2, 29)
    assert tw.previous_day(dt.datetime(2024, 1, 1, 5)) == dt.date(2023, 12, 31)


def test_latest_delivery(spark):
    at = dt.datetime(2024, 1, 15, 10)

    def delivery(seq, seconds, price, symbol="A"):
        arrival = at + dt.timedelta(seconds=seconds)
        return (at.date(), "T", symbol, "N", at, seq, arrival, Decimal(price), "T")

    trades = spark.createDataFrame(
        [
            delivery(1, 1, 5),
            delivery(1, 9, 4),  # latest
            delivery(1, 3, 6),
            delivery(2, 1, 5),
            delivery(2, 1, 7),  # same arrival, greater price
            delivery(3, 1, 8, None),
            delivery(3, 2, 9, None),  # null keys are one group
        ],
        TRADE_SCHEMA,
    )
    latest = tw.latest_delivery(trades)
    assert latest.columns == list(TRADE_COLUMNS)
    assert {r["event_seq_nb"]: r["trade_pr"] for r in latest.collect()} == {1: 4, 2: 7, 3: 9}


def test_lookup_preview_and_projection(spark):
    trades = make_trades(spark)
    found = tw.lookup_symbols(trades, ["A", "B"]).collect()
    assert {r["symbol"] for r in found} == {"A", "B"}
    keys = [(r["symbol"], r["exchange"] or "") for r in found]
    assert keys == sorted(keys)
    assert [r["event_seq_nb"] for r in tw.preview(trades, ["event_seq_nb"], 3).collect()] == [
        0,
        1,
        2,
    ]
    assert tw.project_trades(trades).columns == [
        "trade_dt",
        "symbol",
        "exchange",
        "event_tm",
        "event_seq_nb",
        "arrival_tm",
        "trade_pr",
    ]
