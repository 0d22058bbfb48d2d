"""Edge lines of the parser (FIXTURES.md section 4)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tapewright import drop_bad, parse_events, split_quotes, split_trades
from tapewright.schema import EVENT_SCHEMA

DAY, ARRIVAL, AT = "2020-08-06", "2020-08-06 09:30:01.5", "2020-08-06 09:30:00.25"
CSV_TRADE = f"{DAY},{ARRIVAL},T,SYMA,{AT},5,NYSE,78.93"
CSV_QUOTE = f"{DAY},{ARRIVAL},Q,SYMA,{AT},5,NYSE,78.9,100,79.1,200"


def json_line(**changes):
    fields = {
        "trade_dt": f'"{DAY}"',
        "file_tm": f'"{ARRIVAL}"',
        "event_type": '"T"',
        "symbol": '"SYMA"',
        "event_tm": f'"{AT}"',
        "event_seq_nb": "5",
        "exchange": '"NYSE"',
        "price": "78.93",
    }
    fields.update(changes)
    members = (f'"{key}":{text}' for key, text in fields.items() if text is not None)
    return "{" + ",".join(members) + "}"


def json_quote(**changes):
    sides = {"bid_pr": "78.9", "bid_size": "100", "ask_pr": '"79.1"', "ask_size": '"200"'}
    return json_line(event_type='"Q"', price=None, **{**sides, **changes})


@pytest.fixture(scope="module")
def parse(spark):
    def run(*lines, **options):
        frame = spark.createDataFrame([(line,) for line in lines], "value string")
        return parse_events(frame, **options).collect()

    return run


BAD_LINES = {
    "empty line": "",
    "only a brace": "{",
    "JSON array": "[1]",
    "space before the object": " " + json_line(),
    "text after the object": json_line() + " and more",
    "two objects": json_line() + json_line(),
    "two objects with a comma": json_line() + "," + json_line(),
    "closing bracket after the object": json_line() + "]",
    "object left open inside another": json_line()[:-1] + ',"x":[1',
    "truncated object": json_line()[:-5],
    "single quotes": json_line().replace('"', "'"),
    "quote with ten fields": CSV_QUOTE.rsplit(",", 1)[0],
    "trade with seven fields": CSV_TRADE.rsplit(",", 1)[0],
    "symbol key absent": json_line(symbol=None),
    "exchange key absent": json_line(exchange=None),
    "event type absent": json_line(event_type=None),
    "price null": json_line(price="null"),
    "quote without a bid": json_quote(bid_pr=None),
    "quote with a trade price only": json_line(event_type='"Q"'),
    "price of eleven digits": json_line(price="12345678901"),
    "array closed before junk": json_line() + ",{}] junk",
    "array closed before an object": json_line() + ",{}],[{}",
    "price not a number": json_line(price="NaN"),
    "price text NaN": json_line(price='"NaN"'),
    "price with underscore": CSV_TRADE.replace("78.93", "1_000"),
    "price with comma in text": json_line(price='"7,5"'),
    "price empty": CSV_TRADE.replace("78.93", ""),
    "sequence not a number": json_line(event_seq_nb='"many"'),
    "sequence with a fraction": json_line(event_seq_nb="5.5"),
    "sequence too large": json_line(event_seq_nb="99999999999"),
    "time without fraction": CSV_TRADE.replace("00.25", "00"),
    "seven fraction digits": CSV_TRADE.replace("00.25", "00.1234567"),
    "time with a letter": CSV_TRADE.replace(f"{DAY} 09:30:00", f"{DAY}T09:30:00"),
    "time with line end": json_line(event_tm=f'"{AT}\\n"'),
    "hour 24": CSV_TRADE.replace("09:30:00.25", "24:30:00.25"),
    "thirtieth of February": CSV_TRADE.replace(DAY + ",", "2020-02-30,", 1),
    "date with a time": CSV_TRADE.replace(DAY + ",", AT + ",", 1),
    "year zero": CSV_TRADE.replace(DAY + ",", "0000-01-01,", 1),
}


@pytest.fixture(scope="module")
def bad_rows(parse):
    return {row["raw_line"]: row for row in parse(*BAD_LINES.values(), keep_raw=True)}


@pytest.mark.parametrize("line", BAD_LINES.values(), ids=BAD_LINES.keys())
def test_bad_line(bad_rows, line):
    row = bad_rows[line]
    assert row["partition"] == "B"
    assert [row[f.name] for f in EVENT_SCHEMA if f.name != "partition"] == [None] * 12


def test_layouts(parse):
    trade_csv, trade_json, quote_csv, quote_json = parse(
        CSV_TRADE, json_line(), CSV_QUOTE, json_quote()
    )
    assert trade_csv == trade_json
    assert quote_csv == quote_json
    assert trade_csv.asDict() == {
        "trade_dt": dt.date(2020, 8, 6),
        "rec_type": "T",
        "symbol": "SYMA",
        "exchange": "NYSE",
        "event_tm": dt.datetime(2020, 8, 6, 9, 30, 0, 250000),
        "event_seq_nb": 5,
        "arrival_tm": dt.datetime(2020, 8, 6, 9, 30, 1, 500000),
        "trade_pr": Decimal("78.93"),
        "bid_pr": None,
        "bid_size": None,
        "ask_pr": None,
        "ask_size": None,
        "partition": "T",
    }
    assert quote_csv["trade_pr"] is None
    assert (quote_csv["bid_pr"], quote_csv["bid_size"]) == (Decimal("78.9"), 100)
    assert (quote_csv["ask_pr"], quote_csv["ask_size"]) == (Decimal("79.1"), 200)


def test_schema(spark):
    lines = spark.createDataFrame([(CSV_TRADE,)], "value string")
    assert parse_events(lines).schema.simpleString() == EVENT_SCHEMA.simpleString()
    with_raw = parse_events(lines, keep_raw=True)
    assert with_raw.columns == [*EVENT_SCHEMA.names, "raw_line"]
    assert with_raw.first()["raw_line"] is None


def test_accepted_oddities(parse):
    def one(line):
        (row,) = parse(line)
        assert row["partition"] != "B" or "B" in line
        return row

    assert one(CSV_QUOTE + ",extra")["ask_size"] == 200
    assert one(CSV_TRADE.replace("SYMA", ""))["symbol"] == ""
    assert one(json_line(symbol="null"))["symbol"] is None
    assert one(json_line(symbol='"A","symbol":"B"'))["symbol"] == "B"
    assert one(json_line(event_seq_nb='"7"'))["event_seq_nb"] == 7
    assert one(json_line(price='" 78.93 "'))["trade_pr"] == Decimal("78.93")
    assert one(json_line() + "  ")["symbol"] == "SYMA"
    assert one(json_line(price="123.456789012345"))["trade_pr"] == Decimal("123.456789012345")
    assert one(json_line(price='"1.123456789012345"'))["trade_pr"] == Decimal("1.12345678901235")
    early = one(CSV_TRADE.replace(AT, "2020-8-6 9:30:0.5"))
    assert early["event_tm"] == dt.datetime(2020, 8, 6, 9, 30, 0, 500000)


def test_times_skipped_by_daylight_saving_are_kept(spark, parse):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        (row,) = parse(CSV_TRADE.replace(AT, "2024-03-10 02:30:00.5"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row["event_tm"] == dt.datetime(2024, 3, 10, 2, 30, 0, 500000)


def test_other_record_types(spark):
    lines = [
        CSV_TRADE.replace(",T,", ",X,"),
        CSV_TRADE.replace(",T,", ",B,"),
        json_line(event_type="null"),
        CSV_TRADE,
        CSV_QUOTE,
    ]
    events = parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [r["partition"] for r in events.collect()] == ["X", "B", None, "T", "Q"]
    assert all(r["event_seq_nb"] == 5 for r in events.collect())
    good = drop_bad(events)
    assert sorted(r["partition"] for r in good.collect()) == ["Q", "T", "X"]
    assert split_trades(good).count() == 1
    assert split_quotes(good).count() == 1


DIGITS = "12345678901234"


PRICES = [
    "999.12345678901237",
    "999.00000000000001",
    "1000",
    "1234567890.12345678901234",
    "9999999999.99999999999999",
    "-9999999999.99999999999999",
    "-5.5",
    "0",
    "1e3",
    "12.5E-3",
    "1.234567890123456789e9",
    # every magnitude of the type, before and after the point
    *(f"{DIGITS[:n]}.{DIGITS}" for n in range(1, 11)),
    *(f"{10**n}" for n in range(10)),
    *(f"{10**n}.00000000000001" for n in range(10)),
    *(f"0.{10**n:014d}" for n in range(14)),
]


@pytest.mark.parametrize("quotes", ["", '"'], ids=["number", "text"])
def test_prices_are_exact(parse, quotes):
    rows = parse(*(json_line(price=f"{quotes}{price}{quotes}") for price in PRICES))
    exact = [Decimal(price).quantize(Decimal("1e-14"), ROUND_HALF_UP) for price in PRICES]
    assert [row["trade_pr"] for row in rows] == exact


ODD_TEXTS = {"12,5": None, " 12.5 ": "12.5", "1,000.5": None, "+5": "5", "": None, "1_0": None, "1 0": None}


@pytest.mark.parametrize("space", ["", " "])
@pytest.mark.parametrize("text", ODD_TEXTS)
def test_price_texts(parse, text, space):
    line = json_line(price=None)[:-1] + f',"price"{space}:{space}"{text}"}}'
    expected = ODD_TEXTS[text]
    assert parse(line)[0]["trade_pr"] == (None if expected is None else Decimal(expected))
    # the last of repeated keys counts
    twice = json_line(price="1")[:-1] + f',"price":"{text}"}}'
    assert parse(twice)[0]["trade_pr"] == (None if expected is None else Decimal(expected))


def test_a_price_given_twice(parse):
    for last, expected in (("99999999999", None), ('"1.2.3"', None), ("2.5", Decimal("2.5"))):
        twice = json_line(price="1")[:-1] + f',"price" : {last}}}'
        assert parse(twice)[0]["trade_pr"] == expected


def test_doubtful_lines_that_are_one_object(parse):
    extra = [
        ',"more":{"a":[1,{}]}}',
        ',"note":"}"}',
        ',"price":1234567890.12345678901234,"note":"{}"}',
        ',"note":"price\\":\\"1,5"}',
    ]
    rows = parse(*(json_line()[:-1] + end for end in extra))
    assert [r["partition"] for r in rows] == ["T"] * 4
    assert rows[2]["trade_pr"] == Decimal("1234567890.12345678901234")
    assert [r["trade_pr"] for r in rows[:2] + rows[3:]] == [Decimal("78.93")] * 3
    assert parse(json_line() + "\t")[0]["partition"] == "T"
