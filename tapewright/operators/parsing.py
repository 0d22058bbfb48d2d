"""Event lines to the typed common event table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.functions.text import (
    clock_time,
    decimal_price,
    is_json_line,
    is_one_object,
    json_doubtful,
    json_price,
    json_record,
    json_texts,
    plain_date,
    whole_number,
)
from tapewright.schema import BAD, EVENT_SCHEMA, QUOTE

# Fixed layout of a line: column, position in a CSV line, key in a JSON line.
# A quote and a trade differ from position 7 on.
_COMMON_FIELDS = (
    ("trade_dt", 0, "trade_dt"),
    ("arrival_tm", 1, "file_tm"),
    ("rec_type", 2, "event_type"),
    ("symbol", 3, "symbol"),
    ("event_tm", 4, "event_tm"),
    ("event_seq_nb", 5, "event_seq_nb"),
    ("exchange", 6, "exchange"),
)
_QUOTE_FIELDS = (
    ("bid_pr", 7, "bid_pr"),
    ("bid_size", 8, "bid_size"),
    ("ask_pr", 9, "ask_pr"),
    ("ask_size", 10, "ask_size"),
)
_TRADE_FIELDS = (("trade_pr", 7, "price"),)

_CONVERSIONS = {
    "trade_dt": plain_date,
    "arrival_tm": clock_time,
    "event_tm": clock_time,
    "event_seq_nb": whole_number,
    "trade_pr": decimal_price,
    "bid_pr": decimal_price,
    "bid_size": whole_number,
    "ask_pr": decimal_price,
    "ask_size": whole_number,
}

# JSON may give these as null, but the key itself must be there.
_NULLABLE_KEYS = {"rec_type": "event_type", "symbol": "symbol", "exchange": "exchange"}


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def parse_events(lines: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Parse feed lines (one string column ``value``) into ``EVENT_SCHEMA``.

    A line that starts with ``{`` is JSON and any other is CSV. A quote (``Q``) must carry bid and
    ask prices and sizes; every other record type has the trade layout and must carry a price. A
    line that breaks any rule is kept as a row of nulls in partition ``B``; with ``keep_raw`` its
    text is kept in an additional column ``raw_line``.

    The plan is one narrow projection over the scan: no shuffle and no Python worker.
    """
    line = F.col("value")
    json_line = is_json_line(line)
    split_up = lines.select(
        "value",
        F.when(json_line, json_record(line)).alias("record"),
        F.when(~json_line, F.split("value", ",")).alias("cells"),
    )
    doubtful = F.col("record").isNotNull() & json_doubtful(F.col("record"), line)
    # a struct tells a line that was not looked at again from one that could not be read
    checked = split_up.select("*", F.when(doubtful, F.struct(json_texts(line).alias("all"))).alias("texts"))
    texts = F.col("texts").getField("all")
    whole = F.col("texts").isNull() | is_one_object(texts, line)
    read = checked.select(
        "value", F.when(whole, F.col("record")).alias("record"), F.get(texts, F.lit(0)).alias("texts"), "cells"
    )

    def text(position: int, key: str) -> Column:
        return F.coalesce(F.get("cells", F.lit(position)), F.col("record").getField(key))

    def price(position: int, key: str) -> Column:
        exact = F.col("record").getField(key)
        of_json = F.when(F.col("texts").isNull(), exact).otherwise(
            json_price(exact, F.col("texts").getField(key))
        )
        of_cell = decimal_price(F.get("cells", F.lit(position)))
        return F.when(F.col("record").isNotNull(), of_json).otherwise(of_cell)

    fields = [
        (price if _CONVERSIONS.get(name) is decimal_price else text)(pos, key).alias(name)
        for name, pos, key in _COMMON_FIELDS + _QUOTE_FIELDS + _TRADE_FIELDS
    ]
    texts = read.select("value", "record", *fields)

    is_quote = F.col("rec_type").eqNullSafe(QUOTE)
    quote_names = [name for name, _, _ in _QUOTE_FIELDS]
    trade_names = [name for name, _, _ in _TRADE_FIELDS]

    def typed(name: str) -> Column:
        convert = _CONVERSIONS.get(name)
        value = F.col(name)
        if convert not in (None, decimal_price):
            value = convert(value)
        if name in quote_names:
            value = F.when(is_quote, value)
        elif name in trade_names:
            value = F.when(~is_quote, value)
        return value.alias(name)

    names = [f.name for f in EVENT_SCHEMA if f.name != "partition"]
    rows = texts.select("value", "record", *[typed(name) for name in names])

    # The object's keys are looked up only in the rare row whose value is null.
    def present(name: str) -> Column:
        keys = F.when(F.col("record").isNotNull(), F.json_object_keys("value"))
        listed = F.coalesce(F.array_contains(keys, _NULLABLE_KEYS[name]), F.lit(False))
        return F.when(F.col(name).isNotNull(), True).otherwise(listed)

    required = [n for n, _, _ in _COMMON_FIELDS if n not in _NULLABLE_KEYS]
    valid = (
        _all([F.col(n).isNotNull() for n in required])
        & F.when(is_quote, _all([F.col(n).isNotNull() for n in quote_names])).otherwise(
            _all([F.col(n).isNotNull() for n in trade_names])
        )
        & _all([present(n) for n in _NULLABLE_KEYS])
    )
    checked = rows.withColumn("valid", valid)
    ok = F.col("valid")
    event = F.struct(
        *[F.when(ok, F.col(name)).alias(name) for name in names],
        F.when(ok, F.col("rec_type")).otherwise(BAD).alias("partition"),
        *([F.when(~ok, F.col("value")).alias("raw_line")] if keep_raw else []),
    )
    # Emitted by a generator: a later filter on these columns would otherwise be rewritten into
    # one on the line's text, and every line parsed twice.
    return checked.select(F.inline(F.array(event)))
