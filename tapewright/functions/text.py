"""Text to typed value, null where the text is not valid. All of it runs inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapewright.schema import PRICE

# Fixed formats of the feed: calendar date, and date plus time with one to six fraction digits.
# One- or two-digit months, days, hours, minutes and seconds are all accepted.
DATE_FORMAT = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}\z"
TIME_FORMAT = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}\z"

PRICE_KEYS = ("price", "bid_pr", "ask_pr")
# A comma of a JSON line that no key follows: it may stand in a price given as text.
INNER_COMMA = r',\s*(?:[^"\s]|"\s*[,}])'

# JSON keys of a line.
JSON_KEYS = (
    "trade_dt",
    "file_tm",
    "event_type",
    "symbol",
    "event_tm",
    "event_seq_nb",
    "exchange",
    "price",
    "bid_pr",
    "bid_size",
    "ask_pr",
    "ask_size",
)


# Prices are read as decimals, which takes a number's own digits: as text it would pass through a
# double. All else is read as text, so that numbers and quoted numbers convert alike.
# A value that cannot be read leaves the line in _CORRUPT.
_CORRUPT = "_corrupt_record"
_JSON_RECORD = "struct<{},{}:string>".format(
    ",".join(f"{k}:{PRICE.simpleString() if k in PRICE_KEYS else 'string'}" for k in JSON_KEYS),
    _CORRUPT,
)
_JSON_TEXTS = "array<struct<{}>>".format(
    ",".join(f"{k}:string" for k in ("symbol", *PRICE_KEYS))
)
_JSON_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": _CORRUPT}


def plain_date(text: Column) -> Column:
    """DATE, or null unless the text is exactly a calendar date."""
    return F.when(text.rlike(DATE_FORMAT), text.try_cast("date"))


def clock_time(text: Column) -> Column:
    """TIMESTAMP_NTZ, or null unless the text is a date and a time with a fraction.

    The cast parses digits directly (no date-format object) and never consults the session zone;
    the pattern only narrows what the cast would accept.
    """
    return F.when(text.rlike(TIME_FORMAT), text.try_cast("timestamp_ntz"))


def whole_number(text: Column) -> Column:
    """INT, or null where the text is no integer of that range."""
    return text.try_cast("int")


def decimal_price(text: Column) -> Column:
    """A price rounded half up, or null where the text is no number of that range."""
    return text.try_cast(PRICE)


def is_json_line(line: Column) -> Column:
    return line.startswith("{")


def json_record(line: Column) -> Column:
    """The line's first JSON object: prices as decimals, all else as text."""
    return F.from_json(line, _JSON_RECORD, _JSON_OPTIONS)


def json_doubtful(record: Column, line: Column) -> Column:
    """Whether a JSON line may be more than its first object, or its prices other than they seem.

    A line whose first closing brace is its last character has nothing after its object, and a
    decimal read from a text differs from it only by commas, if it can be read at all. Nearly every
    line is free of doubt; the others take the longer way of :func:`json_texts`.
    """
    alone = F.locate("}", line) == F.length(F.rtrim(line))
    return record.getField(_CORRUPT).isNotNull() | ~alone | line.rlike(INNER_COMMA)


def json_texts(line: Column) -> Column:
    """The line's object as the first of two elements; the second holds a hash of the line.

    Parsers stop at the end of the first value, so a line with text after its object would pass.
    As an element of an array, such text is a syntax error or a further element, and a line that
    closes the array itself cannot know the hash that is looked for behind its object.
    """
    closing = F.concat(F.lit(',{"symbol":"'), _mark(line), F.lit('"}]'))
    return F.from_json(F.concat(F.lit("["), line, closing), _JSON_TEXTS, _JSON_OPTIONS)


def _mark(line: Column) -> Column:
    return F.xxhash64(line).cast("string")


def is_one_object(texts: Column, line: Column) -> Column:
    """Whether the line read by :func:`json_texts` is one object and nothing else."""
    closed = F.get(texts, F.lit(1)).getField("symbol").eqNullSafe(_mark(line))
    return F.coalesce((F.size(texts) == 2) & closed, F.lit(False))


def json_price(exact: Column, text: Column) -> Column:
    """``exact``, the price read as a decimal, unless it came from a text that says something else.

    A decimal read from a text leaves out commas and refuses blanks. A number's text has passed
    through a double, so the two are the same price if they are the same double.
    """
    same = exact.cast("double") == text.try_cast("double")
    return F.when(same, exact).otherwise(decimal_price(text))
