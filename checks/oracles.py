"""The queries of ``checks.queries`` as SQL over the ``events`` table.

They state the semantics the direct way (row numbers, range and inequality joins), with prices as
DECIMAL(9,2) and never by way of text, except where the feed line itself is the result.
"""

from __future__ import annotations

from checks.fixtures import DATE

_DELIVERIES = """
base AS (
  SELECT *,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'T'
         WHEN event_type IN ('click', 'view') THEN 'Q'
         ELSE 'B' END AS rec_type,
    CAST(event_id % 1000000000 AS INTEGER) AS seq,
    CAST(value AS DECIMAL(9,2)) AS cents
  FROM events),
deliveries AS (
  SELECT *, seq AS event_seq_nb, ts + INTERVAL 1 SECOND AS arrival_tm, cents AS price FROM base
  UNION ALL
  SELECT *, seq, ts + INTERVAL 5 SECOND, CAST(cents + 0.01 AS DECIMAL(9,2)) FROM base
  WHERE rec_type <> 'B' AND event_id % 10 = 0
  UNION ALL
  SELECT *, CAST(seq + 10000000 AS INTEGER), ts + INTERVAL 1 SECOND,
    CAST(cents + 0.02 AS DECIMAL(9,2)) FROM base
  WHERE rec_type <> 'B' AND event_id % 50 = 1),
typed AS (
  SELECT event_id,
    CASE WHEN rec_type <> 'B' THEN CAST(ts AS DATE) END AS trade_dt,
    CASE WHEN rec_type <> 'B' THEN rec_type END AS rec_type,
    CASE WHEN rec_type <> 'B' THEN 'SYM' || substr('ABCDE', CAST(user_id % 5 AS INTEGER) + 1, 1) END AS symbol,
    CASE WHEN rec_type <> 'B' THEN CASE WHEN user_id % 2 = 0 THEN 'NYSE' ELSE 'NASDAQ' END END AS exchange,
    CASE WHEN rec_type <> 'B' THEN ts END AS event_tm,
    CASE WHEN rec_type <> 'B' THEN event_seq_nb END AS event_seq_nb,
    CASE WHEN rec_type <> 'B' THEN arrival_tm END AS arrival_tm,
    CASE WHEN rec_type = 'T' THEN price END AS trade_pr,
    CASE WHEN rec_type = 'Q' THEN price END AS bid_pr,
    CASE WHEN rec_type = 'Q' THEN CAST(event_id % 100 + 1 AS INTEGER) END AS bid_size,
    CASE WHEN rec_type = 'Q' THEN CAST(price + 0.05 AS DECIMAL(9,2)) END AS ask_pr,
    CASE WHEN rec_type = 'Q' THEN CAST(event_id % 70 + 1 AS INTEGER) END AS ask_size,
    rec_type AS "partition"
  FROM deliveries)"""

_LATEST = (
    _DELIVERIES
    + """,
ranked AS (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb
    ORDER BY arrival_tm DESC) AS rn
  FROM typed WHERE "partition" <> 'B'),
latest AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1),
trades AS (SELECT * FROM latest WHERE rec_type = 'T'),
quotes AS (SELECT * FROM latest WHERE rec_type = 'Q')"""
)

_AVERAGES = (
    _LATEST
    + """,
averages AS (
  SELECT a.trade_dt, a.symbol, a.exchange, a.event_tm, a.event_seq_nb, a.trade_pr,
    SUM(b.trade_pr) AS total, COUNT(*) AS n
  FROM trades a LEFT JOIN trades b
    ON a.trade_dt = b.trade_dt AND a.symbol = b.symbol AND a.exchange = b.exchange
    AND b.event_tm BETWEEN a.event_tm - INTERVAL 30 MINUTE AND a.event_tm
  GROUP BY ALL)"""
)

_CLOSES = """,
closes AS (
  SELECT trade_dt, symbol, exchange, trade_pr AS close_pr FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY trade_dt, symbol, exchange ORDER BY event_tm DESC, event_seq_nb DESC) AS rn
    FROM trades)
  WHERE rn = 1)"""

# The last trade strictly before each quote. Of quotes at one instant the greatest sequence number
# is kept, and of trades at one instant too.
_ASOF = """,
resolved AS (
  SELECT * FROM (
    SELECT q.*, t.trade_pr AS last_trade_pr, t.total AS last_total, t.n AS last_n,
      ROW_NUMBER() OVER (
        PARTITION BY q.trade_dt, q.symbol, q.exchange, q.event_tm{each_quote}
        ORDER BY q.event_seq_nb DESC, t.event_tm DESC NULLS LAST, t.event_seq_nb DESC) AS pick
    FROM (SELECT * EXCLUDE (trade_pr) FROM quotes) q LEFT JOIN averages t
      ON q.trade_dt = t.trade_dt AND q.symbol = t.symbol AND q.exchange = t.exchange
      AND t.event_tm < q.event_tm)
  WHERE pick = 1)"""

_DATE = "CAST(trade_dt AS VARCHAR) AS trade_dt"
_AT = f"{_DATE}, symbol, exchange, event_tm, event_seq_nb"
_TRADE = f"{_AT}, rec_type, arrival_tm, CAST(trade_pr AS DOUBLE) AS trade_pr, \"partition\""
_SIDES = (
    "CAST(bid_pr AS DOUBLE) AS bid_pr, bid_size, CAST(ask_pr AS DOUBLE) AS ask_pr, ask_size"
)
_QUOTE = f'{_AT}, rec_type, arrival_tm, {_SIDES}, "partition"'
_EVENT = f"""{_DATE}, symbol, exchange, event_tm, CAST(event_seq_nb AS DOUBLE) AS event_seq_nb,
  rec_type, arrival_tm, CAST(trade_pr AS DOUBLE) AS trade_pr,
  CAST(bid_pr AS DOUBLE) AS bid_pr, CAST(bid_size AS DOUBLE) AS bid_size,
  CAST(ask_pr AS DOUBLE) AS ask_pr, CAST(ask_size AS DOUBLE) AS ask_size, "partition\""""


def _mean(total: str, n: str) -> str:
    """Mean of cents as text, rounded half up at eighteen decimals, by whole numbers only."""
    parts = f"(CAST({total} * 100 AS HUGEINT) * 10000000000000000)"
    mean = f"((2 * {parts} + {n}) // (2 * {n}))"
    one = "CAST(1000000000000000000 AS HUGEINT)"
    return (
        f"CAST({mean} // {one} AS VARCHAR) || '.' "
        f"|| lpad(CAST({mean} % {one} AS VARCHAR), 18, '0')"
    )


def _text(x: str) -> str:
    return f"""'"' || {x} || '"'"""


# Feed lines, built from the same deliveries.
_DAY = "strftime(ts, '%Y-%m-%d')"
_TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_ARRIVAL = "strftime(arrival_tm, '%Y-%m-%d %H:%M:%S.%f')"
_SYMBOL = "'SYM' || substr('ABCDE', CAST(user_id % 5 AS INTEGER) + 1, 1)"
_EXCHANGE = "CASE WHEN user_id % 2 = 0 THEN 'NYSE' ELSE 'NASDAQ' END"
_ASK = "CAST(CAST(price + 0.05 AS DECIMAL(9,2)) AS VARCHAR)"
_PRICE = "CAST(price AS VARCHAR)"


def _number(x: str) -> str:
    return f"CASE WHEN event_id % 4 = 0 THEN {x} ELSE {_text(x)} END"


def _json(rec_type: str, seq: str, rest: str) -> str:
    return (
        f"""'{{"trade_dt":"' || {_DAY} || '","file_tm":"' || {_ARRIVAL} """
        f"""|| '","event_type":"{rec_type}","symbol":"' || {_SYMBOL} """
        f"""|| '","event_tm":"' || {_TIME} || '","event_seq_nb":' || {seq} """
        f"""|| ',"exchange":"' || ({_EXCHANGE}) || '",' || {rest} || '}}'"""
    )


def _csv(rec_type: str, day: str, rest: str) -> str:
    return (
        f"""{day} || ',' || {_ARRIVAL} || ',{rec_type},' || {_SYMBOL} || ',' || {_TIME} """
        f"""|| ',' || CAST(event_seq_nb AS VARCHAR) || ',' || ({_EXCHANGE}) || ',' || {rest}"""
    )


_SEQ = "CAST(event_seq_nb AS VARCHAR)"
_BID_SIZE = "CAST(event_id % 100 + 1 AS VARCHAR)"
_ASK_SIZE = "CAST(event_id % 70 + 1 AS VARCHAR)"
_QUOTE_JSON = _json(
    "Q",
    _SEQ,
    f"""'"bid_pr":' || ({_number(_PRICE)}) || ',"bid_size":' || {_BID_SIZE} """
    f"""|| ',"ask_pr":' || ({_number(_ASK)}) || ',"ask_size":' || {_ASK_SIZE}""",
)
_TRADE_JSON = _json("T", _SEQ, f"""'"price":' || ({_number(_PRICE)})""")
_BROKEN_JSON = _json("T", _text("'many'"), f"""'"price":' || {_text(_PRICE)}""")
_QUOTE_CSV = _csv(
    "Q", _DAY, f"{_PRICE} || ',' || {_BID_SIZE} || ',' || {_ASK} || ',' || {_ASK_SIZE}"
)
_TRADE_CSV = _csv("T", _DAY, _PRICE)
_BROKEN_CSV = _csv("T", "'2024-02-30'", _PRICE)
_LINES = f"""{_DELIVERIES},
lines AS (
  SELECT rec_type, CASE
    WHEN rec_type = 'B' AND event_id % 4 = 0
      THEN '{{"trade_dt":"' || {_DAY} || '","event_type":"T"'
    WHEN rec_type = 'B' AND event_id % 4 = 1
      THEN {_DAY} || ',' || {_ARRIVAL} || ',T,' || {_SYMBOL}
    WHEN rec_type = 'B' AND event_id % 4 = 2 THEN {_BROKEN_JSON}
    WHEN rec_type = 'B' THEN {_BROKEN_CSV}
    WHEN rec_type = 'Q' AND event_id % 2 = 0 THEN {_QUOTE_JSON}
    WHEN rec_type = 'Q' THEN {_QUOTE_CSV}
    WHEN event_id % 2 = 0 THEN {_TRADE_JSON}
    ELSE {_TRADE_CSV} END AS value
  FROM deliveries)"""

_STATUS = """
status AS (
  SELECT CAST(event_id % 1000000000 AS INTEGER) AS job_status_id,
    'Step ' || event_type AS job_name, ts AS job_status_timestamp,
    CASE event_id % 3 WHEN 0 THEN 'Started' WHEN 1 THEN 'Success' ELSE 'Failed' END AS job_status,
    'job-' || CAST(user_id AS VARCHAR) AS job_id
  FROM events)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def oracle_sql() -> dict[str, str]:
    lines = _with(_LINES, "SELECT value FROM lines")
    events = _with(_DELIVERIES, f"SELECT {_EVENT} FROM typed")
    good = _with(_DELIVERIES, f"SELECT {_EVENT} FROM typed WHERE \"partition\" <> 'B'")
    trades = _with(_LATEST, f"SELECT {_TRADE} FROM trades")
    quotes = _with(_LATEST, f"SELECT {_QUOTE} FROM quotes")

    def raw(columns: str, rec_type: str, json: bool | None = None) -> str:
        parity = "" if json is None else f" AND event_id % 2 = {0 if json else 1}"
        where = f"rec_type = '{rec_type}'{parity}"
        return _with(_DELIVERIES, f"SELECT {columns} FROM typed WHERE {where}")

    def asof(each_quote: str, select: str, where: str = "") -> str:
        ctes = _AVERAGES + _CLOSES + _ASOF.format(each_quote=each_quote)
        return _with(ctes, f"SELECT {select} FROM resolved {where}")

    enriched = f"""
      {", ".join("q." + c for c in ("symbol", "exchange", "event_tm", "event_seq_nb"))},
      CAST(q.trade_dt AS VARCHAR) AS trade_dt,
      CAST(q.bid_pr AS DOUBLE) AS bid_pr, q.bid_size,
      CAST(q.ask_pr AS DOUBLE) AS ask_pr, q.ask_size,
      CAST(q.last_trade_pr AS DOUBLE) AS last_trade_pr,
      {_mean("q.last_total", "q.last_n")} AS last_mov_avg_pr,
      CAST(q.bid_pr - c.close_pr AS DOUBLE) AS bid_pr_mv,
      CAST(q.ask_pr - c.close_pr AS DOUBLE) AS ask_pr_mv
    FROM resolved q LEFT JOIN closes c
      ON q.trade_dt = c.trade_dt + 1 AND q.symbol = c.symbol AND q.exchange = c.exchange"""
    enrich_ctes = _AVERAGES + _CLOSES + _ASOF.format(each_quote="")
    enrich = _with(enrich_ctes, f"SELECT {enriched}")
    previous = f"CAST('{DATE}' AS DATE) - 1"

    found = {
        "read_raw_lines": lines,
        "read_lines_by_prefix_and_suffix": lines,
        "read_lines_of_part_files": lines,
        "read_events": events,
        "read_events_of_partitions": good,
        "parse_lines_by_format": _with(
            _DELIVERIES,
            """SELECT "partition", CASE WHEN event_id % 2 = 0 THEN 'json' ELSE 'csv' END AS format,
                 COUNT(*) AS events
               FROM typed GROUP BY ALL""",
        ),
        "parse_csv_quotes": raw(_QUOTE, "Q", json=False),
        "parse_csv_trades": raw(_TRADE, "T", json=False),
        "parse_json_quotes": raw(_QUOTE, "Q", json=True),
        "parse_json_trades": raw(_TRADE, "T", json=True),
        "quarantine_bad_lines": _with(
            _LINES,
            """SELECT rec_type AS "partition", CAST(NULL AS VARCHAR) AS any_value,
                 value AS raw_line
               FROM lines WHERE rec_type = 'B'""",
        ),
        "parse_events": events,
        "parse_times": _with(
            _DELIVERIES,
            f"""SELECT {_DATE}, event_seq_nb, arrival_tm,
                  CAST(extract(MICROSECOND FROM event_tm) AS BIGINT) AS event_micros,
                  CAST(extract(HOUR FROM event_tm) AS INTEGER) AS event_hour
                FROM typed WHERE "partition" <> 'B'""",
        ),
        "drop_bad": good,
        "project_trades": _with(
            _DELIVERIES,
            f"""SELECT {_AT}, arrival_tm, CAST(trade_pr AS DOUBLE) AS trade_pr
                FROM typed WHERE "partition" <> 'B'""",
        ),
        "split_trades": raw(_TRADE, "T"),
        "split_quotes": raw(_QUOTE, "Q"),
        "day_slice": f"{trades} WHERE trades.trade_dt = CAST('{DATE}' AS DATE)",
        "previous_day_slice": f"{trades} WHERE trades.trade_dt = {previous}",
        "lookup_symbols": _with(
            _LATEST + _CLOSES,
            f"""SELECT symbol, exchange, CAST(close_pr AS DOUBLE) AS close_pr FROM closes
                WHERE trade_dt = {previous} AND symbol IN ('SYMA', 'SYMB', 'SYMC')
                ORDER BY symbol, exchange""",
        ),
        "range_stats": _with(
            _LATEST,
            """SELECT CAST(q.trade_dt AS VARCHAR) AS trade_dt, q.symbol, q.exchange, q.event_tm,
                 q.event_seq_nb, COUNT(t.trade_pr) AS matches,
                 CAST(SUM(t.trade_pr) AS DOUBLE) AS match_sum
               FROM quotes q LEFT JOIN trades t
                 ON q.trade_dt = t.trade_dt AND q.symbol = t.symbol AND q.exchange = t.exchange
                 AND t.event_tm BETWEEN q.event_tm - INTERVAL 30 MINUTE AND q.event_tm
               GROUP BY q.trade_dt, q.symbol, q.exchange, q.event_tm, q.event_seq_nb""",
        ),
        "range_join": _with(
            _LATEST,
            """SELECT CAST(q.trade_dt AS VARCHAR) AS trade_dt, q.symbol, q.exchange, q.event_tm,
                 q.event_seq_nb, CAST(q.bid_pr AS DOUBLE) AS bid_pr, t.event_tm AS match_event_tm,
                 CAST(t.event_seq_nb AS DOUBLE) AS match_event_seq_nb,
                 CAST(t.trade_pr AS DOUBLE) AS match_trade_pr
               FROM quotes q LEFT JOIN trades t
                 ON q.trade_dt = t.trade_dt AND q.symbol = t.symbol AND q.exchange = t.exchange
                 AND t.event_tm BETWEEN q.event_tm - INTERVAL 30 MINUTE AND q.event_tm""",
        ),
        "asof_last_trade": asof(
            "", f"{_AT}, {_SIDES}, CAST(last_trade_pr AS DOUBLE) AS last_trade_pr"
        ),
        "asof_last_trade_all_quotes": asof(
            ", q.event_seq_nb", f"{_QUOTE}, CAST(last_trade_pr AS DOUBLE) AS last_trade_pr"
        ),
        "price_moves": _with(
            _LATEST + _CLOSES,
            f"""SELECT CAST(q.trade_dt AS VARCHAR) AS trade_dt, q.symbol, q.exchange, q.event_tm,
                  q.event_seq_nb, q.rec_type, q.arrival_tm, {_SIDES}, q."partition",
                  CAST(q.bid_pr - c.close_pr AS DOUBLE) AS bid_pr_mv,
                  CAST(q.ask_pr - c.close_pr AS DOUBLE) AS ask_pr_mv
                FROM quotes q LEFT JOIN closes c
                  ON q.trade_dt = c.trade_dt AND q.symbol = c.symbol AND q.exchange = c.exchange""",
        ),
        "trailing_avg": _with(
            _AVERAGES,
            f"""SELECT CAST(t.trade_dt AS VARCHAR) AS trade_dt, t.symbol, t.exchange, t.event_tm,
                  t.event_seq_nb, t.rec_type, t.arrival_tm, CAST(t.trade_pr AS DOUBLE) AS trade_pr,
                  t."partition", {_mean("a.total", "a.n")} AS mov_avg_trade_pr
                FROM trades t JOIN averages a
                  USING (trade_dt, symbol, exchange, event_tm, event_seq_nb)""",
        ),
        "leading_avg": _with(
            _LATEST
            + """,
            ahead AS (
              SELECT *, SUM(trade_pr) OVER w AS total, COUNT(*) OVER w AS n FROM trades
              WINDOW w AS (PARTITION BY symbol, exchange ORDER BY event_tm DESC
                RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW))""",
            f"SELECT {_TRADE}, {_mean('total', 'n')} AS moving_average FROM ahead",
        ),
        "event_counts": _with(
            _DELIVERIES, 'SELECT "partition", COUNT(*) AS events FROM typed GROUP BY "partition"'
        ),
        "latest_delivery": _with(_LATEST, f"SELECT {_EVENT} FROM latest"),
        "closing_price": _with(
            _LATEST + _CLOSES,
            f"SELECT {_DATE}, symbol, exchange, CAST(close_pr AS DOUBLE) AS close_pr FROM closes",
        ),
        "preview": _with(
            _LATEST,
            f"SELECT {_TRADE} FROM trades ORDER BY trades.event_tm, event_seq_nb LIMIT 100",
        ),
        "write_events": _with(
            _DELIVERIES,
            """SELECT "partition", COUNT(*) AS events, COUNT(symbol) AS with_symbol
               FROM typed GROUP BY "partition\"""",
        ),
        "write_trades_by_day": trades,
        "write_quotes_by_day": quotes,
        "write_enriched_by_day": enrich,
        "job_report": _with(
            _STATUS,
            """SELECT * FROM status WHERE job_id IN ('job-3', 'job-8', 'job-46', 'job-101')
               ORDER BY job_status_timestamp, job_status_id""",
        ),
        "recent_status": _with(
            _STATUS,
            """SELECT * FROM status
               ORDER BY job_status_timestamp DESC, job_status_id DESC LIMIT 100""",
        ),
        "first_status": _with(_STATUS, "SELECT * FROM status ORDER BY job_status_id LIMIT 10"),
        "ingest": events,
        "preprocess_trades": trades,
        "preprocess_quotes": quotes,
        "late_trades": trades,
        "late_quotes": quotes,
        "step_counts": _with(
            enrich_ctes,
            f"""SELECT step, counted, CAST(n AS BIGINT) AS n FROM (
                  SELECT 'ingest' AS step, unnest(['lines', 'trades', 'quotes', 'bad']) AS counted,
                    unnest([COUNT(*), COUNT(*) FILTER (rec_type = 'T'), COUNT(*) FILTER (rec_type = 'Q'),
                      COUNT(*) FILTER ("partition" = 'B')]) AS n
                  FROM typed
                  UNION ALL
                  SELECT 'preprocess', unnest(['trades_read', 'quotes_read']),
                    unnest([COUNT(*) FILTER (rec_type = 'T'), COUNT(*) FILTER (rec_type = 'Q')])
                  FROM typed
                  UNION ALL
                  SELECT 'preprocess', unnest(['trades', 'quotes']),
                    unnest([(SELECT COUNT(*) FROM trades), (SELECT COUNT(*) FROM quotes)])
                  UNION ALL
                  SELECT 'enrich', unnest(['enriched', 'with_trade', 'with_close']),
                    unnest([COUNT(*), COUNT(last_trade_pr), COUNT(bid_pr_mv)])
                  FROM (SELECT {enriched}))""",
        ),
        "enrich_quotes": enrich,
        "enrich_quotes_of_day": f"{enrich} WHERE q.trade_dt = CAST('{DATE}' AS DATE)",
    }
    # in time slots or not, the rows are the same
    busy = (
        "trailing_avg",
        "leading_avg",
        "range_join",
        "range_stats",
        "asof_last_trade",
        "asof_last_trade_all_quotes",
        "enrich_quotes",
    )
    ranged = ("asof_last_trade", "asof_last_trade_all_quotes", "enrich_quotes")
    return (
        found
        | {f"{name}_busy": found[name] for name in busy}
        | {f"{name}_ranged": found[name] for name in ranged}
    )
