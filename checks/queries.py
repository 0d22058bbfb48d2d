"""One query for each operator, over whole tables. ``checks.oracles`` has the same in SQL.

Dates and averages are shown as text and prices as doubles, so that both engines give one and the
same value. The ``_busy`` queries work on all but the smallest series in time slots.
"""

from __future__ import annotations

from collections.abc import Callable

import tapewright as tw
from checks.fixtures import DATE, event_lines, job_status, typed_events
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType
from tapewright.schema import BAD, QUOTE, SERIES, TRADE
from tapewright.session import scratch_path

JOB_IDS = ("job-3", "job-8", "job-46", "job-101")
SYMBOLS = ("SYMA", "SYMB", "SYMC")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame) -> DataFrame:
    """Prices as doubles, averages as text with all their decimals, dates as text."""

    def plain(name: str) -> Column:
        dtype = df.schema[name].dataType
        column = F.col(name)
        if isinstance(dtype, DecimalType):
            column = column.cast("string" if dtype.scale > 14 else "double")
        elif isinstance(dtype, DateType):
            column = column.cast("string")
        return column.alias(name)

    return df.select(*[plain(name) for name in df.columns])


def shown_events(df: DataFrame) -> DataFrame:
    """The same for tables of trades, quotes and bad lines together: whole numbers, null in some
    rows, as doubles, since data frames of the two engines mark a null integer differently."""
    shown_df = shown(df)
    whole = [name for name, dtype in shown_df.dtypes if dtype == "int"]
    return shown_df.withColumns({name: F.col(name).cast("double") for name in whole})


def trades_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tw.preprocess(typed_events(spark, sf_dir))[0]


def quotes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tw.preprocess(typed_events(spark, sf_dir))[1]


# Sources


def _stored_lines(spark: SparkSession, sf_dir: str) -> str:
    """A feed folder: text files in two nested folders, and the same lines where they must not
    be read (another suffix, another prefix).

    The lines are made once: one write deals them to the two folders, from which the others are
    copied. Lines that are null go to a folder of their own, which nothing reads.
    """
    root = scratch_path(spark, "feed")
    json = F.col("value").startswith("{")
    at = F.when(json, "data-json").when(~json, "data-csv").alias("at")
    lines = event_lines(spark, sf_dir).select("value", at, F.lit(1).alias("part"))
    lines.write.partitionBy("at", "part").text(root)
    tw.read_raw_lines(spark, f"{root}/at=data-json").write.csv(f"{root}/at=data-decoy")
    tw.read_raw_lines(spark, f"{root}/at=data-csv").write.text(f"{root}/at=other")
    return root


@query
def read_raw_lines(spark, sf_dir):
    target = scratch_path(spark, "lines")
    event_lines(spark, sf_dir).write.text(target)
    return tw.read_raw_lines(spark, target)


@query
def read_lines_by_prefix_and_suffix(spark, sf_dir):
    return tw.read_raw_lines(spark, f"{_stored_lines(spark, sf_dir)}/at=data*", glob="*.txt")


@query
def read_lines_of_part_files(spark, sf_dir):
    root = _stored_lines(spark, sf_dir)
    return tw.read_raw_lines(spark, [f"{root}/at=data-json", f"{root}/at=data-csv"], glob="part-*")


def _stored_events(spark: SparkSession, sf_dir: str) -> str:
    target = scratch_path(spark, "events")
    tw.write_events(typed_events(spark, sf_dir), target)
    return target


@query
def read_events(spark, sf_dir):
    return shown_events(tw.read_events(spark, _stored_events(spark, sf_dir)))


@query
def read_events_of_partitions(spark, sf_dir):
    return shown_events(tw.read_events(spark, _stored_events(spark, sf_dir), [TRADE, QUOTE]))


# Parsing


def _parsed(spark: SparkSession, sf_dir: str, json: bool | None = None) -> DataFrame:
    lines = event_lines(spark, sf_dir)
    if json is not None:
        is_json = F.col("value").startswith("{")
        lines = lines.filter(is_json if json else ~is_json)
    return tw.parse_events(lines)


@query
def parse_lines_by_format(spark, sf_dir):
    as_json, as_csv = (
        tw.event_counts(_parsed(spark, sf_dir, json)).withColumn("format", F.lit(name))
        for json, name in ((True, "json"), (False, "csv"))
    )
    return as_json.unionByName(as_csv)


@query
def parse_csv_quotes(spark, sf_dir):
    return shown(tw.split_quotes(_parsed(spark, sf_dir, json=False)))


@query
def parse_csv_trades(spark, sf_dir):
    return shown(tw.split_trades(_parsed(spark, sf_dir, json=False)))


@query
def parse_json_quotes(spark, sf_dir):
    return shown(tw.split_quotes(_parsed(spark, sf_dir, json=True)))


@query
def parse_json_trades(spark, sf_dir):
    return shown(tw.split_trades(_parsed(spark, sf_dir, json=True)))


@query
def quarantine_bad_lines(spark, sf_dir):
    bad = tw.parse_events(event_lines(spark, sf_dir), keep_raw=True).filter(
        F.col("partition") == BAD
    )
    nulls = [c for c in bad.columns if c not in ("partition", "raw_line")]
    return bad.select("partition", F.coalesce(*[F.col(c).cast("string") for c in nulls])
                      .alias("any_value"), "raw_line")


@query
def parse_events(spark, sf_dir):
    return shown_events(_parsed(spark, sf_dir))


@query
def parse_times(spark, sf_dir):
    """Times through text and back: whole and fraction seconds of each event and arrival."""
    good = tw.drop_bad(_parsed(spark, sf_dir))
    return good.select(
        F.col("trade_dt").cast("string").alias("trade_dt"),
        "event_seq_nb",
        "arrival_tm",
        F.expr("CAST(extract(SECOND FROM event_tm) * 1000000 AS BIGINT)").alias("event_micros"),
        F.expr("extract(HOUR FROM event_tm)").alias("event_hour"),
    )


# Filters and projections


@query
def drop_bad(spark, sf_dir):
    return shown_events(tw.drop_bad(typed_events(spark, sf_dir)))


@query
def project_trades(spark, sf_dir):
    return shown(tw.project_trades(tw.drop_bad(typed_events(spark, sf_dir))))


@query
def split_trades(spark, sf_dir):
    return shown(tw.split_trades(typed_events(spark, sf_dir)))


@query
def split_quotes(spark, sf_dir):
    return shown(tw.split_quotes(typed_events(spark, sf_dir)))


@query
def day_slice(spark, sf_dir):
    return shown(tw.day_slice(trades_of(spark, sf_dir), DATE))


@query
def previous_day_slice(spark, sf_dir):
    return shown(tw.day_slice(trades_of(spark, sf_dir), tw.previous_day(DATE)))


@query
def lookup_symbols(spark, sf_dir):
    close = tw.closing_price(
        tw.day_slice(trades_of(spark, sf_dir), tw.previous_day(DATE))
    )
    return shown(tw.lookup_symbols(close, SYMBOLS))


# Joins


def _shown_stats(spark, sf_dir, **options):
    """Trades in the thirty minutes up to each quote."""
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    stats = tw.range_stats(quotes, trades, "trade_pr", **options)
    return shown(
        stats.select(
            "trade_dt", *SERIES, "event_tm", "event_seq_nb", "matches",
            F.col("match_sum").cast("decimal(20,2)").alias("match_sum"),
        )
    )


@query
def range_stats(spark, sf_dir):
    return _shown_stats(spark, sf_dir)


def _shown_pairs(spark, sf_dir, **options):
    """Each quote with each trade of the thirty minutes up to it."""
    columns = ("trade_dt", *SERIES, "event_tm", "event_seq_nb")
    # shown before they are paired, once for each row and not for each pair
    quotes = shown(quotes_of(spark, sf_dir).select(*columns, "bid_pr"))
    trades = shown(trades_of(spark, sf_dir).select(*columns, "trade_pr"))
    # null in some rows: shown as doubles, as in shown_events()
    trades = trades.withColumn("event_seq_nb", F.col("event_seq_nb").cast("double"))
    return tw.range_join(quotes, trades, **options)


@query
def range_join(spark, sf_dir):
    return _shown_pairs(spark, sf_dir)


@query
def range_join_busy(spark, sf_dir):
    return _shown_pairs(spark, sf_dir, split_pairs=2)


@query
def asof_last_trade(spark, sf_dir):
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.asof_last_trade(quotes, trades))


@query
def asof_last_trade_all_quotes(spark, sf_dir):
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.asof_last_trade(quotes, trades, keep_all_quotes=True))


@query
def price_moves(spark, sf_dir):
    """Every quote against the close of its own day."""
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    keys = ("trade_dt", *SERIES)
    return shown(tw.price_moves(quotes, tw.closing_price(trades, keys), keys))


# Aggregates and windows


@query
def trailing_avg(spark, sf_dir):
    return shown(tw.trailing_avg(trades_of(spark, sf_dir)))


@query
def leading_avg(spark, sf_dir):
    return shown(tw.leading_avg(trades_of(spark, sf_dir)))


@query
def event_counts(spark, sf_dir):
    return tw.event_counts(typed_events(spark, sf_dir))


@query
def latest_delivery(spark, sf_dir):
    return shown_events(tw.latest_delivery(tw.drop_bad(typed_events(spark, sf_dir))))


@query
def closing_price(spark, sf_dir):
    """Close of every day."""
    return shown(tw.closing_price(trades_of(spark, sf_dir), ("trade_dt", *SERIES)))


@query
def preview(spark, sf_dir):
    return shown(tw.preview(trades_of(spark, sf_dir), ["event_tm", "event_seq_nb"], 100))


# Sinks


@query
def write_events(spark, sf_dir):
    target = _stored_events(spark, sf_dir)
    stored = spark.read.parquet(target)  # partition folders discovered, nothing declared
    return stored.groupBy("partition").agg(
        F.count(F.lit(1)).alias("events"), F.count("symbol").alias("with_symbol")
    )


@query
def write_trades_by_day(spark, sf_dir):
    target = scratch_path(spark, "trades")
    tw.write_by_day(trades_of(spark, sf_dir), target)
    return shown(tw.read_trades(spark, target))


@query
def write_quotes_by_day(spark, sf_dir):
    target = scratch_path(spark, "quotes")
    tw.write_by_day(quotes_of(spark, sf_dir), target, files=4)
    return shown(tw.read_quotes(spark, target))


@query
def write_enriched_by_day(spark, sf_dir):
    target = scratch_path(spark, "enriched")
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    tw.write_by_day(tw.enrich_quotes(trades, quotes), target)
    return shown(tw.read_enriched(spark, target))


# Busy series: the slot branch of each operator, for all series with more rows than given


@query
def trailing_avg_busy(spark, sf_dir):
    return shown(tw.trailing_avg(trades_of(spark, sf_dir), split_rows=12))


@query
def leading_avg_busy(spark, sf_dir):
    return shown(tw.leading_avg(trades_of(spark, sf_dir), split_rows=40))


@query
def range_stats_busy(spark, sf_dir):
    return _shown_stats(spark, sf_dir, split_rows=30)


@query
def asof_last_trade_busy(spark, sf_dir):
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.asof_last_trade(quotes, trades, split_rows=30))


@query
def asof_last_trade_all_quotes_busy(spark, sf_dir):
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.asof_last_trade(quotes, trades, keep_all_quotes=True, split_rows=30))


@query
def enrich_quotes_busy(spark, sf_dir):
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.enrich_quotes(trades, quotes, split_rows=30))


# The same through many time ranges, as for tables of any size


@query
def asof_last_trade_ranged(spark, sf_dir):
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.asof_last_trade(quotes, trades, range_rows=500))


@query
def asof_last_trade_all_quotes_ranged(spark, sf_dir):
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.asof_last_trade(quotes, trades, keep_all_quotes=True, range_rows=500))


@query
def enrich_quotes_ranged(spark, sf_dir):
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.enrich_quotes(trades, quotes, range_rows=500))


# Job history


@query
def job_report(spark, sf_dir):
    return tw.job_report(job_status(spark, sf_dir), JOB_IDS)


@query
def recent_status(spark, sf_dir):
    return tw.recent_status(job_status(spark, sf_dir), 100)


@query
def first_status(spark, sf_dir):
    return tw.first_status(job_status(spark, sf_dir), 10)


# The three steps


@query
def ingest(spark, sf_dir):
    """Feed files to stored events, read back."""
    source, target = scratch_path(spark, "feed"), scratch_path(spark, "events")
    event_lines(spark, sf_dir).write.text(source)
    tw.run_ingest(spark, source, target)
    return shown_events(tw.read_events(spark, target))


@query
def preprocess_trades(spark, sf_dir):
    return shown(tw.preprocess(_parsed(spark, sf_dir))[0])


@query
def preprocess_quotes(spark, sf_dir):
    return shown(tw.preprocess(_parsed(spark, sf_dir))[1])


def _merged(spark, sf_dir, name):
    """Two feeds, one after the other: second deliveries come late, into tables already stored."""
    events = typed_events(spark, sf_dir)
    is_late = F.col("arrival_tm") > F.col("event_tm") + F.expr("INTERVAL '1' SECOND")
    feeds = [scratch_path(spark, "events") for _ in range(2)]
    for path, late in zip(feeds, (False, True)):
        tw.write_events(events.where(is_late if late else ~is_late), path)
    target = scratch_path(spark, "tables")
    tw.run_preprocess(spark, feeds[0], target)
    tw.run_late_deliveries(spark, feeds[1], target)
    return f"{target}/{name}"


@query
def late_trades(spark, sf_dir):
    return shown(tw.read_trades(spark, _merged(spark, sf_dir, "trade")))


@query
def late_quotes(spark, sf_dir):
    return shown(tw.read_quotes(spark, _merged(spark, sf_dir, "quote")))


@query
def step_counts(spark, sf_dir):
    """The counts that the steps take while they write."""
    feed, events, tables, enriched = (
        scratch_path(spark, name) for name in ("feed", "events", "tables", "enriched")
    )
    event_lines(spark, sf_dir).write.text(feed)
    counts = [
        ("ingest", tw.run_ingest(spark, feed, events)),
        ("preprocess", tw.run_preprocess(spark, events, tables)),
        ("enrich", tw.run_enrich(spark, tables, enriched)),
    ]
    rows = [(step, name, n) for step, found in counts for name, n in found.items()]
    return spark.createDataFrame(rows, "step string, counted string, n long")


@query
def enrich_quotes(spark, sf_dir):
    """Enriched quotes of every day at once, from typed events."""
    quotes, trades = quotes_of(spark, sf_dir), trades_of(spark, sf_dir)
    return shown(tw.enrich_quotes(trades, quotes))


@query
def enrich_quotes_of_day(spark, sf_dir):
    """All three steps, from feed files to the enriched quotes of the processing date."""
    feed, events, tables, enriched = (
        scratch_path(spark, name) for name in ("feed", "events", "tables", "enriched")
    )
    event_lines(spark, sf_dir).write.text(feed)
    tw.run_ingest(spark, feed, events)
    tw.run_preprocess(spark, events, tables)
    tw.run_enrich(spark, tables, enriched, DATE)
    return shown(tw.read_enriched(spark, enriched))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
