"""Parquet tables: events stored by partition, trades, quotes and enriched quotes stored by day."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tapewright.schema import ENRICHED_SCHEMA, EVENT_SCHEMA, QUOTE_SCHEMA, TRADE_SCHEMA

# Order of rows inside a table stored by day.
WITHIN_DAY = ("trade_dt", "symbol", "exchange", "event_tm")
ROWS_PER_FILE = 4_000_000


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    # A given schema spares the footer-reading job and keeps folder values from being guessed at.
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_events(
    spark: SparkSession,
    path: str,
    rec_types: Sequence[str] | None = None,
    keep_raw: bool = False,
) -> DataFrame:
    """Events, optionally of chosen partitions only: the other folders are not read.

    With ``keep_raw`` also ``raw_line``, null where it was not stored.
    """
    schema = StructType([*EVENT_SCHEMA, StructField("raw_line", StringType())])
    events = _read(spark, path, schema if keep_raw else EVENT_SCHEMA)
    if rec_types is None:
        return events
    return events.filter(F.col("partition").isin(list(rec_types)))


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TRADE_SCHEMA)


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, QUOTE_SCHEMA)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ENRICHED_SCHEMA)


def write_events(events: DataFrame, path: str) -> None:
    """Overwrite ``path`` with the events, one folder per partition; needs no shuffle."""
    events.write.partitionBy("partition").mode("overwrite").parquet(path)


def write_by_day(
    df: DataFrame,
    path: str,
    files: int | None = None,
    only_days_present: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
    last: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Overwrite ``path`` with ``df``, one folder per trading day.

    By default rows are ranged and sorted by day, symbol, exchange and time, in files of at most
    ``rows_per_file`` rows. A day of any size is spread over many tasks, and so is a hot symbol; a
    file or a row group holds few symbols, or a stretch of time of one, and a reader that looks for
    some symbols skips the others by the statistics that Parquet keeps. ``files`` instead writes
    with that many tasks and no shuffle, sorted within each, which also limits the stage that
    computes ``df``: for small results. ``only_days_present`` replaces just the days that ``df``
    holds and leaves other days alone; then ``df`` may be read from ``path`` itself. ``last`` is
    applied to the rows as they are about to be written.
    """
    order = [c for c in WITHIN_DAY if c in df.columns]
    laid_out = df.repartitionByRange(*order) if files is None else df.coalesce(files)
    overwrite = "dynamic" if only_days_present else "static"
    (
        last(laid_out.sortWithinPartitions(*order))
        .write.partitionBy("trade_dt")
        .mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )
