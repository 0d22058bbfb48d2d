"""Feed lines to the stored event table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.operators.parsing import parse_events
from tapewright.plans.counting import ROWS, Counts
from tapewright.schema import BAD, QUOTE, TRADE
from tapewright.sources.lines import read_raw_lines
from tapewright.sources.tables import write_events


def ingest(lines: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Typed events from feed lines, bad lines set aside in partition ``B``."""
    return parse_events(lines, keep_raw)


def run_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    glob: str = "*.txt",
    recursive: bool = True,
    keep_raw: bool = False,
) -> Mapping[str, int]:
    """Read feed files under ``source`` and store their events under ``target``.

    With ``keep_raw`` the text of bad lines is stored with them, in a column ``raw_line``. Returns
    the number of ``lines``, and of ``trades``, ``quotes`` and ``bad`` lines among them, counted
    while they are written.
    """
    counts, kind = Counts(), F.col("partition")
    events = counts.of(
        ingest(read_raw_lines(spark, source, glob, recursive), keep_raw),
        lines=ROWS,
        trades=kind == TRADE,
        quotes=kind == QUOTE,
        bad=kind == BAD,
    )
    write_events(events, target)
    return counts.taken()
