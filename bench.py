"""Timings of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Each query runs once to warm up and then twice for the better time, all of its rows computed; the
time includes building the query and the job that measures how busy the series are. ``baseline_*``
input, result brought to the driver (as Arrow).
"""

from __future__ import annotations

import json
import os
import time

import tapewright as tw
from checks import queries as catalogue
from checks.session import local_session
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tapewright.schema import SERIES

HEADLINE = (
    "parse_events",
    "latest_delivery",
    "closing_price",
    "trailing_avg",
    "leading_avg",
    "range_stats",
    "asof_last_trade",
    "asof_last_trade_all_quotes",
    "price_moves",
    "preprocess_quotes",
    "enrich_quotes",
    "enrich_quotes_of_day",
)


def baseline_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    is_trade = F.col("event_type").isin("purchase", "signup")
    rows = events.select(
        F.concat(F.lit("SYM"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
        F.when(F.col("user_id") % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
        F.col("ts").alias("event_tm"),
        F.col("event_id").cast("int").alias("event_seq_nb"),
        F.col("value").cast("decimal(9,2)").cast("decimal(24,14)").alias("price"),
        is_trade.alias("is_trade"),
    )
    trades = rows.filter("is_trade").drop("is_trade").withColumnRenamed("price", "trade_pr")
    quotes = rows.filter("NOT is_trade").drop("is_trade").withColumnRenamed("price", "bid_pr")
    return trades.cache(), quotes.cache()


def timed(run) -> float:
    run()
    times = []
    for _ in range(2):
        start = time.monotonic()
        run()
        times.append(time.monotonic() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    trades, quotes = baseline_inputs(spark, sf_dir)
    trades.count(), quotes.count()

    seconds = {
        "baseline_trailing_avg": timed(lambda: tw.trailing_avg(trades, keys=SERIES).toArrow()),
        "baseline_asof_last_trade": timed(
            lambda: tw.asof_last_trade(
                quotes, tw.trailing_avg(trades, keys=SERIES), keys=SERIES
            ).toArrow()
        ),
    }
    queries = catalogue.queries()
    for name in HEADLINE:
        seconds[name] = timed(
            lambda run=queries[name]: run(spark, sf_dir)
            .write.format("noop")
            .mode("overwrite")
            .save()
        )
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
