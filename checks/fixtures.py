"""Feed events and feed lines derived in Spark from the whole ``events`` table (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.schema import BAD, EVENT_SCHEMA, JOB_STATUS_SCHEMA, QUOTE, TRADE

# The processing date of one-day queries.
DATE = "2024-01-15"


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def deliveries(events: DataFrame) -> DataFrame:
    """Every delivery of every event, in plain types, with the price in cents precision.

    Some trades and quotes are delivered a second time, later and at another price; some have a
    twin at the same instant with a greater sequence number.
    """
    rec_type = (
        F.when(F.col("event_type").isin("purchase", "signup"), TRADE)
        .when(F.col("event_type").isin("click", "view"), QUOTE)
        .otherwise(BAD)
    )
    seq = (F.col("event_id") % 1_000_000_000).cast("int")

    def delivery(sequence: Column, delay: int, extra: str) -> Column:
        return F.struct(
            sequence.alias("event_seq_nb"),
            (F.col("ts") + F.expr(f"INTERVAL '{delay}' SECOND")).alias("arrival_tm"),
            (F.col("value").cast("decimal(9,2)") + F.lit(extra).cast("decimal(9,2)"))
            .cast("decimal(9,2)")
            .alias("price"),
        )

    good = F.col("rec_type") != BAD
    none = F.array().cast(
        "array<struct<event_seq_nb:int,arrival_tm:timestamp_ntz,price:decimal(9,2)>>"
    )
    again = F.when(good & (F.col("event_id") % 10 == 0), F.array(delivery(seq, 5, "0.01")))
    twin = F.when(
        good & (F.col("event_id") % 50 == 1), F.array(delivery(seq + 10_000_000, 1, "0.02"))
    )
    return events.withColumn("rec_type", rec_type).select(
        "event_id",
        "rec_type",
        F.col("ts").cast("date").alias("trade_dt"),
        F.col("ts").alias("event_tm"),
        F.concat(
            F.lit("SYM"),
            F.substring(F.lit("ABCDE"), (F.col("user_id") % 5).cast("int") + 1, F.lit(1)),
        ).alias("symbol"),
        F.when(F.col("user_id") % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
        (F.col("event_id") % 100 + 1).cast("int").alias("bid_size"),
        (F.col("event_id") % 70 + 1).cast("int").alias("ask_size"),
        F.inline(
            F.concat(
                F.array(delivery(seq, 1, "0")),
                F.coalesce(again, none),
                F.coalesce(twin, none),
            )
        ),
    )


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as the parser should produce it."""
    rows = deliveries(source_events(spark, sf_dir))
    good = F.col("rec_type") != BAD
    trade, quote = F.col("rec_type") == TRADE, F.col("rec_type") == QUOTE
    price = F.col("price").cast("decimal(24,14)")
    ask = (F.col("price") + F.lit("0.05").cast("decimal(9,2)")).cast("decimal(24,14)")
    columns = {
        "trade_pr": F.when(trade, price),
        "bid_pr": F.when(quote, price),
        "bid_size": F.when(quote, F.col("bid_size")),
        "ask_pr": F.when(quote, ask),
        "ask_size": F.when(quote, F.col("ask_size")),
        "partition": F.col("rec_type"),
    }
    return rows.select(
        *[
            columns[f.name].alias(f.name)
            if f.name in columns
            else F.when(good, F.col(f.name)).alias(f.name)
            for f in EVENT_SCHEMA
        ]
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deliveries as feed lines: JSON for even event ids, CSV for odd ones."""
    rows = deliveries(source_events(spark, sf_dir))
    kind = F.col("event_id") % 4
    day = F.col("trade_dt").cast("string")

    def clock(name: str) -> Column:
        """All six fraction digits, which the cast leaves off where they are zero."""
        shortest = F.col(name).cast("string")
        whole = F.length(shortest) == 19
        return F.rpad(F.when(whole, F.concat(shortest, F.lit("."))).otherwise(shortest), 26, "0")

    time, arrival = clock("event_tm"), clock("arrival_tm")
    price = F.col("price").cast("string")
    ask = (F.col("price") + F.lit("0.05").cast("decimal(9,2)")).cast("string")

    def text(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def number(value: Column) -> Column:
        return F.when(kind == 0, value).otherwise(text(value))

    def json_line(rec_type: str, seq: Column, prices: dict[str, Column]) -> Column:
        fields = {
            "trade_dt": text(day),
            "file_tm": text(arrival),
            "event_type": F.lit(f'"{rec_type}"'),
            "symbol": text(F.col("symbol")),
            "event_tm": text(time),
            "event_seq_nb": seq,
            "exchange": text(F.col("exchange")),
            **prices,
        }
        members = [F.concat(F.lit(f'"{key}":'), value) for key, value in fields.items()]
        return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))

    def csv_line(rec_type: str, date: Column, *rest: Column) -> Column:
        return F.concat_ws(
            ",",
            date,
            arrival,
            F.lit(rec_type),
            "symbol",
            time,
            F.col("event_seq_nb").cast("string"),
            "exchange",
            *rest,
        )

    seq = F.col("event_seq_nb").cast("string")
    sizes = [F.col(c).cast("string") for c in ("bid_size", "ask_size")]
    quote_json = json_line(
        QUOTE,
        seq,
        {
            "bid_pr": number(price),
            "bid_size": sizes[0],
            "ask_pr": number(ask),
            "ask_size": sizes[1],
        },
    )
    trade_json = json_line(TRADE, seq, {"price": number(price)})
    is_json = F.col("event_id") % 2 == 0
    broken = (
        F.when(kind == 0, F.concat(F.lit('{"trade_dt":"'), day, F.lit('","event_type":"T"')))
        .when(kind == 1, F.concat_ws(",", day, arrival, F.lit(TRADE), "symbol"))
        .when(kind == 2, json_line(TRADE, F.lit('"many"'), {"price": text(price)}))
        .otherwise(csv_line(TRADE, F.lit("2024-02-30"), price))
    )
    line = (
        F.when(F.col("rec_type") == BAD, broken)
        .when((F.col("rec_type") == QUOTE) & is_json, quote_json)
        .when(F.col("rec_type") == QUOTE, csv_line(QUOTE, day, price, sizes[0], ask, sizes[1]))
        .when(is_json, trade_json)
        .otherwise(csv_line(TRADE, day, price))
    )
    return rows.select(line.alias("value"))


def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job history with one status row for each event."""
    columns = {
        "job_status_id": (F.col("event_id") % 1_000_000_000).cast("int"),
        "job_name": F.concat(F.lit("Step "), F.col("event_type")),
        "job_status_timestamp": F.col("ts"),
        "job_status": F.when(F.col("event_id") % 3 == 0, "Started")
        .when(F.col("event_id") % 3 == 1, "Success")
        .otherwise("Failed"),
        "job_id": F.concat(F.lit("job-"), F.col("user_id").cast("string")),
    }
    return source_events(spark, sf_dir).select(
        *[columns[f.name].alias(f.name) for f in JOB_STATUS_SCHEMA]
    )
