"""Counts taken by the steps, late deliveries, and the layout of tables stored by day."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from checks.fixtures import event_lines, typed_events
from frames import make_quotes, make_trades

import tapewright as tw
from pyspark.sql import functions as F
from tapewright.schema import TRADE_SCHEMA

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed") / "data")
    event_lines(spark, SF_DIR).write.text(path)
    return path


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, "")
    try:
        result = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counts_are_those_stored_and_cost_no_job(spark, feed, tmp_path):
    events, tables, out = (f"{tmp_path}/{n}" for n in ("events", "tables", "out"))
    found, jobs = jobs_of(spark, "counted", lambda: tw.run_ingest(spark, feed, events))
    _, plain = jobs_of(
        spark, "plain", lambda: tw.write_events(tw.ingest(tw.read_raw_lines(spark, feed)), f"{tmp_path}/again")
    )
    assert jobs == plain
    stored = {r["partition"]: r["events"] for r in tw.event_counts(tw.read_events(spark, events)).collect()}
    assert found == {
        "lines": sum(stored.values()), "trades": stored["T"], "quotes": stored["Q"], "bad": stored["B"]
    }
    found = tw.run_preprocess(spark, events, tables)
    trades, quotes = tw.read_trades(spark, f"{tables}/trade"), tw.read_quotes(spark, f"{tables}/quote")
    assert found == {
        "trades_read": stored["T"], "trades": trades.count(), "quotes_read": stored["Q"], "quotes": quotes.count()
    }
    found = tw.run_enrich(spark, tables, out)
    enriched = tw.read_enriched(spark, out)
    assert found == {
        "enriched": enriched.count(),
        "with_trade": enriched.where("last_trade_pr IS NOT NULL").count(),
        "with_close": enriched.where("bid_pr_mv IS NOT NULL").count(),
    }
    assert found["enriched"] > found["with_close"] > 0


def stored_files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_late_deliveries(spark, tmp_path):
    events = typed_events(spark, SF_DIR)
    late_day = dt.date(2024, 1, 9)
    # all second deliveries of one day are late, and so are all events of another
    is_late = ((F.col("trade_dt") == late_day) & (F.col("arrival_tm") > F.col("event_tm") + F.expr("INTERVAL '1' SECOND"))) | (
        F.col("trade_dt") == dt.date(2024, 1, 20)
    )
    is_late = F.coalesce(is_late, F.lit(False))
    paths = {name: f"{tmp_path}/{name}" for name in ("first", "late", "all", "two", "one")}
    tw.write_events(events.where(~is_late), paths["first"])
    tw.write_events(events.where(is_late), paths["late"])
    tw.write_events(events, paths["all"])
    tw.run_preprocess(spark, paths["first"], paths["two"])
    before = stored_files(paths["two"])
    found = tw.run_late_deliveries(spark, paths["late"], paths["two"])
    tw.run_preprocess(spark, paths["all"], paths["one"])

    def same():
        for read, name in ((tw.read_trades, "trade"), (tw.read_quotes, "quote")):
            two, one = (read(spark, f"{paths[p]}/{name}") for p in ("two", "one"))
            assert sorted(map(str, two.collect())) == sorted(map(str, one.collect()))

    same()
    after = stored_files(paths["two"])
    late = tw.read_events(spark, paths["late"]).select("rec_type", "trade_dt").distinct().collect()
    folders = [f"{'trade' if r['rec_type'] == 'T' else 'quote'}/trade_dt={r['trade_dt']}/" for r in late]
    untouched = {f for f in before if not f.startswith(tuple(folders))}
    assert untouched and untouched < set(before)
    assert {f: after[f] for f in untouched} == {f: before[f] for f in untouched}
    assert not (set(before) - untouched) & set(after)
    days = F.col("trade_dt").isin([r["trade_dt"] for r in late if r["rec_type"] == "T"])
    assert found["trades"] == tw.read_trades(spark, f"{paths['one']}/trade").where(days).count()
    # once more, and with nothing new
    tw.run_late_deliveries(spark, paths["late"], paths["two"])
    same()
    tw.write_events(events.limit(0), f"{tmp_path}/none")
    kept = stored_files(paths["two"])
    assert set(tw.run_late_deliveries(spark, f"{tmp_path}/first", paths["two"])) == set(found)
    same()
    assert kept.keys() != stored_files(paths["two"]).keys()


def day_of_trades(spark, series, each):
    """Each series has ``each`` trades in the day; the first one ten times as many."""
    rows = spark.range(len(series) * each + 9 * each).select(
        F.lit(dt.date(2024, 1, 15)).alias("trade_dt"),
        F.lit("T").alias("rec_type"),
        F.element_at(F.array(*map(F.lit, series)), F.greatest(F.lit(1), F.col("id") / each - 8).cast("int")).alias("symbol"),
        F.lit("N").alias("exchange"),
        F.timestamp_micros(F.lit(1_705_310_000_000_000) + F.pmod(F.xxhash64("id"), F.lit(10**10))).cast("timestamp_ntz").alias("event_tm"),
        F.col("id").cast("int").alias("event_seq_nb"),
        F.lit(None).cast("timestamp_ntz").alias("arrival_tm"),
        F.lit(Decimal(5)).cast("decimal(24,14)").alias("trade_pr"),
        F.lit("T").alias("partition"),
    )
    return rows.select(*TRADE_SCHEMA.names)


def test_layout_inside_a_day(spark, tmp_path):
    series = [f"S{i:02}" for i in range(20)]
    trades = day_of_trades(spark, series, 100).repartition(4)
    path = f"{tmp_path}/trades"
    tw.write_by_day(trades, path, rows_per_file=150)
    assert tw.read_trades(spark, path).exceptAll(trades).count() == 0

    groups = []
    for file in sorted(Path(path).rglob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        table = pq.read_table(file, partitioning=None).to_pandas()
        assert len(table) <= 150
        assert table.sort_values(["symbol", "exchange", "event_tm"], kind="stable").index.tolist() == list(range(len(table)))
        for g in range(meta.num_row_groups):
            column = next(
                c for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == "symbol"
            )
            groups.append((column.statistics.min, column.statistics.max))
    holding = [sum(low <= s <= high for low, high in groups) for s in series]
    assert holding[0] >= 1_000 // 150  # the hot symbol goes over many files
    assert max(holding[1:]) <= 4 < len(groups) / 3  # of another, few row groups are read
    found = tw.lookup_symbols(tw.read_trades(spark, path), ["S07"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(symbol, [S07])" in plan or "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,S07)]" in plan
    assert found.count() == 100


def test_few_files_are_sorted_too(spark, tmp_path):
    for name, df, read in (("t", make_trades(spark), tw.read_trades), ("q", make_quotes(spark), tw.read_quotes)):
        tw.write_by_day(df, f"{tmp_path}/{name}", files=1)
        stored = [r for r in read(spark, f"{tmp_path}/{name}").where("symbol = 'HOT'").collect()]
        by_day = {}
        for r in stored:
            by_day.setdefault(r["trade_dt"], []).append(r["event_tm"])
        for times in by_day.values():
            known = [t for t in times if t is not None]
            assert known == sorted(known)
        assert read(spark, f"{tmp_path}/{name}").count() == df.count()
