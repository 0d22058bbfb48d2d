"""The physical plans that make the operators hold at scale."""

from checks.fixtures import event_lines
from frames import make_quotes, make_trades

import tapewright as tw
from pyspark.sql.types import StructField, StructType
from tapewright.operators import series
from tapewright.schema import DAY_SERIES, SERIES

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_parsing_is_one_narrow_stage_in_the_jvm(spark):
    plan = physical(tw.parse_events(event_lines(spark, SF_DIR)))
    assert "Exchange" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_a_filter_does_not_parse_every_line_twice(spark):
    plan = physical(tw.split_trades(tw.drop_bad(tw.parse_events(event_lines(spark, SF_DIR)))))
    assert plan.count("from_json") == 2  # of every line, and of the doubtful ones


def test_dedupe_reduces_before_its_only_shuffle(spark):
    plan = physical(tw.latest_delivery(make_trades(spark)))
    assert shuffles(plan) == 1
    assert "partial_max" in plan.split("Exchange")[1]


def test_close_reduces_before_its_only_shuffle(spark):
    plan = physical(tw.closing_price(make_trades(spark)))
    assert shuffles(plan) == 1
    assert "partial_max_by" in plan.split("Exchange")[1]
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


def declared(spark, df):
    """Rows without nulls, and a schema that says so."""
    schema = StructType([StructField(f.name, f.dataType, False) for f in df.schema])
    return spark.createDataFrame(df.dropna().collect(), schema)


def test_null_keys_are_always_planned_for(spark):
    for split_rows in (10**6, 0):
        plan = physical(tw.trailing_avg(make_trades(spark).dropna(), split_rows=split_rows))
        assert "Union" in plan and "isnull" in plan


def test_a_given_load_is_not_measured_again(spark):
    trades, quotes = make_trades(spark), make_quotes(spark)
    for load in (series.Load(DAY_SERIES, 15, quotes, trades), series.Load.light(DAY_SERIES)):
        spark.sparkContext.setJobGroup("operators", "")
        averages = tw.trailing_avg(trades, load=load)
        found = tw.asof_last_trade(quotes, averages, load=load)
        tw.enrich_quotes(trades, quotes, load=load)
        tw.range_stats(quotes, trades, "trade_pr", load=load)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("operators")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert found.count() == tw.asof_last_trade(quotes, tw.trailing_avg(trades)).count()


def test_ordinary_series_take_one_shuffle_and_no_join(spark):
    trades, quotes = declared(spark, make_trades(spark)), declared(spark, make_quotes(spark))
    for result in (
        tw.trailing_avg(trades),
        tw.leading_avg(trades),
        tw.range_stats(quotes, trades, "trade_pr"),
        tw.asof_last_trade(quotes, trades),
        tw.asof_last_trade(quotes, trades, keep_all_quotes=True),
    ):
        plan = physical(result)
        assert shuffles(plan) == 1, plan
        assert "Join" not in plan and "Python" not in plan


def test_enrichment_takes_one_shuffle_of_quotes_and_no_join(spark):
    plan = physical(
        tw.enrich_quotes(declared(spark, make_trades(spark)), declared(spark, make_quotes(spark)))
    )
    assert shuffles(plan) == 2  # the other is that of the closes, one row for each series
    assert "Join" not in plan
    # one sort for all windows over the quotes; the closing price needs none
    above_the_union = plan.split("Union")[0]
    assert above_the_union.count("Sort [") == 1


def test_busy_series_are_spread_by_time_slot(spark):
    trades, quotes = make_trades(spark), make_quotes(spark)
    plan = physical(tw.enrich_quotes(trades, quotes, split_rows=15))
    assert "_slot" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_window_follows_a_series_beyond_a_day_of_slots(spark):
    """Windows over slots are cut by day, and windows over instants by slot."""
    trades = make_trades(spark)
    for result in (
        tw.leading_avg(trades, split_rows=0),
        tw.trailing_avg(trades, keys=SERIES, split_rows=0),
        tw.range_stats(make_quotes(spark), trades, "trade_pr", keys=SERIES, split_rows=0),
    ):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "+- Window" in line or ":- Window" in line]
        busy = [line for line in windows if "_slot" in line]
        assert busy
        for line in busy:
            spec = line.split("windowspecdefinition(")[1].split(" ASC")[0].split(" DESC")[0]
            keys = [part.strip().split("#")[0] for part in spec.split(",")]
            assert keys[:2] == list(SERIES) and keys[2] in ("_day", "_slot"), line


def test_load_brings_one_row_to_the_driver(spark):
    load = series.Load(["symbol"], 3, make_trades(spark), make_quotes(spark))
    assert load._has_busy
    empty = series.Load(["symbol"], 3, make_trades(spark).limit(0))
    assert not load._busy.isEmpty() and not empty._has_busy


def test_empty_inputs(spark):
    trades, quotes = make_trades(spark).limit(0), make_quotes(spark).limit(0)
    assert tw.enrich_quotes(trades, quotes).count() == 0
    assert tw.trailing_avg(trades).count() == 0
    some = make_quotes(spark)
    for split_rows in (10**6, 0):
        found = tw.asof_last_trade(some, trades, keep_all_quotes=True, split_rows=split_rows)
        assert found.count() == some.count()
