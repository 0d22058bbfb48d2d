"""The range join against pairing every row with every other."""

import datetime as dt
from collections import Counter

import pytest
from frames import START, make_quotes, make_trades
from pyspark.sql import functions as F

from tapewright import range_join
from tapewright.operators import pairing
from tapewright.schema import DAY_SERIES, SERIES

SPLITS = [pairing.SPLIT_PAIRS, 40, 1]


def plain(left, right, keys, minutes, how):
    names = [c for c in right.columns if c not in keys]
    rows, out = right.collect(), Counter()
    for a in left.collect():
        found = [
            tuple(b[c] for c in names)
            for b in rows
            if a["event_tm"] is not None
            and b["event_tm"] is not None
            and all(a[k] is not None and a[k] == b[k] for k in keys)
            and dt.timedelta(0) <= a["event_tm"] - b["event_tm"] <= dt.timedelta(minutes=minutes)
        ]
        if not found and how == "left":
            found = [(None,) * len(names)]
        out.update((*a, *b) for b in found)
    return out


@pytest.mark.parametrize("split_pairs", SPLITS)
@pytest.mark.parametrize(("how", "keys", "minutes"), [("left", DAY_SERIES, 30), ("inner", SERIES, 7), ("left", SERIES, 90)])
def test_against_brute_force(spark, how, keys, minutes, split_pairs):
    left, right = make_quotes(spark, 3, 90, untidy=True), make_trades(spark, 4, 90, untidy=True)
    result = range_join(left, right, keys, minutes=minutes, how=how, split_pairs=split_pairs)
    others = [f"match_{c}" for c in right.columns if c not in keys]
    assert result.columns == [*left.columns, *others]
    assert Counter(map(tuple, result.collect())) == plain(left, right, keys, minutes, how)


@pytest.mark.parametrize("split_pairs", SPLITS)
def test_a_table_with_itself_and_repeated_rows(spark, split_pairs):
    trades = make_trades(spark, 5, 40)
    twice = trades.unionByName(trades)
    found = range_join(twice, twice, split_pairs=split_pairs)
    assert Counter(map(tuple, found.collect())) == plain(twice, twice, DAY_SERIES, 30, "left")


def test_empty_sides(spark):
    quotes, trades = make_quotes(spark, 1, 20), make_trades(spark, 1, 20)
    assert range_join(quotes.limit(0), trades).count() == 0
    alone = range_join(quotes, trades.limit(0))
    assert alone.count() == 20 and alone.where("match_event_tm IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        range_join(quotes, trades, how="outer")


def hot(spark, n_left, n_right):
    """One series, one instant."""
    row = "'2024-01-14' AS d, 'HOT' AS symbol, 'NYSE' AS exchange, TIMESTAMP_NTZ'{}' AS event_tm, id"
    frames = [
        spark.range(n).selectExpr(*row.format(at).split(", "))
        for n, at in ((n_left, START + dt.timedelta(minutes=29)), (n_right, START))
    ]
    return frames


def sent_rows(spark, monkeypatch, left, right, **options):
    """Rows on both sides of the join, and pairs that come out of it."""
    sides = []
    alias = type(left).alias
    monkeypatch.setattr(type(left), "alias", lambda df, name: sides.append(df) or alias(df, name))
    pairs = range_join(left, right, SERIES, **options)
    monkeypatch.undo()
    return sum(side.count() for side in sides), pairs.count()


def test_a_hot_bucket_is_split_and_rows_are_linear_in_pairs(spark, monkeypatch):
    left, right = hot(spark, 400, 30)
    sent, pairs = sent_rows(spark, monkeypatch, left, right, split_pairs=1_000)
    assert pairs == 400 * 30
    salts = 400 * 30 // 1_000
    assert sent <= 400 + 2 * 30 + 30 * salts <= 400 + 2 * 30 + pairs
    hot_list = pairing._hot_buckets(
        *(df.withColumn("_bucket", pairing.time_slot("event_tm", 1_800)) for df in (left, right)),
        [*SERIES, "_bucket"],
        1_000,
    )
    assert [r["_salts"] for r in hot_list.collect()] == [salts]
    # no more salts than left rows
    sent, pairs = sent_rows(spark, monkeypatch, *hot(spark, 3, 500), split_pairs=1)
    assert pairs == 3 * 500 and sent <= 3 + 4 * 500


def test_what_is_sent_grows_with_rows_where_few_pairs_are_asked_for(spark, monkeypatch):
    for n in (100, 400):
        sent, pairs = sent_rows(spark, monkeypatch, *hot(spark, n, n), split_pairs=2)
        assert pairs == n * n
        assert 4 * n <= sent <= 3 * n + 2 * 2 * n  # salted still
    # a bucket too large for one task is split all the same
    monkeypatch.setattr(pairing, "SPLIT_PAIRS", 1_000)
    left, right = hot(spark, 100, 100)
    sent, pairs = sent_rows(spark, monkeypatch, left, right, split_pairs=2)
    assert pairs == 100 * 100 and sent == 100 + 100 + 100 * 10


def test_tasks_are_as_many_as_the_pairs_need(spark, monkeypatch):
    monkeypatch.setattr(pairing, "TASK_PAIRS", 100, raising=False)
    series = "concat('S', id % 40) AS symbol", "concat('X', id % 3) AS exchange"
    left, right = [
        spark.range(1_200).selectExpr(*series, f"TIMESTAMP_NTZ'{at}' + id % 2 * INTERVAL '1' DAY AS event_tm", "id")
        for at in (START + dt.timedelta(minutes=29), START)
    ]
    for split_pairs in (pairing.SPLIT_PAIRS, 10):
        pairs = range_join(left, right, SERIES, split_pairs=split_pairs)
        tasks = pairs.groupBy(F.spark_partition_id()).count().collect()
        assert sum(t["count"] for t in tasks) == 120 * 10 * 10
        assert len(tasks) > 30  # of 120
    untidy = [make_quotes(spark, 3, 90, untidy=True), make_trades(spark, 4, 90, untidy=True)]
    found = range_join(*untidy, SERIES, minutes=90)
    assert Counter(map(tuple, found.collect())) == plain(*untidy, SERIES, 90, "left")


def test_plan(spark):
    quotes, trades = make_quotes(spark), make_trades(spark)
    for split_pairs in SPLITS:
        plan = range_join(quotes, trades, split_pairs=split_pairs)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
