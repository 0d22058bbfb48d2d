"""Range joins reduced to statistics: count and sum of the rows within some minutes of each row.

The rows of a series within the last ``m`` minutes of a time ``t`` are those that have entered by
``t`` less those that have left before it. So instead of pairing rows, every fact is entered at
its own time and left ``m`` minutes later, and one running sum in time order gives the answer at
every row: the cost grows with the rows, not with the pairs.

A busy series is spread over many tasks: there the running sum is taken within a time slot and
starts from the sum over the slots before it. That sum is itself a running one over the slots of a
day, which starts from what the day before still holds: a series of any length is cut into days,
and no task follows it further. Facts at one instant are added up first, before the shuffle, so
that not even a busy instant ends up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from tapewright.functions.timegrid import DAY_SECONDS, SLOT_SECONDS, exact_mean, seconds, time_slot
from tapewright.operators.ranges import RANGE, Ranges, openings
from tapewright.operators.series import SPLIT_ROWS, Load, with_known
from tapewright.schema import DAY_SERIES, SERIES

# Order of rows at one instant: sums so far, facts entering, questions asked, facts leaving.
_BASE, _ENTER, _ASK, _LEAVE = 0, 1, 2, 3


def _require_exact(df: DataFrame, value: str) -> None:
    dtype = df.schema[value].dataType
    if not isinstance(dtype, DecimalType | IntegralType):
        raise TypeError(f"{value} must be decimal or integral for exact running sums, not {dtype}")


def entering_and_leaving(
    facts: DataFrame,
    n: Column,
    total: Column,
    keys: Sequence[str],
    time: str,
    shift: Column,
    steps: tuple[int, int] = (_ENTER, _LEAVE),
) -> DataFrame:
    """Two rows for each fact: as it is, and, with its measures negated, ``shift`` later.

    Adds ``_step``, ``_n`` and ``_total``; the second row has only these, the keys and the time.
    """
    others = [f for f in facts.schema if f.name not in (*keys, time)]
    enter = F.struct(
        time,
        *[f.name for f in others],
        F.lit(steps[0]).alias("_step"),
        n.alias("_n"),
        total.alias("_total"),
    )
    leave = F.struct(
        (F.col(time) + shift).alias(time),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in others],
        F.lit(steps[1]).alias("_step"),
        (-n).alias("_n"),
        (-total).alias("_total"),
    )
    return facts.select(*keys, F.inline(F.array(enter, leave)))


def _direction(minutes: int, ahead: bool) -> tuple[Column, int]:
    span = int(minutes) * 60
    return (-seconds(span), -1) if ahead else (seconds(span), 1)


def _within_series(
    facts: DataFrame,
    value: str,
    keys: Sequence[str],
    time: str,
    minutes: int,
    ahead: bool = False,
    askers: DataFrame | None = None,
) -> DataFrame:
    """Asking rows (by default the facts) plus ``_n`` and ``_total``, one task per series."""
    shift, _ = _direction(minutes, ahead)
    columns = [*keys, time] + ([value] if askers is not None else [])
    given = facts.select(*columns) if askers is not None else facts
    rows = entering_and_leaving(
        given,
        F.when(F.col(time).isNotNull() & F.col(value).isNotNull(), 1).otherwise(0),
        F.when(F.col(time).isNotNull(), F.col(value)),
        keys,
        time,
        shift,
    )
    asking = _ENTER
    if askers is not None:
        asking = _ASK
        rows = rows.drop(value).unionByName(
            askers.withColumn("_step", F.lit(_ASK)), allowMissingColumns=True
        )
    # Rows without a time come first in either direction, count for nothing and find nothing.
    by_time = F.desc_nulls_first(time) if ahead else F.asc_nulls_first(time)
    # A range frame takes in all facts of the row's own instant.
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(by_time, "_step")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    kept = (facts if askers is None else askers).columns
    return rows.select(
        *kept,
        "_step",
        F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_n"),
        F.sum("_total").over(so_far).alias("_total"),
    ).filter(F.col("_step") == asking)


def rolling_in_ranges(
    facts: DataFrame,
    value: str,
    keys: Sequence[str],
    ranges: Ranges,
    time: str = "event_tm",
    minutes: int = 30,
) -> DataFrame:
    """The facts plus ``_n`` and ``_total``, one task per cell of ``ranges``; keys are known.

    The running sum of a cell starts from the sum over the ranges before it: all that has entered
    there and not yet left.
    """
    _require_exact(facts, value)
    known = F.col(time).isNotNull() & F.col(value).isNotNull()
    rows = entering_and_leaving(
        facts,
        F.when(known, 1).otherwise(0),
        F.when(known, F.col(value)),
        keys,
        time,
        seconds(int(minutes) * 60),
    ).withColumn(RANGE, ranges.of(time))
    if ranges.starts:
        cells = rows.groupBy(*keys, RANGE).agg(
            F.max(F.col("_step") == _ENTER).alias("asked"),
            F.sum("_n").alias("_n"),
            F.sum("_total").cast(rows.schema["_total"].dataType).alias("_total"),
        )
        opened = openings(cells, keys, sums=["_n", "_total"])
        rows = rows.unionByName(opened.withColumn("_step", F.lit(_BASE)), allowMissingColumns=True)
    so_far = (
        Window.partitionBy(*keys, RANGE)
        .orderBy(F.asc_nulls_first(time), "_step")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.select(
        *facts.columns,
        "_step",
        F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_n"),
        F.sum("_total").over(so_far).alias("_total"),
    ).filter(F.col("_step") == _ENTER).drop("_step")


def rolling_instants(
    facts: DataFrame,
    value: str,
    keys: Sequence[str],
    time: str = "event_tm",
    minutes: int = 30,
    ahead: bool = False,
    probes: DataFrame | None = None,
    also: Sequence[Column] = (),
) -> DataFrame:
    """``_n`` and ``_total`` at each instant, for series of any size.

    An instant is a distinct (keys, time) of ``probes``, or of the facts themselves. ``also``
    lists further aggregates to take over the facts of one instant. The result keeps the slot
    number in ``_slot``. Keys and times are all known.
    """
    span = int(minutes) * 60
    width = gcd(span, SLOT_SECONDS)
    reach = span // width
    shift, toward = _direction(minutes, ahead)
    series = [*keys, "_slot"]

    slotted = facts.withColumn("_slot", time_slot(time, width))
    instants = slotted.groupBy(*series, time).agg(
        F.count(value).alias("n"), F.sum(value).alias("total"), *also
    )
    total_type = instants.schema["total"].dataType
    # Each instant enters in its own slot and leaves in the slot ``reach`` further on.
    rows = (
        entering_and_leaving(instants, F.col("n"), F.col("total"), keys, time, shift)
        .drop("n", "total")
        .withColumn("_slot", time_slot(time, width))
    )

    # What the slots before (or, looking ahead, after) hold when a slot begins: the same running
    # sum once more, over one entering and one leaving row for each slot. It runs within a day of
    # slots. What has entered in one day and leaves in a later one enters again where each of the
    # days in between, and the last, begins.
    def day_of(slot: Column) -> Column:
        return F.floor(slot / F.lit(day_slots)).cast("long")

    def slot_row(slot: Column, step: int, n: Column, total: Column) -> Column:
        return F.struct(
            slot.alias("_slot"), F.lit(step).alias("_step"), n.alias("_n"), total.alias("_total")
        )

    day_slots = DAY_SECONDS // width
    slots = slotted.groupBy(*series).agg(
        F.count(value).alias("n"), F.sum(value).alias("total")
    )
    n, total = F.col("n"), F.col("total")
    enters, leaves = F.col("_slot") + toward, F.col("_slot") + toward * (reach + 1)
    later = F.when(
        day_of(leaves) != day_of(enters),
        F.sequence(day_of(enters) + toward, day_of(leaves), F.lit(toward).cast("long")),
    ).otherwise(F.array().cast("array<bigint>"))
    begins = 0 if toward > 0 else day_slots - 1
    moves = F.concat(
        F.array(slot_row(enters, _BASE, n, total), slot_row(leaves, _BASE, -n, -total)),
        F.transform(later, lambda day: slot_row(day * day_slots + begins, _BASE, n, total)),
    )
    if probes is None:
        asking = _ENTER
        asks = slot_row(F.col("_slot"), _ASK, F.lit(0).cast("bigint"), F.lit(None).cast(total_type))
        slot_rows = slots.select(*keys, F.inline(F.concat(moves, F.array(asks))))
    else:
        asking = _ASK
        asked = probes.select(*keys, time_slot(time, width).alias("_slot"), time).distinct()
        rows = rows.unionByName(asked.withColumn("_step", F.lit(_ASK)), allowMissingColumns=True)
        slot_rows = slots.select(*keys, F.inline(moves)).unionByName(
            asked.select(*series).distinct().withColumn("_step", F.lit(_ASK)),
            allowMissingColumns=True,
        )
    by_slot = F.desc("_slot") if ahead else F.asc("_slot")
    before = (
        Window.partitionBy(*keys, "_day")
        .orderBy(by_slot, "_step")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    base = (
        slot_rows.withColumn("_day", day_of(F.col("_slot")))
        .select(
            *series,
            "_step",
            F.sum("_n").over(before).alias("_n"),
            F.sum("_total").over(before).alias("_total"),
        )
        .filter((F.col("_step") == _ASK) & (F.col("_n") != 0))
        .withColumn("_step", F.lit(_BASE))
    )

    # The base row has no time and comes first in either direction.
    by_time = F.desc_nulls_first(time) if ahead else F.asc_nulls_first(time)
    so_far = (
        Window.partitionBy(*series)
        .orderBy(by_time, "_step")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.unionByName(base, allowMissingColumns=True)
        .withColumn("_n", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
        .withColumn("_total", F.sum("_total").over(so_far))
        .filter(F.col("_step") == asking)
        .drop("_step")
    )


def _rolling(
    askers: DataFrame | None,
    facts: DataFrame,
    value: str,
    keys: Sequence[str],
    time: str,
    minutes: int,
    ahead: bool,
    split_rows: int,
    load: Load | None = None,
) -> DataFrame:
    """Asking rows (by default the facts) plus ``_n`` and ``_total``; null without known keys."""
    _require_exact(facts, value)
    tables = [facts] if askers is None else [askers, facts]
    at = [*keys, time]
    load = load or Load(keys, split_rows, *tables)
    columns = [*tables[0].columns, "_n", "_total"]

    def ordinary(*share: DataFrame) -> DataFrame:
        asking = None if askers is None else share[0]
        return _within_series(share[-1], value, keys, time, minutes, ahead, asking).select(*columns)

    def busy(*share: DataFrame) -> DataFrame:
        asking = None if askers is None else with_known(share[0], [time])
        timed = with_known(share[-1], [time])
        instants = rolling_instants(timed, value, keys, time, minutes, ahead, asking)
        # Adaptive execution splits an instant with very many asking rows.
        found = instants.select(*at, "_n", "_total")
        return share[0].join(found, at, "left").select(*columns)

    return load.apply(tables, ordinary, busy)


def range_stats(
    left: DataFrame,
    right: DataFrame,
    value: str,
    keys: Sequence[str] = DAY_SERIES,
    time: str = "event_tm",
    minutes: int = 30,
    split_rows: int = SPLIT_ROWS,
    load: Load | None = None,
) -> DataFrame:
    """Range left join reduced to statistics.

    For each left row, ``matches`` is the number of right rows of the same keys whose time is
    within ``minutes`` up to the left row's time (both ends included) and ``match_sum`` the sum of
    their ``value``. A left row without a match, or with a null key, is kept with 0 and null.
    Right rows with a null value do not count. Values are decimal or integral, so that sums are
    exact; others raise ``TypeError``. ``load`` (of ``keys``) is measured if it is not given.
    """
    found = _rolling(left, right, value, keys, time, minutes, False, split_rows, load)
    n = F.coalesce("_n", F.lit(0).cast("bigint"))
    return found.select(
        *left.columns, n.alias("matches"), F.when(n > 0, F.col("_total")).alias("match_sum")
    )


def average(value_type) -> Column:
    return exact_mean(F.col("_total"), F.col("_n"), value_type)


def trailing_avg(
    trades: DataFrame,
    minutes: int = 30,
    keys: Sequence[str] = DAY_SERIES,
    split_rows: int = SPLIT_ROWS,
    load: Load | None = None,
) -> DataFrame:
    """Trades plus ``mov_avg_trade_pr``: mean price over the last ``minutes``, both ends included.

    Expects trades without repeated deliveries. A trade with a null key or time has no average.
    Prices are decimal or integral; others raise ``TypeError``. ``load`` (of ``keys``) is measured
    if it is not given.
    """
    mean = average(trades.schema["trade_pr"].dataType).alias("mov_avg_trade_pr")
    return _rolling(
        None, trades, "trade_pr", keys, "event_tm", minutes, False, split_rows, load
    ).select(*trades.columns, mean)


def leading_avg(
    trades: DataFrame,
    minutes: int = 30,
    keys: Sequence[str] = SERIES,
    split_rows: int = SPLIT_ROWS,
    load: Load | None = None,
) -> DataFrame:
    """Trades plus ``moving_average``: mean price over the coming ``minutes``, both ends included.

    The default keys follow a series across midnight. Prices are decimal or integral;
    others raise ``TypeError``. ``load`` (of ``keys``) is measured if it is not given.
    """
    mean = average(trades.schema["trade_pr"].dataType).alias("moving_average")
    return _rolling(
        None, trades, "trade_pr", keys, "event_tm", minutes, True, split_rows, load
    ).select(*trades.columns, mean)
