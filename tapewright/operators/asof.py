"""As-of join: the last trade strictly before each quote.

Quotes and trades are put in one time order and the last trade seen is carried forward, so there
is no join and no pair of rows. Time is cut into ranges of about equal numbers of rows; where a
series has quotes in a range, it starts there from its last trade in the ranges before, found over
one row for each series and range. Series that are known to be busy can be split into time slots
in the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.functions.order import moment_order, sequence_order
from tapewright.functions.timegrid import time_slot
from tapewright.operators.ranges import RANGE, RANGE_ROWS, Ranges, openings
from tapewright.operators.series import Load, with_known
from tapewright.schema import DAY_SERIES, QUOTE_VALUES

# Order of rows at one instant. A trade at the quote's own instant comes after the quote.
CARRIED, QUOTED, TRADED, LEFT = 0, 1, 2, 3


def time_order(keys: Sequence[str], *within_instant: str):
    """Rows of a series up to the current one; rows without a time come first."""
    return (
        Window.partitionBy(*keys)
        .orderBy(F.asc_nulls_first("event_tm"), *within_instant)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def last_of_instant(keys: Sequence[str], *within_instant: str) -> Column:
    """Whether the next row in time order is of another instant or another kind (``_step``)."""
    following = Window.partitionBy(*keys).orderBy(
        F.asc_nulls_first("event_tm"), *within_instant
    )
    here = F.struct("event_tm", "_step")
    return ~F.lead(here).over(following).eqNullSafe(here)


def one_per_instant(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], time: str = "event_tm"
) -> DataFrame:
    """One row for each (keys, time): the one with the greatest sequence number.

    An unknown number is the smallest, and ties are settled by the values. Reduced within each
    task before the shuffle.
    """
    order = sequence_order(values)
    return df.groupBy(*keys, time).agg(
        F.max("event_seq_nb").alias("event_seq_nb"),
        *[F.max_by(v, order).alias(v) for v in values if v != "event_seq_nb"],
    )


def carry_last(
    quotes: DataFrame,
    instants: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str],
    opening: DataFrame | None = None,
) -> DataFrame:
    """Quotes plus the values of the last trade strictly before each, for series of any size.

    Both inputs have one row for each (keys, time); keys, and times of trades, are known.
    ``values`` maps trade columns to output names. ``opening`` (keys and further columns, one row for each keys) is attached to
    every quote of the same keys: it rides along as a row ahead of the first slot.
    """
    time = "event_tm"
    series = [*keys, "_slot"]
    attached = [c for c in opening.columns if c not in keys] if opening is not None else []

    def slotted(df: DataFrame) -> DataFrame:
        return df if "_slot" in df.columns else df.withColumn("_slot", time_slot(time))

    kept = quotes.columns
    quotes, trades = slotted(quotes), slotted(instants)
    payload = F.struct(*[F.col(v).alias(out) for v, out in values.items()]).alias("_trade")
    trade_rows = trades.select(*series, time, F.lit(TRADED).alias("_step"), payload)

    # One row per slot: where quotes are, and the last trade of each slot.
    slot_rows = (
        quotes.select(*series)
        .distinct()
        .withColumn("_step", F.lit(QUOTED))
        .unionByName(
            trades.groupBy(*series)
            .agg(*[F.max_by(v, time).alias(v) for v in values])
            .select(*series, F.lit(TRADED).alias("_step"), payload),
            allowMissingColumns=True,
        )
    )
    carried = ["_trade"]
    if opening is not None:
        carried.append("_opening")
        slot_rows = slot_rows.unionByName(
            opening.select(
                *keys, F.lit(CARRIED).alias("_step"), F.struct(*attached).alias("_opening")
            ),
            allowMissingColumns=True,
        )
    over_slots = (
        Window.partitionBy(*keys)
        .orderBy(F.asc_nulls_first("_slot"), "_step")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    start_rows = (
        slot_rows.select(
            *series,
            "_step",
            *[F.last(c, ignorenulls=True).over(over_slots).alias(c) for c in carried],
        )
        .filter(F.col("_step") == QUOTED)
        .dropna("all", subset=carried)
        .withColumn("_step", F.lit(CARRIED))
    )

    rows = (
        quotes.withColumn("_step", F.lit(QUOTED))
        .unionByName(trade_rows, allowMissingColumns=True)
        .unionByName(start_rows, allowMissingColumns=True)
    )
    so_far = time_order(series, "_step")
    return (
        rows.select(
            *kept,
            "_step",
            *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in carried],
        )
        .filter(F.col("_step") == QUOTED)
        .select(
            *kept,
            *[F.col("_trade").getField(out).alias(out) for out in values.values()],
            *[F.col("_opening").getField(c).alias(c) for c in attached],
        )
    )


def in_ranges(
    quotes: DataFrame,
    trades: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str],
    keep_all_quotes: bool,
    ranges: Ranges,
    settled_by: Sequence[str] | None = None,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Quotes plus the values of the last trade strictly before each, one task per cell of ``ranges``.

    Keys are known. ``settled_by`` lists the values that settle trades at one instant and number
    (default: all). ``opening`` (keys and further columns, one row for each keys) is attached to
    every quote of the same keys, as if it came first.
    """
    payload = F.struct(*[F.col(v).alias(out) for v, out in values.items()])
    attached = [c for c in opening.columns if c not in keys] if opening is not None else []
    carried = [c for c in QUOTE_VALUES if c in quotes.columns]
    asking = quotes.withColumns({"_step": F.lit(QUOTED), "_order": sequence_order(carried)})
    rows = asking.unionByName(
        trades.select(
            *keys,
            "event_tm",
            F.lit(TRADED).alias("_step"),
            sequence_order(list(settled_by or values)).alias("_order"),
            payload.alias("_trade"),
        ),
        allowMissingColumns=True,
    ).withColumn(RANGE, ranges.of())
    lasts = ["_trade"]
    firsts = None
    if opening is not None:
        lasts.append("_opening")
        firsts = opening.select(*keys, F.struct(*attached).alias("_opening"))
    if ranges.starts:
        # of a cell: whether there are quotes, and its last trade
        moment = F.when(F.col("_step") == TRADED, moment_order("event_tm", F.col("_order")))
        cells = rows.groupBy(*keys, RANGE).agg(
            F.max(F.col("_step") == QUOTED).alias("asked"),
            F.count(moment).alias("n"),
            *[F.max_by(F.col("_trade").getField(x), moment).alias(x) for x in values.values()],
        )
        cells = cells.select(
            *keys, RANGE, "asked", F.when(F.col("n") > 0, F.struct(*values.values())).alias("_trade")
        )
        if firsts is not None:
            before = firsts.withColumns({RANGE: F.lit(-1), "asked": F.lit(False)})
            cells = cells.unionByName(before, allowMissingColumns=True)
        opened = openings(cells, keys, lasts=lasts)
    else:
        opened = None if firsts is None else firsts.withColumn(RANGE, F.lit(0))
    if opened is not None:
        rows = rows.unionByName(opened.withColumn("_step", F.lit(CARRIED)), allowMissingColumns=True)
    cell, order = [*keys, RANGE], ("_step", "_order")
    so_far = time_order(cell, *order)
    chosen = F.lit(True) if keep_all_quotes else last_of_instant(cell, *order)
    return (
        rows.select(
            *quotes.columns,
            "_step",
            *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in lasts if c in rows.columns],
            chosen.alias("_chosen"),
        )
        .filter((F.col("_step") == QUOTED) & F.col("_chosen"))
        .select(
            *quotes.columns,
            *[F.col("_trade").getField(out).alias(out) for out in values.values()],
            *[F.col("_opening").getField(c).alias(c) for c in attached],
        )
    )


def asof_last_trade(
    quotes: DataFrame,
    trades: DataFrame,
    keys: Sequence[str] = DAY_SERIES,
    values: Mapping[str, str] | None = None,
    keep_all_quotes: bool = False,
    split_rows: int | None = None,
    load: Load | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """As-of left join of quotes to the last trade strictly before them.

    ``values`` maps trade columns to output names; by default the price, and the trailing average
    where the trades have it. Trades at one instant are settled by the greatest sequence number,
    an unknown one being the smallest, and then by their values. Quotes without an earlier trade, or with a null key, are kept with nulls.

    Quotes at one instant of a series become one row, the one with the greatest sequence number,
    with its key, time, sequence number, prices and sizes. With ``keep_all_quotes`` every quote
    stays, with all its columns.

    Series are followed through time ranges of about ``range_rows`` rows, so that none is too large
    for its task. With ``split_rows`` or a ``load`` of ``keys``, the series that are busy by these
    are worked on in time slots instead, and the others whole.
    """
    if values is None:
        usual = {"trade_pr": "last_trade_pr", "mov_avg_trade_pr": "last_mov_avg_pr"}
        values = {v: out for v, out in usual.items() if v in trades.columns}
    carried = [c for c in QUOTE_VALUES if c in quotes.columns]
    if not keep_all_quotes:
        quotes = quotes.select(*keys, "event_tm", "event_seq_nb", *carried)
    trades = with_known(trades, ["event_tm"])
    ranges = Ranges()
    if load is None and split_rows is None:
        ranges, load = Ranges.measured(quotes, trades, rows=range_rows), Load.light(keys)
    load = load or Load(keys, split_rows, quotes, trades)
    at = [*keys, "event_tm"]
    columns = [*quotes.columns, *values.values()]

    def ordinary(quotes: DataFrame, trades: DataFrame) -> DataFrame:
        return in_ranges(quotes, trades, keys, values, keep_all_quotes, ranges).select(*columns)

    def busy(quotes: DataFrame, trades: DataFrame) -> DataFrame:
        instants = one_per_instant(trades, keys, list(values))
        if not keep_all_quotes:
            asked = one_per_instant(quotes, keys, carried)
            return carry_last(asked, instants, keys, values).select(*columns)
        # Distinct instants are resolved and joined back; adaptive execution splits an instant
        # with very many quotes.
        found = carry_last(quotes.select(*at).distinct(), instants, keys, values)
        return quotes.join(found, at, "left").select(*columns)

    def unknown(quotes: DataFrame) -> DataFrame:
        return quotes if keep_all_quotes else one_per_instant(quotes, keys, carried)

    return load.apply([quotes, trades], ordinary, busy, unknown)
