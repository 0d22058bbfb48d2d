"""Range join: each row with every row of the same keys within some minutes before it.

Both sides are dealt to time buckets as wide as the range. A right row is found from its own bucket
and from the next one, so it is sent to both; keys and bucket then make an equi join, after which
the exact range is checked. Sending a right row to two buckets is all that is sent twice, unless a
bucket would give more than ``SPLIT_PAIRS`` pairs. The left rows of such a bucket are salted, and
its right rows sent to every salt: a salt has as many pairs as one task may make, or one left row.

Where fewer pairs are asked for, a bucket has no more salts than ``COPIES`` times its rows are sent
for, or than keep a salt at ``SPLIT_PAIRS``: what is sent grows with the rows, and not with the pairs.

Pairs may be many more than rows, so the tasks of the join are as many as the pairs need, whatever
the size of what is sent.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.functions.timegrid import seconds, time_slot
from tapewright.operators.series import with_known, with_unknown
from tapewright.schema import DAY_SERIES

# Pairs of one bucket (those before the exact range is checked) from which its left rows are salted.
SPLIT_PAIRS = 20_000_000
# Rows that salting may send for each row of a bucket with no more pairs than ``SPLIT_PAIRS``.
COPIES = 2
# Hot buckets that are brought to the driver and sent to every task; more stay a table.
HOT_BUCKETS = 10_000
# Pairs for one task of the join, and the most tasks it is given.
TASK_PAIRS = 20_000_000
MAX_TASKS = 20_000
_BUCKET, _SALT, _SALTS, _SINCE = "_bucket", "_salt", "_salts", "_since"


def _bucket_pairs(left: DataFrame, right: DataFrame, at: Sequence[str], split_pairs: int) -> DataFrame:
    """``at``, ``pairs`` and ``_salts`` of the buckets with left rows, one pair at least for each.

    Counts are taken within tasks first, over the key and time columns alone.
    """
    counts = [
        side.groupBy(*at).agg(F.count(F.lit(1)).alias(n)) for side, n in ((left, "l"), (right, "r"))
    ]
    both = counts[0].join(counts[1], list(at), "left").withColumn("r", F.coalesce("r", F.lit(1)))
    pairs = F.col("l").cast("double") * F.col("r")
    cheap = F.floor((F.col("l") + F.col("r")) * F.lit(float(COPIES)) / F.col("r"))
    most = F.greatest(cheap, F.ceil(pairs / SPLIT_PAIRS))
    salts = F.least(F.col("l"), F.ceil(pairs / split_pairs), most).cast("int").alias(_SALTS)
    return both.select(*at, pairs.alias("pairs"), salts)


def _measured(
    left: DataFrame, right: DataFrame, at: Sequence[str], split_pairs: int
) -> tuple[DataFrame | None, float]:
    """``at`` and ``_salts`` of the buckets to be split, as they have more pairs than ``split_pairs``
    (None without any), and the pairs of all buckets."""
    buckets = _bucket_pairs(left, right, at, split_pairs)
    split = F.col(_SALTS) > 1
    total = buckets.agg(F.sum("pairs").alias("pairs"), F.count(F.when(split, 1)).alias("hot")).first()
    hot = buckets.where(split).select(*at, _SALTS)
    if not total["hot"]:
        hot = None
    elif total["hot"] <= HOT_BUCKETS:
        hot = F.broadcast(left.sparkSession.createDataFrame(hot.collect(), hot.schema))
    return hot, total["pairs"] or 0.0


def _hot_buckets(left: DataFrame, right: DataFrame, at: Sequence[str], split_pairs: int) -> DataFrame | None:
    return _measured(left, right, at, split_pairs)[0]


def range_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = DAY_SERIES,
    time: str = "event_tm",
    minutes: int = 30,
    prefix: str = "match_",
    how: str = "left",
    split_pairs: int = SPLIT_PAIRS,
) -> DataFrame:
    """Pairs of left and right rows with the same keys and the right row's time within ``minutes``
    up to the left row's, both ends included.

    A pair has the left row's columns, then the right row's without the keys, ``prefix`` before
    their names. A left row without a match, or with a null key or time, is kept once with nulls;
    with ``how="inner"`` it is left out. Rows that repeat pair up each for itself.

    One job measures the buckets (see above); where up to ``HOT_BUCKETS`` are to be split, a second
    one fetches them. Identical left rows share a salt.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how is left or inner, not {how}")
    width = int(minutes) * 60
    known = [*keys, time]
    at = [*keys, _BUCKET]
    others = [c for c in right.columns if c not in keys]
    bucket = time_slot(time, width)
    since = F.col(time) - seconds(width)
    asking = with_known(left, known).withColumn(_BUCKET, bucket).withColumn(_SINCE, since)
    found = with_known(right, known).select(
        *keys, *[F.col(c).alias(prefix + c) for c in others], F.lit(0).alias(_SALT), bucket.alias("_own")
    )
    found = found.withColumn(_BUCKET, F.explode(F.array("_own", F.col("_own") + 1))).drop("_own")

    hot, n_pairs = _measured(asking, found, at, split_pairs)
    on = list(at)
    if hot is None:
        found = found.drop(_SALT)
    else:
        on.append(_SALT)
        own = F.pmod(F.xxhash64(*left.columns), F.coalesce(_SALTS, F.lit(1))).cast("int")
        every = F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)
        asking = asking.join(hot, at, "left").withColumn(_SALT, own).drop(_SALTS)
        found = found.join(hot, at, "left").withColumn(_SALT, F.explode(every)).drop(_SALTS)

    if n_pairs > TASK_PAIRS:
        # left to Spark, the tasks would be as many as the bytes need that are sent
        tasks = max(
            int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            min(MAX_TASKS, math.ceil(n_pairs / TASK_PAIRS)),
        )
        asking, found = asking.repartition(tasks, *on), found.repartition(tasks, *on)

    asking, found = asking.alias("l"), found.alias("r")
    then = F.col(f"r.{prefix}{time}")
    met = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in on]
    met.append(then.between(F.col(f"l.{_SINCE}"), F.col(f"l.{time}")))
    columns = [*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{prefix}{c}") for c in others]]
    pairs = asking.join(found, met, how).select(*columns)
    if how == "inner":
        return pairs
    return pairs.unionByName(with_unknown(left, known), allowMissingColumns=True)
