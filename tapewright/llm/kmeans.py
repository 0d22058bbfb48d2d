"""Centroid clustering of whole-number vectors, with exact assignments found through ns-bounds.

Every vector remembers, for each centroid, a distance that it once measured and the round of that
measurement. The centroids of past rounds are kept, so a remembered distance is loosened by the norm
of the centroid's total displacement since then, which is never more than the sum of its moves round
by round. A vector stays where its loosened upper bound is below every loosened lower bound. Where
that fails, first its own distance and then just the distances in doubt are measured, in whole
numbers, so that the result is the same as if all had been.

The vectors with their bounds are a table written once a round. A task sums its own vectors by
cluster before anything is shuffled, and one row for each cluster and component comes to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import bounded_batches
from tapewright.llm.integers import matrix, products, scaled
from tapewright.session import scratch_path

SCALE = 64
# Squared lengths of scaled vectors are below this, so that squared distances fit a long.
LARGEST = 1 << 60
# Centroids of past rounds kept for the workers. Older measurements are loosened once and for all,
# and count from the present round on.
HISTORY_BYTES = 32 << 20
# Relative room for rounding in bounds, which are kept in double precision.
SLACK = 1e-9

_STATE = "vec_id long, x array<long>, cluster int, seen array<double>, at array<int>, distance long, measured int"


@dataclass
class Clustering:
    """``members``: ``vec_id``, ``x``, ``cluster``, ``distance``; ``centroids``: one row each.

    ``measured`` has the number of distances measured in each round.
    """

    members: DataFrame
    centroids: np.ndarray
    measured: list[int]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``."""
    return (x**2).sum(1)[:, None] + (c**2).sum(1) - 2 * products(x, c)


class Bounds:
    """What the workers need in a round: the centroids now, and how far each is from its past."""

    def __init__(self, history: dict[int, np.ndarray], now: int, last: bool):
        self.now, self.last = now, last
        self.centroids = history[now]
        self.first = min(history)
        past = [history[r].astype(np.float64) for r in range(self.first, now + 1)]
        gone = [np.sqrt(((p - past[-1]) ** 2).sum(1)) * (1 + SLACK) for p in past]
        self.moved = np.stack(gone)

    def start(self, x: np.ndarray):
        far = squared(x, self.centroids)
        cluster = far.argmin(1)
        at = np.full(far.shape, self.now, np.int32)
        return cluster, np.sqrt(far), at, far[np.arange(len(x)), cluster], far.shape[1]

    def step(self, x: np.ndarray, cluster: np.ndarray, seen: np.ndarray, at: np.ndarray):
        n, k = seen.shape
        rows, own = np.arange(n), cluster
        moved = self.moved[at - self.first, np.arange(k)]
        low = seen * (1 - SLACK) - moved
        high = seen[rows, own] * (1 + SLACK) + moved[rows, own]
        distance = np.full(n, -1, np.int64)
        measured = np.zeros(n, np.int64)

        def in_doubt(some: np.ndarray) -> np.ndarray:
            doubt = low[some] <= high[some, None]
            doubt[np.arange(len(some)), own[some]] = False
            return doubt

        unsure = rows if self.last else rows[in_doubt(rows).any(1)]
        if len(unsure):
            # its own distance first, which often settles the rest
            gap = x[unsure] - self.centroids[own[unsure]]
            distance[unsure] = (gap * gap).sum(1)
            measured[unsure] += 1
            exact = np.sqrt(distance[unsure])
            seen[unsure, own[unsure]], at[unsure, own[unsure]] = exact, self.now
            high[unsure] = exact * (1 + SLACK)
            doubt = in_doubt(unsure)
            r, j = np.nonzero(doubt)
            found = np.full(doubt.shape, np.iinfo(np.int64).max)
            found[np.arange(len(unsure)), own[unsure]] = distance[unsure]
            for a in range(0, len(r), 1 << 16):
                rr, jj = r[a : a + (1 << 16)], j[a : a + (1 << 16)]
                gap = x[unsure[rr]] - self.centroids[jj]
                found[rr, jj] = (gap * gap).sum(1)
            seen[unsure[r], j], at[unsure[r], j] = np.sqrt(found[r, j]), self.now
            measured[unsure] += doubt.sum(1)
            cluster = cluster.copy()
            cluster[unsure] = found.argmin(1)  # of equal distances the smaller number
            distance[unsure] = found.min(1)
        return cluster, seen, at, distance, measured

    def folded(self, cluster, seen, at, oldest: int):
        """Bounds measured before round ``oldest`` loosened to the present round."""
        old = at < oldest
        if old.any():
            n, k = seen.shape
            rows = np.arange(n)
            moved = self.moved[at - self.first, np.arange(k)]
            sign = np.full(seen.shape, -1.0)
            sign[rows, cluster] = 1.0
            loose = np.maximum(seen * (1 + sign * SLACK) + sign * moved, 0)
            seen, at = np.where(old, loose, seen), np.where(old, self.now, at).astype(np.int32)
        return seen, at


def _seeds(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = (
        rows.where("vec_id IS NOT NULL")
        .select(key.alias("key"), "x")
        .orderBy("key", "x")
        .limit(k)
        .collect()
    )
    return np.array([r["x"] for r in first], np.int64)


def _assigned(rows: DataFrame, bounds: Bounds, oldest: int, k: int, dim: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(bounds)
    fresh = "seen" not in rows.columns

    def lists(a: np.ndarray, kind) -> pa.Array:
        offsets = pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1])
        return pa.ListArray.from_arrays(offsets, pa.array(a.ravel(), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"), dim)
            if fresh:
                cluster, seen, at, distance, per = own.start(x)
                measured = np.full(len(x), per)
            else:
                cluster = batch.column("cluster").to_numpy()
                seen = matrix(batch.column("seen"), k).copy()
                at = matrix(batch.column("at"), k).copy()
                cluster, seen, at, distance, measured = own.step(x, cluster, seen, at)
            seen, at = own.folded(cluster, seen, at, oldest)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("x"),
                    pa.array(cluster, pa.int32()),
                    lists(seen, pa.float64()),
                    lists(at, pa.int32()),
                    pa.array(distance, pa.int64()),
                    pa.array(measured, pa.int32()),
                ],
                ["vec_id", "x", "cluster", "seen", "at", "distance", "measured"],
            )

    return rows.mapInArrow(run, _STATE)


def _moved(members: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of each cluster's mean; a cluster without vectors stays where it is."""
    k, dim = centroids.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            x = matrix(batch.column("x"), dim)
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                n[c] += mine.sum()
                total[c] += x[mine].sum(0)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(n[held]), pa.array(list(total[held]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    parts = members.select("cluster", "x").mapInArrow(summed, "cluster int, n long, total array<long>")
    sums = (
        parts.select("cluster", "n", F.posexplode("total").alias("i", "x"))
        .groupBy("cluster", "i")
        .agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    )
    new = centroids.copy()
    for r in sums.collect():
        new[r["cluster"], r["i"]] = r["x"] // r["n"]
    return new


def cluster(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dim: int = 64,
    scale: int = SCALE,
    salt: str = "1:",
    vec_id: str = "vec_id",
    vector: str = "embedding",
    history_bytes: int = HISTORY_BYTES,
) -> Clustering:
    """Clusters of the vectors with ``dim`` components, each taken as floor(scale * component).

    Centroids start as the ``k`` vectors whose id, after ``salt``, has the smallest SHA-256 (equal
    ids by their components). Each round assigns every vector to the nearest centroid, ties to the
    smaller number, and moves each centroid to the floor of its vectors' mean; a last assignment
    follows. Null vectors, those of another length (empty ones too) and those with a null or
    non-finite component take no part, nor do vectors too long for whole-number distances
    (``LARGEST``). Rows without an id are clustered but start no centroid; if no row has an id,
    nothing is clustered. Rows that repeat an id are each a vector of their own. Fewer rows than
    ``k`` give as many centroids as rows; no row gives no cluster. Other columns are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = scaled(vectors, scale, LARGEST, vec_id, vector).where(F.size("x") == dim)
    start = _seeds(rows, k, salt)
    if not len(start):
        none = spark.createDataFrame([], "vec_id long, x array<long>, cluster int, distance long")
        return Clustering(none, np.zeros((0, dim), np.int64), [])
    k = len(start)
    kept = max(2, history_bytes // (8 * k * dim))  # rounds of the history
    history = {0: start}
    measured: list[int] = []
    state = rows
    for now in range(rounds + 1):
        last = now == rounds
        oldest = now + 2 - kept
        state = written(_assigned(state, Bounds(history, now, last), oldest, k, dim), "bounds")
        measured.append(state.agg(F.sum("measured").alias("n")).first()["n"] or 0)
        if not last:
            history[now + 1] = _moved(state, history[now])
            history = {r: c for r, c in history.items() if r >= oldest}
    return Clustering(state.select("vec_id", "x", "cluster", "distance"), history[rounds], measured)


def described(found: Clustering) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    One row for each cluster (``k`` at most) is broadcast.
    """
    spark = found.members.sparkSession
    sums = found.members.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()
    total = sum(r["n"] for r in sums)
    about = [
        (
            r["cluster"],
            r["n"],
            total,
            hashlib.sha256(",".join(map(str, found.centroids[r["cluster"]])).encode()).hexdigest(),
        )
        for r in sums
    ]
    each = spark.createDataFrame(
        about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.members.join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
