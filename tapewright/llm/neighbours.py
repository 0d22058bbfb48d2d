"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

A bounded sample is split by balanced bisection into clusters of equal size; their centroids and a
graph between them are small enough to broadcast. Every vector goes to the list of its nearest
centroid, and vectors near a boundary to several. A query searches the centroids through the graph,
drops those much farther than the nearest, and reads the lists that are left. Inner products become
distances by one more coordinate, which brings every vector to the length of the longest.

Equal vectors are searched once: of a group of copies, the lists hold one row, and results name as
many of its smallest ids as can ever be asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewright.llm.columns import bounded_batches, col
from tapewright.session import scratch_path

SAMPLE_ROWS = 20_000
LIST_ROWS = 160  # vectors of a list, as planned
MAX_LISTS = 4_096
REPLICAS, REPLICA_RATIO = 4, 1.15
APART = 0.3  # of its distance: a further list this close to a chosen one is passed over
PROBES, PROBE_RATIO = 80, 1.25
BLOCK_ROWS = 16_384  # more vectors of a list are worked on in blocks
BLOCK_QUERIES = 4_096
DEGREE, BEAM, ASSIGN_BEAM = 16, 96, 48


@dataclass
class Centroids:
    """Centroids (with the extra coordinate), their graph, and the length of the longest vector."""

    points: np.ndarray
    links: np.ndarray
    starts: np.ndarray
    length: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.length**2 - (vectors**2).sum(1), 0)
        return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)

    def aimed(self, queries: np.ndarray) -> np.ndarray:
        size = np.sqrt((queries**2).sum(1))
        scaled = queries * (self.length / size)[:, None]
        return np.concatenate([scaled, np.zeros((len(queries), 1))], axis=1)

    def search(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroids first, and their distances; -1 and infinity fill short rows.

        Best-first search from the start points, all rows of the batch one step at a time.
        """
        n, k = len(points), len(self.points)
        beam = min(beam, k)
        seen = np.zeros((n, k), bool)
        ids = np.full((n, beam), -1)
        far = np.full((n, beam), np.inf)
        done = np.ones((n, beam), bool)

        def offer(rows: np.ndarray, new: np.ndarray) -> None:
            fresh = (new >= 0) & ~seen[rows[:, None], new]
            # one of equal ids in a row is enough
            order = np.sort(np.where(fresh, new, -1), axis=1)
            order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
            fresh = order >= 0
            r, _ = np.nonzero(fresh)
            seen[rows[r], order[fresh]] = True
            gap = np.full(order.shape, np.inf)
            delta = self.points[order[fresh]] - points[rows[r]]
            gap[fresh] = np.sqrt(np.einsum("ij,ij->i", delta, delta))
            all_ids = np.concatenate([ids[rows], order], axis=1)
            all_far = np.concatenate([far[rows], gap], axis=1)
            all_done = np.concatenate([done[rows], ~fresh], axis=1)
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[rows] = np.take_along_axis(all_ids, best, 1)
            far[rows] = np.take_along_axis(all_far, best, 1)
            done[rows] = np.take_along_axis(all_done, best, 1)

        offer(np.arange(n), np.broadcast_to(self.starts, (n, len(self.starts))))
        while True:
            rows = np.flatnonzero(~done.all(1))
            if not len(rows):
                return ids, far
            at = np.argmax(~done[rows], axis=1)
            done[rows, at] = True
            offer(rows, self.links[ids[rows, at]])


def _bisected(points: np.ndarray, size: int, r: np.random.Generator) -> list[np.ndarray]:
    """Rows of clusters of ``size`` to twice as many, halved again and again by two means."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) < 2 * size:
            out.append(rows)
            continue
        own = points[rows]
        pick = own[r.choice(len(own), min(len(own), 2_048), replace=False)]
        a, b = pick[0], pick[np.argmax(((pick - pick[0]) ** 2).sum(1))]
        for _ in range(6):
            side = ((pick - a) ** 2).sum(1) - ((pick - b) ** 2).sum(1)
            half = side <= np.median(side)
            if half.all() or not half.any():
                break
            a, b = pick[half].mean(0), pick[~half].mean(0)
        side = ((own - a) ** 2).sum(1) - ((own - b) ** 2).sum(1)
        order = np.argsort(side, kind="stable")
        todo += [rows[order[: len(order) // 2]], rows[order[len(order) // 2 :]]]
    return out


def centroids(sample: np.ndarray, length: float, total: int, seed: int = 11) -> Centroids:
    """Centroids for ``total`` vectors from a sample of them."""
    r = np.random.default_rng(seed)
    lifted = Centroids(np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), length).lifted(sample)
    lists = max(1, min(MAX_LISTS, total // LIST_ROWS, len(sample) // 4))
    groups = _bisected(lifted, max(1, len(sample) // (2 * lists)), r)
    points = np.stack([lifted[g].mean(0) for g in groups])
    k = len(points)
    links = np.full((k, DEGREE), -1)
    for a in range(0, k, 512):
        part = points[a : a + 512]
        gap = (part**2).sum(1)[:, None] + (points**2).sum(1) - 2 * part @ points.T
        near = np.argsort(gap, axis=1, kind="stable")[:, 1 : DEGREE - 3]
        links[a : a + 512, : near.shape[1]] = near
    links[:, DEGREE - 4 :] = r.integers(0, k, (k, 4))  # far links keep the graph in one piece
    return Centroids(points, links, r.permutation(k)[:16], length)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _chosen(model: Centroids, lifted: np.ndarray) -> list[list[int]]:
    """Lists of each vector: the nearest, and near ones that no nearer chosen one stands for."""
    ids, far = model.search(lifted, ASSIGN_BEAM)
    out = []
    for row, gaps in zip(ids.tolist(), far.tolist(), strict=True):
        own = [row[0]]
        for c, gap in zip(row[1:], gaps[1:], strict=True):
            if c < 0 or len(own) == REPLICAS or gap > REPLICA_RATIO * gaps[0]:
                break
            apart = ((model.points[own] - model.points[c]) ** 2).sum(1).min()
            if apart > (APART * gap) ** 2:
                own.append(c)
        out.append(own)
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All products, each summed in double precision from the first coordinate to the last."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        out += a[:, i : i + 1] * b[:, i]
    return out


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` of the vectors that take part."""
    v = F.col("v")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        col(vec_id).cast("long").alias("vec_id"), col(vector).cast("array<double>").alias("v")
    )
    return rows.where(
        F.col("vec_id").isNotNull() & v.isNotNull() & whole & F.exists(v, lambda x: x != 0)
    )


_RESULT = "query_id long, rank int, vec_id long, score double"


def search(
    vectors: DataFrame,
    is_query=None,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found to each query.

    Queries are the rows of ``vectors`` for which ``is_query`` (a condition on ``vec_id``; default:
    all) holds; candidates are all rows but the query's own id. Ties go to the smaller id. Vectors
    that are null, empty or zero or that hold a null or non-finite component take no part, nor do
    rows without an id, nor vectors of another length than most have (the shorter of equally
    common lengths). Rows that repeat id and vector count once. No usable vector gives no row.
    """
    spark: SparkSession = vectors.sparkSession
    bounded_batches(spark)
    valid = usable(vectors, vec_id, vector)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    shapes = (
        valid.groupBy(F.size("v").alias("d"))
        .agg(F.count("*").alias("n"), F.max(length).alias("length"))
        .orderBy(F.desc("n"), "d")
        .limit(1)
        .collect()
    )
    if not shapes:
        return spark.createDataFrame([], _RESULT)
    dim, longest = shapes[0]["d"], shapes[0]["length"]
    valid = valid.where(F.size("v") == dim)

    # of equal vectors: the k + 1 smallest ids, and the vector itself once
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    members = (
        valid.distinct()
        .withColumn("place", F.row_number().over(by_vector))
        .withColumn("rep", F.first("vec_id").over(by_vector.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("place") <= k + 1)
        .select("rep", "vec_id", F.when(F.col("place") == 1, F.col("v")).alias("v"))
    )
    path = scratch_path(spark, "vectors")
    members.write.parquet(path)
    members = spark.read.parquet(path)
    reps = members.where("v IS NOT NULL").select("rep", "v")
    total = reps.count()

    rate = F.pmod(F.xxhash64("rep"), F.lit(1 << 32)) < int((1 << 32) * min(1, SAMPLE_ROWS / total))
    sample = reps.where(rate).select("v").toArrow()["v"].combine_chunks()
    if not len(sample):
        sample = reps.limit(1).select("v").toArrow()["v"].combine_chunks()
    sample = _matrix(sample)
    sample = sample[np.lexsort(sample.T)]
    model = centroids(sample, longest, total)
    shared = spark.sparkContext.broadcast(model)

    def assign(batches):
        own = shared.value
        for batch in batches:
            made = _matrix(batch.column(1))
            for a in range(0, len(made), 1_024):
                lists = _chosen(own, own.lifted(made[a : a + 1_024]))
                rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists]) + a
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for x in lists for c in x], pa.int32()),
                        pa.array([i == 0 for x in lists for i in range(len(x))]),
                        batch.column(0).take(pa.array(rows)),
                        batch.column(1).take(pa.array(rows)),
                    ],
                    ["list", "main", "rep", "v"],
                )

    path = scratch_path(spark, "lists")
    reps.mapInArrow(assign, "list int, main boolean, rep long, v array<double>").write.parquet(path)
    lists = spark.read.parquet(path)
    # a row for each list, at most twice MAX_LISTS
    sizes = lists.groupBy("list").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("main"), 1)).alias("own")
    )
    held = {x["list"]: (x["n"], x["own"]) for x in sizes.collect()}
    blocks = {c: -(-n // BLOCK_ROWS) for c, (n, _) in held.items()}
    mains = np.zeros(len(model.points), np.int64)
    for c, (_, own) in held.items():
        mains[c] = own
    counted = spark.sparkContext.broadcast(mains)

    asked = valid.select("vec_id", "v").distinct()
    if is_query is not None:
        asked = asked.where(is_query)
    asked = asked.withColumnRenamed("vec_id", "query_id").join(reps, "v")
    targets = asked.select(F.col("rep").alias("qrep"), "v").dropDuplicates(["qrep"])

    def probe(batches):
        own, mains = shared.value, counted.value
        enough = k + 1
        for batch in batches:
            made = own.aimed(_matrix(batch.column(1)))
            rows, chosen = [], []
            for a in range(0, len(made), 1_024):
                ids, far = own.search(made[a : a + 1_024], BEAM)
                near = (ids >= 0) & (far <= PROBE_RATIO * far[:, :1])
                near[:, PROBES:] = False
                before = np.cumsum(np.where(ids >= 0, mains[ids], 0), axis=1)
                short = np.concatenate([np.zeros((len(ids), 1)), before[:, :-1]], 1) < enough
                near |= short & (ids >= 0)
                for i in np.flatnonzero(before[:, -1] < enough).tolist():
                    rows += [a + i] * len(mains)
                    chosen += range(len(mains))
                    near[i] = False
                r, c = np.nonzero(near)
                rows += (r + a).tolist()
                chosen += ids[r, c].tolist()
            at = pa.array(np.array(rows, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(chosen, pa.int32())],
                ["qrep", "v", "list"],
            )

    probes = targets.mapInArrow(probe, "qrep long, v array<double>, list int")
    load = {x["list"]: x["count"] for x in probes.groupBy("list").count().collect()}
    shifts = {c: -(-n // BLOCK_QUERIES) for c, n in load.items()}

    def dealt(rows: DataFrame, own: dict[int, int], other: dict[int, int], key: str, names) -> DataFrame:
        """Rows of lists that are split: in their own block, once for each block of the others."""
        mine = {c: n for c, n in own.items() if n > 1}
        theirs = {c: n for c, n in other.items() if n > 1}

        def at(split: dict[int, int]):
            if not split:
                return F.lit(1)
            pairs = F.create_map(*(F.lit(x) for p in split.items() for x in p))
            return F.coalesce(pairs[F.col("list")], F.lit(1))

        return rows.withColumn(
            names[0], F.pmod(F.xxhash64(key), at(mine)).cast("int")
        ).withColumn(
            names[1], F.explode(F.sequence(F.lit(0), (at(theirs) - 1).cast("int")))
        )

    left = dealt(lists.select("list", "rep", "v"), blocks, shifts, "rep", ("block", "shift"))
    right = dealt(probes, shifts, blocks, "qrep", ("shift", "block"))

    def nearest(own: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if own.num_rows and queries.num_rows:
            ids = own["rep"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, a = ids[order], _matrix(own["v"].combine_chunks())[order]
            q = _matrix(queries["v"].combine_chunks())
            names = queries["qrep"].to_numpy()
            take = min(k + 1, len(ids))
            step = max(1, (1 << 21) // len(ids))
            for at in range(0, len(q), step):
                score = inner_products(q[at : at + step], a)
                best = np.argsort(-score, axis=1, kind="stable")[:, :take]
                out.append(
                    pd.DataFrame(
                        {
                            "qrep": np.repeat(names[at : at + step], take),
                            "rep": ids[best].ravel(),
                            "score": np.take_along_axis(score, best, 1).ravel(),
                        }
                    )
                )
        found = pd.concat(out) if out else pd.DataFrame({"qrep": [], "rep": [], "score": []})
        return pa.Table.from_pandas(
            found,
            pa.schema([("qrep", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())]),
            preserve_index=False,
        )

    keys = ["list", "block", "shift"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(nearest, "qrep long, rep long, score double")
    )
    best = Window.partitionBy("qrep").orderBy(F.desc("score"), "rep")
    near = (
        found.dropDuplicates(["qrep", "rep"])
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k + 1)
    )
    named = Window.partitionBy("qrep").orderBy(F.desc("score"), "vec_id")
    near = (
        near.join(members.select("rep", "vec_id"), "rep")
        .withColumn("place", F.row_number().over(named))
        .where(F.col("place") <= k + 1)
        .select("qrep", "vec_id", "score")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select("query_id", F.col("rep").alias("qrep"))
        .join(near, "qrep")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
